"""N-gram Jaccard self-join by PartEnum signatures, and its connected components. Exact for a similarity of 0.8.

A document's set is that of its distinct 5-word shingles, as 64-bit hashes. Sets A and B link if and only if 9 d <= s, for
s = |A| + |B| and d = |A xor B|. PartEnum gives linked sets of one size band a common signature:

1. Size bands. Band i holds sizes from 2**i to 2**(i+1) - 1; a set signs for its own band, and for the next one if it has 0.8 of that
   band's least size or more. So linked sets, whose sizes are within 0.8 of each other, sign for the larger one's band both.
2. First level. A band's feature domain is split into 2**(i+1) / PART_MEAN parts by the leading bits of the hash. d and s add up over the
   parts, so linked sets have a part with s > 0 and 9 d <= s.
3. Second level. In such a part, if s <= 8 then d = 0: up to 3 features are signed whole. If 9 <= s <= 17 then d <= 1 and each
   set has 4 to 9 features there: the part is split in three, and each subset of two of them is signed (one difference spoils only
   one of the three parts, and the other two are the same in both sets). If s >= 18, each set has 8 features or more: the part is halved and step 3 repeated.

Empty subsets, which all sets would share, are never signed: where both sets have all features of a part in one third, it is split
anew with another seed, which takes the same course for both.

Links that are quick to find go first, so that later steps need no list of a group's near copies: each distinct set is compared with one
hub for each of its LEAST least shingles. Then the signatures are dealt out by hash, in packed arrays that name each set's component so
far. Groups of one component are dropped where they are met. Of the others, up to SMALL sets give all their pairs across components; larger ones give a
star and are written once for each distinct list of members, as blocks of a bounded size. At last, all pairs of blocks of groups that still hold
several components are searched, each as a row of its own, in two passes: one gives a forest of candidates for each, which is verified with the
pairs of small groups, the next all that are left.

Candidates are filtered by size (0.8) and by odd sketches (the parity of shingles by hash in a bit array: the bits that
differ never outnumber d), both of which are safe, and then counted exactly on the whole sets. No link or component reaches the driver.

Edge cases: null, empty and wordless texts have the empty set, link with nothing and are their own component; fewer than 5
words make one shingle; rows repeated or with equal sets are linked (a set's copies are told apart only in membership); a
null doc_id takes part, its component_id being the least id that is not null, if any; very long texts are worked on whole, one at a
time; a tie (exactly 0.8) is a link; of several rows with the least id of a component, deduplicate keeps the first; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .columns import ROW, with_own_id, with_row
from ..operators.components import components

SHINGLE = 5
#: Sets link when 100 * intersection >= SIMILARITY * union. The proof above is for 80; its bounds follow from it.
SIMILARITY = 80
#: Features a part of the first level has at the top of a band, a power of two.
PART_MEAN = 8
#: Least shingles by which a set meets hubs.
LEAST = 4
#: Groups of up to so many sets give all their pairs.
SMALL = 8
#: Bounds of a block of a larger group: sets, and bytes of their sketches.
BLOCK_SETS, BLOCK_BYTES = 1024, 1 << 18
#: Shingles worked on at once, and bytes of text for each bucket of signatures.
TOGETHER = 250_000
BUCKET_BYTES = 32_000_000
#: Shingles of sets whose sketches (some a byte for each) are packed into blocks at once.
SLOT_SHINGLES = 16_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers hashes of the words met lately."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and \x20 \x09-\x0D only
        if not words:
            return np.zeros(0, np.uint64)
        known, hashes = self.known, []
        if len(known) > 100_000:
            known.clear()
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        each = np.array(hashes, np.uint64)
        size = min(SHINGLE, len(words))
        out = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            out = mix(out + each[i : i + len(out)])
        return np.unique(out)


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)))


def sketch_bits(size: int) -> int:
    """64, or the power of two that is not below four times the size."""
    return max(64, 1 << (4 * size - 1).bit_length())


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles by hash."""
    bits = sketch_bits(len(shingles))
    odd = np.bincount((mix(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """At most the size of the symmetric difference. The longer sketch is folded to the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def size_bands(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, band): the bands that sets of these sizes sign for."""
    own = np.frexp(size.astype(np.float64))[1].astype(np.int64) - 1
    above = np.flatnonzero((size > 0) & (5 * size >= np.int64(1) << (own + 3)))
    here = np.flatnonzero(size > 0)
    return np.concatenate([here, above]), np.concatenate([own[here], own[above] + 1])


def subsets(content: np.ndarray, value: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the part, sum of contents, features) of the two-of-three subsets of parts that begin at start."""
    part = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(value))))
    of, sums, counts = [], [], []
    for seed in range(64):
        if not len(part):
            break
        third = mix(value + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(3)
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        again = np.zeros(len(first), bool)
        for left_out in range(3):
            held = third != left_out
            count = np.add.reduceat(held.astype(np.int64), first)
            total = np.add.reduceat(np.where(held, content, np.uint64(0)), first)
            some = count > 0
            of.append(part[first][some])
            sums.append(total[some])
            counts.append(count[some])
            again |= ~some
        more = np.repeat(again, np.diff(np.append(first, len(part))))
        part, value, content = part[more], value[more], content[more]
    return np.concatenate([np.zeros(0, np.int64), *of]), np.concatenate([np.zeros(0, np.uint64), *sums]), np.concatenate([np.zeros(0, np.int64), *counts])


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature), distinct, by set. Sets are sorted."""
    size = np.array([len(s) for s in sets], np.int64)
    begin = np.cumsum(size) - size
    values = np.concatenate([np.zeros(0, np.uint64), *sets])
    owners, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    of, bands = size_bands(size)
    # Each set once for each of its bands.
    many = size[of]
    slot = np.repeat(np.arange(len(of)), many)
    value = values[np.arange(many.sum()) + np.repeat(begin[of] - (np.cumsum(many) - many), many)]
    content, depth = mix(value + np.uint64(7)), np.maximum(0, bands + 1 - (PART_MEAN.bit_length() - 1))[slot]

    def sign(who: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
        owners.append(of[who])
        out.append(mix(total + count.astype(np.uint64) + bands[who].astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)))

    while len(value):
        part = np.where(depth > 0, value >> (64 - depth).clip(0, 63).astype(np.uint64), np.uint64(0))
        first = np.ones(len(value), bool)
        first[1:] = (slot[1:] != slot[:-1]) | (part[1:] != part[:-1])
        start = np.flatnonzero(first)
        count = np.diff(np.append(start, len(value)))
        whole = count <= 3
        sign(slot[start][whole], np.add.reduceat(content, start)[whole], count[whole])
        some = (count >= 4) & (count <= 9)
        rows = np.repeat(some, count)
        inner = np.cumsum(count[some]) - count[some]
        which, total, held = subsets(content[rows], value[rows], inner)
        sign(slot[start][some][which], total, held)
        more = np.repeat(count >= 8, count)
        slot, value, content, depth = slot[more], value[more], content[more], depth[more] + 1
    owner, signed = np.concatenate(owners), np.concatenate(out)
    order = np.lexsort((signed, owner))
    owner, signed = owner[order], signed[order]
    new = np.ones(len(signed), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (signed[1:] != signed[:-1])
    return owner[new], signed[new]


def close_sizes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= SIMILARITY * np.maximum(a, b)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(uid, doc_id, n_shingles, set_key, sketch, least) of each row of (uid, doc_id, text); the empty set's key is null."""

    def run(batches):
        shingler = Shingler()
        for b in batches:
            rows = []
            for uid, doc_id, text in zip(b["uid"], b["doc_id"], b["text"], strict=True):
                s = shingler(text)
                rows.append((uid, doc_id, len(s), *((set_key(s), sketch(s), s[:LEAST].astype(np.int64).tolist()) if len(s) else (None, None, None))))
            out = pd.DataFrame(rows, columns=["uid", "doc_id", "n_shingles", "set_key", "sketch", "least"], dtype=object)
            yield out.astype({"uid": "int64", "n_shingles": "int64", "set_key": "Int64"})

    t = texts.select("uid", F.col("doc_id").cast("string").alias("doc_id"), "text")
    return with_own_id(t.mapInPandas(run, "uid long, doc_id string, n_shingles long, set_key long, sketch binary, least array<long>"), texts)


def hub_pairs(sets: DataFrame) -> DataFrame:
    """(a, b, na, nb): each set with a hub of the sets that share one of its least shingles."""
    f = sets.select("set_key", "n", F.explode("least").alias("sign"))
    hubs = f.groupBy("sign").agg(F.min_by(F.struct("set_key", "n"), F.xxhash64("set_key", "sign")).alias("hub"), F.count("*").alias("many")).where("many > 1")
    pairs = f.join(hubs, "sign").select(F.col("hub.set_key").alias("a"), F.col("set_key").alias("b"), F.col("hub.n").alias("na"), F.col("n").alias("nb"))
    return pairs.where(F.expr(f"a <> b AND 100 * least(na, nb) >= {SIMILARITY} * greatest(na, nb)")).distinct()


def signature_blobs(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, signs, owners, keys, comps, sizes): the signatures of a batch of (set_key, component, text) that fall into a bucket, packed.

    signs: 5 bytes each (the bucket is another part of the hash); owners: 4-byte places in keys, comps and sizes.
    """

    def blobs(keys: list[int], comps: list[int], sets: list[np.ndarray]):
        owner, sign = signatures(sets)
        bucket = (sign & np.uint64(0xFFFFFF)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        owner, sign, bucket = owner[order], sign[order] >> np.uint64(24), bucket[order].astype(np.int64)
        keys, comps, sizes = np.array(keys, np.int64), np.array(comps, np.int64), np.array([len(s) for s in sets], np.int32)
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        rows = []
        for a, z in zip(edge, np.append(edge[1:], len(bucket)), strict=True):
            held, own = np.unique(owner[a:z], return_inverse=True)
            signs = sign[a:z].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            rows.append((int(bucket[a]), signs, own.astype("<u4").tobytes(), keys[held].tobytes(), comps[held].tobytes(), sizes[held].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "signs", "owners", "keys", "comps", "sizes"])

    def run(batches):
        shingler, keys, comps, sets, size = Shingler(), [], [], [], 0
        for b in batches:
            for key, comp, text in zip(b["set_key"], b["component"], b["text"], strict=True):
                keys.append(key)
                comps.append(comp)
                sets.append(shingler(text))
                size += len(sets[-1])
                if size >= TOGETHER:
                    yield blobs(keys, comps, sets)
                    keys, comps, sets, size = [], [], [], 0
        if keys:
            yield blobs(keys, comps, sets)

    return texts.select("set_key", "component", "text").mapInPandas(run, "bucket int, signs binary, owners binary, keys binary, comps binary, sizes binary")


def candidates(blobs: DataFrame) -> DataFrame:
    """(a, b, na, nb): pairs of keys and sizes in different components; rows with a gid are blocks (gid, block, keys, sizes) of large groups.

    A gid names a list of members; each block has its sets in the order of their sizes.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(pdf["signs"]), np.uint8).reshape(-1, 5)
        sign = np.zeros((len(raw), 8), np.uint8)
        sign[:, :5] = raw
        sign = sign.view("<u8").ravel()
        owners = [np.frombuffer(x, "<u4") for x in pdf["owners"]]
        unpacked = lambda c, kind: np.concatenate([np.frombuffer(k, kind)[o] for k, o in zip(pdf[c], owners, strict=True)])
        key, comp, size = unpacked("keys", np.int64), unpacked("comps", np.int64), unpacked("sizes", np.int32)
        order = np.lexsort((key, size, sign))
        sign, key, comp, size = sign[order], key[order], comp[order], size[order]

        def groups(sign, size):
            """Where groups start, also at a gap of sizes, and how many sets each has."""
            start = np.flatnonzero(np.append(True, (sign[1:] != sign[:-1]) | ~close_sizes(size[1:].astype(np.int64), size[:-1].astype(np.int64)))) if len(sign) else np.zeros(0, np.int64)
            return start, np.diff(np.append(start, len(sign)))

        start, many = groups(sign, size)
        mixed = np.repeat(np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start), many) if len(sign) else np.zeros(0, bool)
        sign, key, comp, size = sign[mixed], key[mixed], comp[mixed], size[mixed]
        start, many = groups(sign, size)
        group, first = np.repeat(np.arange(len(many)), many), np.repeat(start, many)
        in_small, a, b = many[group] <= SMALL, [], []
        for step in range(1, SMALL):  # the next ones of the same small group
            i = np.arange(len(sign) - step) if len(sign) > step else np.zeros(0, np.int64)
            i = i[(group[i] == group[i + step]) & in_small[i]]
            a.append(i)
            b.append(i + step)
        star = np.flatnonzero(~in_small & (first != np.arange(len(sign))))
        a, b = np.concatenate([*a, first[star]]), np.concatenate([*b, star])
        ok = close_sizes(size[a].astype(np.int64), size[b].astype(np.int64)) & (comp[a] != comp[b])
        a, b = a[ok], b[ok]
        pairs = pd.DataFrame({"a": np.minimum(key[a], key[b]), "b": np.maximum(key[a], key[b]), "na": np.where(key[a] < key[b], size[a], size[b]), "nb": np.where(key[a] < key[b], size[b], size[a])}).drop_duplicates()
        rows, seen = [], set()
        for g in np.flatnonzero(many > SMALL):
            k, n = key[start[g] : start[g] + many[g]], size[start[g] : start[g] + many[g]]
            gid = int(np.int64(mix(mix(k.view(np.uint64)).sum(keepdims=True) + np.uint64(len(k))).astype(np.int64)[0]))
            if gid in seen:
                continue
            seen.add(gid)
            kinds, place = np.unique(n, return_inverse=True)
            width = np.array([sketch_bits(int(x)) // 8 for x in kinds])[place]
            block = np.maximum((np.cumsum(width) - 1) // BLOCK_BYTES, np.arange(len(k)) // BLOCK_SETS)
            edge = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            for i, (x, z) in enumerate(zip(edge, np.append(edge[1:], len(k)), strict=True)):
                rows.append((gid, i, k[x:z].tobytes(), n[x:z].tobytes()))
        pairs = pairs.assign(gid=pd.array([None] * len(pairs), dtype="Int64"), block=0, keys=None, sizes=None)
        blocks = pd.DataFrame(rows, columns=["gid", "block", "keys", "sizes"]).assign(a=0, b=0, na=0, nb=0)
        columns = ["a", "b", "na", "nb", "gid", "block", "keys", "sizes"]
        return pd.concat([x[columns].astype({"gid": "Int64"}) for x in (pairs, blocks) if len(x)]) if len(pairs) + len(blocks) else pairs[columns]

    return blobs.groupBy("bucket").applyInPandas(run, "a long, b long, na int, nb int, gid long, block int, keys binary, sizes binary")


def near_by_sketch(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sketches don't rule out a link."""
    s = sets.select("set_key", "sketch")
    both = pairs.join(s.withColumnsRenamed({"set_key": "a", "sketch": "sa"}), "a").join(s.withColumnsRenamed({"set_key": "b", "sketch": "sb"}), "b")

    def run(batches: Iterator[pd.DataFrame]):
        for p in batches:
            near = [9 * differing_bits(x, y) <= n for x, y, n in zip(p["sa"], p["sb"], p["na"] + p["nb"], strict=True)]
            yield p.loc[near, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, counted on whole sets."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("set_key")).distinct()
    wanted = sets.join(keys, "set_key", "left_semi").select("set_key", "uid")

    def run(batches):
        shingler = Shingler()
        for b in batches:
            yield pd.DataFrame({"set_key": b["set_key"], "shingles": [shingler(t).tobytes() for t in b["text"]]})

    whole = texts.select("uid", "text").join(wanted, "uid").select("set_key", "text").mapInPandas(run, "set_key long, shingles binary")
    whole = stage(whole, "shingles")
    both = pairs.join(whole.withColumnsRenamed({"set_key": "a", "shingles": "sa"}), "a").join(whole.withColumnsRenamed({"set_key": "b", "shingles": "sb"}), "b")

    def count(batches):
        for p in batches:
            links = []
            for x, y in zip(p["sa"], p["sb"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * common >= SIMILARITY * (len(x) + len(y) - common))
            yield p.loc[links, ["a", "b"]]

    return both.mapInPandas(count, "a long, b long")


class Block:
    """Sets of a group: keys, components, sizes and sketches."""

    def __init__(self, keys: bytes, comps: bytes, sizes: bytes, sketches: bytes) -> None:
        self.key, self.comp = np.frombuffer(keys, np.int64), np.frombuffer(comps, np.int64)
        self.size = np.frombuffer(sizes, np.int32).astype(np.int64)
        bits = {n: sketch_bits(int(n)) for n in np.unique(self.size)}
        self.width = np.array([bits[n] // 64 for n in self.size])
        at = np.cumsum(self.width) - self.width
        words = np.frombuffer(sketches, np.uint64)
        self.rows = {w: np.flatnonzero(self.width == w) for w in np.unique(self.width)}
        self.sketch = {w: words[at[r][:, None] + np.arange(w)] for w, r in self.rows.items()}


def close_pairs(x: Block, y: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in x and y of sets in different components that sizes and sketches don't rule out."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for w, i in x.rows.items():
        for v, j in y.rows.items():
            if not w <= 2 * v <= 4 * w:  # sizes within 0.8 differ by one step of widths at most
                continue
            wanted = (x.comp[i][:, None] != y.comp[j][None, :]) & close_sizes(x.size[i][:, None], y.size[j][None, :])
            if same:
                wanted &= i[:, None] < j[None, :]
            p, q = np.nonzero(wanted)
            if not len(p):
                continue
            fold = lambda s, to: s if s.shape[1] == to else s[:, :to] ^ s[:, to:]
            a, b = fold(x.sketch[w], min(v, w)), fold(y.sketch[v], min(v, w))
            together = max(1, 1_000_000 // min(v, w))  # some 8 MB of sketches
            for k in range(0, len(p), together):
                c, d = p[k : k + together], q[k : k + together]
                ok = 9 * np.bitwise_count(a[c] ^ b[d]).sum(1, dtype=np.int64) <= x.size[i[c]] + y.size[j[d]]
                left.append(i[c[ok]])
                right.append(j[d[ok]])
    return np.concatenate(left), np.concatenate(right)


def forest(pairs: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Of (a, b, component of a, of b) those that would, if they were links, join what all of them could join."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for a, b, c, d in pairs:
        if (c := root(c)) != (d := root(d)):
            parent[c] = d
            out.append((a, b))
    return out


def candidates_of(gid: int, x: Block, y: Block, same: bool, every: bool) -> set:
    """(0, a, b) for candidates of two blocks, all or a forest; (gid, None, None) where the forest leaves some out."""
    p, q = close_pairs(x, y, same)
    pairs = list(zip(x.key[p].tolist(), y.key[q].tolist(), x.comp[p].tolist(), y.comp[q].tolist(), strict=True))
    taken = [r[:2] for r in pairs] if every else forest(pairs)
    return {(0, min(r), max(r)) for r in taken} | ({(gid, None, None)} if len(taken) < len(pairs) else set())


def across_components(members: DataFrame, labels: DataFrame, sets: DataFrame, every: bool) -> DataFrame:
    """(gid, a, b): candidates between components of large groups (gid, block, set_key); all of them, or a forest of each pair of blocks.

    Where a forest leaves candidates out, a row without a and b names the group. Groups of one block are searched where they are packed.
    """
    m = members.join(labels, members["set_key"] == labels["node"], "left").select("gid", "block", "set_key", "n", F.coalesce("component", "set_key").alias("component"))
    mixed = m.groupBy("gid").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("block").alias("last")).where("x <> y").select("gid", "last")
    m = stage(m.join(mixed, "gid"), "mixed")
    slots = max(8, (m.agg(F.sum("n")).first()[0] or 0) // SLOT_SHINGLES)
    m = m.withColumn("slot", F.pmod(F.xxhash64("gid", "block"), F.lit(slots)))
    held = m.select("slot", "set_key").distinct().join(sets.select("set_key", "sketch"), "set_key")  # each sketch once a slot
    held = held.select(F.col("slot").alias("of"), F.col("set_key").alias("key"), "sketch")
    columns = ["gid", "a", "b", "block", "keys", "comps", "sizes", "sketches", "low", "high", "x", "y"]

    def pack(pdf: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        sketch = dict(zip(held["key"], held["sketch"], strict=True))
        pdf = pdf.sort_values(["gid", "block", "n", "set_key"])
        gid, block, key, comp, n, last = (pdf[c].to_numpy() for c in ("gid", "block", "set_key", "component", "n", "last"))
        found: set = set()
        rows = []
        edge = np.flatnonzero(np.append(True, (gid[1:] != gid[:-1]) | (block[1:] != block[:-1]))) if len(gid) else np.zeros(0, np.int64)
        for a, z in zip(edge, np.append(edge[1:], len(gid)), strict=True):
            packed = key[a:z].astype(np.int64).tobytes(), comp[a:z].astype(np.int64).tobytes(), n[a:z].astype(np.int32).tobytes(), b"".join(sketch[k] for k in key[a:z].tolist())
            if last[a]:
                rows.append((int(gid[a]), None, None, int(block[a]), *packed, int(n[a]), int(n[z - 1]), int(comp[a:z].min()), int(comp[a:z].max())))
            else:
                only = Block(*packed)
                found |= candidates_of(int(gid[a]), only, only, True, every)
        out = pd.DataFrame([(*r, -1, *[None] * 4, 0, 0, 0, 0) for r in found] + rows, columns=columns, dtype=object)
        whole = {c: "int64" for c in ("gid", "block", "low", "high", "x", "y")}
        return out.astype(whole | {"a": "Int64", "b": "Int64"})

    schema = "gid long, a long, b long, block long, keys binary, comps binary, sizes binary, sketches binary, low long, high long, x long, y long"
    made = stage(m.groupBy("slot").cogroup(held.groupBy("of")).applyInPandas(pack, schema), "blocks")
    blocks = made.where("block >= 0")
    info = blocks.select("gid", "block", "low", "high", "x", "y")
    other = info.select("gid", *[F.col(c).alias(f"{c}2") for c in ("block", "low", "high", "x", "y")])
    which = info.join(other, "gid").where(f"block <= block2 AND 100 * high2 >= {SIMILARITY} * low AND 100 * high >= {SIMILARITY} * low2 AND (x <> y2 OR x2 <> y)")
    packed = F.struct("keys", "comps", "sizes", "sketches")
    one, two = blocks.select("gid", "block", packed.alias("one")), blocks.select("gid", F.col("block").alias("block2"), packed.alias("two"))
    both = which.select("gid", "block", "block2").join(one, ["gid", "block"]).join(two, ["gid", "block2"])

    def search(batches):
        for b in batches:
            found: set = set()
            for gid, i, j, x, y in zip(b["gid"], b["block"], b["block2"], b["one"], b["two"], strict=True):
                found |= candidates_of(gid, Block(**x), Block(**y), i == j, every)
            out = pd.DataFrame(list(found), columns=["gid", "a", "b"], dtype=object)
            yield out.astype({"gid": "int64", "a": "Int64", "b": "Int64"})

    across = both.select("gid", "block", "block2", "one", "two").mapInPandas(search, "gid long, a long, b long")
    return across.unionByName(made.where("block < 0").select("gid", "a", "b")).distinct()


def unpacked(blocks: DataFrame) -> DataFrame:
    """(gid, block, set_key, n) of the members of blocks."""

    def run(batches):
        for b in batches:
            many = [len(x) // 4 for x in b["sizes"]]
            keys, sizes = np.frombuffer(b"".join(b["keys"]), np.int64), np.frombuffer(b"".join(b["sizes"]), np.int32)
            yield pd.DataFrame({"gid": np.repeat(b["gid"].to_numpy(), many), "block": np.repeat(b["block"].to_numpy(), many), "set_key": keys, "n": sizes})

    return blocks.select("gid", "block", "keys", "sizes").mapInPandas(run, "gid long, block int, set_key long, n int")


def _near_duplicates(texts: DataFrame) -> DataFrame:
    """(uid, doc_id, n_shingles, set_key, component), a row for each of the staged (uid, doc_id, text); component: a key, null for the empty set."""
    members = stage(shingle_sets(texts), "sets")
    sets = members.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(
        F.min("uid").alias("uid"), F.first("n_shingles").cast("int").alias("n"), F.first("sketch").alias("sketch"), F.first("least").alias("least")
    )
    sets = stage(sets, "distinct")
    links = verified(stage(near_by_sketch(hub_pairs(sets), sets), "pairs"), texts, sets)
    links = stage(links, "links")
    labels = stage(components(links), "components")

    def joined(pairs: DataFrame) -> None:
        """Takes those of the pairs that link into links and labels."""
        nonlocal links, labels
        pairs = stage(pairs, "pairs")
        if pairs.isEmpty():
            return
        more = stage(verified(pairs, texts, sets), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = stage(components(links), "components")

    rest = sets.join(labels, sets["set_key"] == labels["node"], "left").select("uid", "set_key", F.coalesce("component", "set_key").alias("component"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = stage(candidates(signature_blobs(texts.select("uid", "text").join(rest, "uid"), max(8, int(size // BUCKET_BYTES)))), "candidates")
    pairs = near_by_sketch(found.where("gid IS NULL").select("a", "b", "na", "nb").distinct(), sets)  # of small groups
    large = stage(unpacked(found.where("gid IS NOT NULL").dropDuplicates(["gid", "block"])), "members")
    if not large.isEmpty():
        across = stage(across_components(large, labels, sets, False), "across")
        pairs = pairs.unionByName(across.where("a IS NOT NULL").select("a", "b"))
        large = large.join(across.where("a IS NULL").select("gid").distinct(), "gid", "left_semi")
    joined(pairs)
    if not large.isEmpty():
        across = stage(across_components(large, labels, sets, True), "across")
        joined(across.where("a IS NOT NULL").select("a", "b"))
    whole = members.join(labels, members["set_key"] == labels["node"], "left")
    return whole.select("uid", "doc_id", "n_shingles", "set_key", F.coalesce("component", "set_key").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, component_id), a row for each row of docs."""
    whole = _near_duplicates(with_row(docs.select("doc_id", "text")).withColumnRenamed(ROW, "uid"))
    least = whole.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = whole.join(least, "component", "left")
    return out.select("doc_id", "n_shingles", "set_key", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that of the least id (a null one is the last), whatever other rows have this id."""
    docs = with_row(docs)
    near = _near_duplicates(docs.select(F.col(ROW).alias("uid"), "doc_id", "text")).where(F.col("component").isNotNull())
    near = stage(near.select("uid", "doc_id", "component"), "linked")
    first = near.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid"))["uid"].alias("uid"))
    gone = stage(near.join(first, "uid", "left_anti").select("uid"), "gone")
    return docs.join(gone, docs[ROW] == gone["uid"], "left_anti").drop(ROW)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


#: The contract in DuckDB SQL: links by an equi-join on shingles, components by a recursive walk from each document.
SQL = r"""
WITH RECURSIVE dw AS (SELECT row_number() OVER () AS uid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT uid, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT uid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
n AS (SELECT uid, count(*) AS n FROM sh GROUP BY uid),
both_ AS (SELECT a.uid AS a, b.uid AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.uid <> b.uid GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n x ON x.uid = a JOIN n y ON y.uid = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
walk AS (SELECT a AS uid, b AS r FROM link UNION SELECT walk.uid, link.b FROM walk JOIN link ON walk.r = link.a),
least AS (SELECT walk.uid, min(dw.doc_id) AS m FROM walk JOIN dw ON dw.uid = walk.r GROUP BY walk.uid)
SELECT dw.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(dw.doc_id, least.m), dw.doc_id) AS component_id
FROM dw LEFT JOIN n USING (uid) LEFT JOIN least USING (uid)
"""
