"""Language-model scores by a hierarchical Pitman-Yor model whose seating is sampled by Gibbs.

Restaurants: one for each of CLASSES classes of previous words (their hash; one more for the start of a text), all of which share
one parent, the unigram restaurant, whose base is uniform over the V training words and one unknown. In restaurant m
    p(w | m) = (c_mw - d t_mw + (theta + d T_m) p(w)) / (theta + C_m)
with customers c and tables t; each table of w in a context restaurant is a customer of w in the parent. The number of context
restaurants is a parameter, so their totals have a fixed size; dishes and (context, word) entries grow with the corpus.

A Gibbs move takes a customer of an entry away and seats it again, with weight a = (theta + d T_m) p(w) at a new table and c - 1 - d t
at the others. With table sizes summed out, many such moves draw t from S(c, t) a^t (generalised Stirling numbers of discount d). A
sweep draws the tables of all customers of an entry at once from this law, so it takes no longer for larger counts: exactly for up to
STIRLING customers, by its first two moments beyond. It does so in each entry of the contexts, then in the parent. After BURN_IN sweeps, the predictive probabilities of SAMPLES sweeps are averaged.

On the cluster: a pass over the texts packs tokens by word into buckets (the words of a bucket meet all their contexts,
documents and parent entries there). One job counts, seats at first and sums up the restaurants' totals, CLASSES + 1 rows;
a second one samples given these totals (as in approximate distributed Gibbs sampling) and sums up the totals that each sample
has; a third one draws the same samples again, from the same seeds, and sums log10 probabilities by document, each sample's
given its own totals, so that the probabilities of each context add up to 1. All training tokens count and all tokens of all
texts are scored.

Words that hold 1 / HOT or more of all tokens (at most HOT words, and the end token) would overfill a bucket. A pass counts all words. Their
tokens are dealt out by word and context; what their parent entries need, two sums for each such word and sample, goes through the
driver. While the others are sampled, their parent probabilities are those of the first seating.

Edge cases: null and empty texts are the end token alone; a null doc_id has the fold of the empty text; repeated rows count and
are scored each; with no training token every word is unknown; an empty table gives an empty result; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import fleeting, stage
from .columns import id_and_text, with_own_id

CLASSES = 4096
THETA, ROOT_THETA = 1.0, 1.0
STIRLING = 200
BURN_IN, SAMPLES = 3, 4
SEED = 20
HOT = 200
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 200_000
#: Characters packed at once, and bytes of text for each bucket of words.
TOGETHER = 3_000_000
BUCKET_BYTES = 16_000_000
END = b""
GRAIN = 2.0**-36


def held_out(doc_id: str | None) -> bool:
    return zlib.crc32((doc_id or "").encode()) % 10 == 0


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def hot_words(docs: DataFrame) -> dict[bytes, float]:
    """Frequent words and their share of all tokens, and the end's."""

    def run(batches):
        counts: Counter = Counter()
        total = 0
        for b in batches:
            for t in b["text"]:
                counts.update(tokens_of(t))
            if len(counts) >= COUNTED:
                total += counts.total()
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                counts = Counter()
        yield pd.DataFrame({"word": [*counts, None], "n": [*counts.values(), total + counts.total()]})

    with fleeting(docs.sparkSession):
        counts = docs.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        # The total, the end and at most HOT words can be wanted.
        rows = counts.orderBy(F.col("word").isNull().desc(), (F.length("word") == 0).desc(), F.col("n").desc()).limit(HOT + 2).collect()
    total = sum(r["n"] for r in rows if r["word"] is None)
    return {bytes(r["word"]): r["n"] / total for r in rows if r["word"] is not None and (r["n"] >= total / HOT or not r["word"])} or {END: 1.0}


def pack_tokens(docs: DataFrame, buckets: int, hot: dict[bytes, float]) -> DataFrame:
    """Rows of documents (chunk, place, doc_id, held_out, n_tokens; bucket null) and of packed tokens (chunk, bucket, ...).

    Packed (zstandard): words (joined by spaces) and how many tokens each has; for each token, by word, its context's class, its
    document's place in the chunk (16 bits each, places as differences) and whether it trains (a bit); size: documents in the chunk.
    A chunk has fewer than 2 ** 16 documents, as each counts as 64 characters more than it has.
    """
    assert TOGETHER // 64 < 1 << 16
    names = ["chunk", "bucket", "doc_id", "place", "held_out", "n_tokens", "words", "many", "contexts", "places", "trains", "size"]

    def pack(chunk: int, ids: list, texts: list) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        tokens, lengths, trains = [], [], np.array([not held_out(i) for i in ids])
        for text in texts:
            words = tokens_of(text)
            tokens += [number.setdefault(w, len(number)) for w in words]
            lengths.append(len(words))
        lengths, word = np.array(lengths), np.array(tokens, np.int64)
        vocabulary = list(number)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in vocabulary], np.uint64)
        classes = (hashes % np.uint64(CLASSES)).astype(np.uint16)
        context = np.empty(len(word), np.uint16)
        context[1:] = classes[word[:-1]]
        context[np.cumsum(lengths) - lengths] = CLASSES
        place = np.repeat(np.arange(len(ids), dtype=np.uint16), lengths)
        bucket = ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        bucket = bucket[word]
        spread = np.array([w in hot for w in vocabulary])[word]
        bucket[spread] = (hashes[word[spread]] // np.uint64(7) + context[spread].astype(np.uint64) * np.uint64(0x9E3779B1)) % np.uint64(buckets)
        order = np.lexsort((word, bucket))
        word, context, place, bucket = word[order], context[order], place[order], bucket[order]
        rows = [(chunk, None, i, p, not t, int(n), None, None, None, None, None, None) for p, (i, t, n) in enumerate(zip(ids, trains, lengths, strict=True))]
        starts = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (bucket[1:] != bucket[:-1])))
        many = np.diff(np.append(starts, len(word)))
        of = bucket[starts]
        edges = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        compress = zstandard.ZstdCompressor(level=3).compress
        for a, z in zip(edges, np.append(edges[1:], len(starts)), strict=True):
            first, last = starts[a], starts[z] if z < len(starts) else len(word)
            joined = b" ".join(vocabulary[word[s]] for s in starts[a:z])
            rows.append((chunk, int(of[a]), None, None, None, None, compress(joined), compress(many[a:z].astype("<u4").tobytes()), compress(context[first:last].tobytes()), compress(np.diff(place[first:last], prepend=np.uint16(0)).tobytes()), compress(np.packbits(trains[place[first:last]]).tobytes()), len(ids)))
        out = pd.DataFrame(rows, columns=names, dtype=object)
        return out.astype({"chunk": "int64", "bucket": "Int32", "place": "Int32", "held_out": "boolean", "n_tokens": "Int64", "size": "Int32"})

    def run(batches):
        chunk, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for i, t in zip(b["doc_id"], b["text"], strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t or "") + 64
                if size >= TOGETHER:
                    yield pack(chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
        if ids:
            yield pack(chunk, ids, texts)

    schema = "chunk long, bucket int, doc_id string, place int, held_out boolean, n_tokens long, words binary, many binary, contexts binary, places binary, trains binary, size int"
    return with_own_id(id_and_text(docs).mapInPandas(run, schema), docs)


class Bucket:
    """The tokens of some words: entries (word, context) with their training customers."""

    def __init__(self, pdf: pd.DataFrame, hot: list[bytes]) -> None:
        pdf = pdf.sort_values("chunk")
        self.chunks = pdf["chunk"].tolist()
        number: dict[bytes, int] = {}
        expand = zstandard.ZstdDecompressor().decompress
        word, self.place, trains, context = [], [], [], []
        for words, many, contexts, flags in zip(pdf["words"], pdf["many"], pdf["contexts"], pdf["trains"], strict=True):
            own = [number.setdefault(w, len(number)) for w in expand(words).split(b" ")]
            word.append(np.repeat(np.array(own, np.int64), np.frombuffer(expand(many), "<u4")))
            context.append(np.frombuffer(expand(contexts), np.uint16))
            trains.append(np.unpackbits(np.frombuffer(expand(flags), np.uint8))[: len(context[-1])].astype(bool))
        if "places" in pdf:  # only for scores
            self.place = [np.cumsum(np.frombuffer(expand(p), np.uint16), dtype=np.uint16) for p in pdf["places"]]
            self.docs = pdf["size"].tolist()
        key = np.concatenate(word) * (CLASSES + 1) + np.concatenate(context)
        del word, context
        trains = np.concatenate(trains)
        entry, self.of = np.unique(key, return_inverse=True)
        del key
        self.of = self.of.astype(np.int32)
        self.word, self.context = entry // (CLASSES + 1), entry % (CLASSES + 1)
        self.customers = np.bincount(self.of, trains, len(entry)).astype(np.int64)
        self.counts = np.bincount(self.word, self.customers, len(number)).astype(np.int64)
        #: Of the frequent words that are here: their numbers in this bucket, and in hot.
        held = [(number[w], k) for k, w in enumerate(hot) if w in number]
        self.hot, self.hot_index = np.array([h for h, _ in held], np.int64), np.array([k for _, k in held], np.int64)


def discount(counts: np.ndarray) -> tuple[int, int]:
    """How many counts are 1 and how many 2."""
    return int((counts == 1).sum()), int((counts == 2).sum())


def discount_of(ones: int, twos: int) -> float:
    return float(np.clip(ones / max(1, ones + 2 * twos), 0.05, 0.95))


def log_stirling(d: float) -> np.ndarray:
    """log S(c, t) for c, t up to STIRLING."""
    log = np.full((STIRLING + 1, STIRLING + 1), -np.inf)
    log[0, 0] = 0
    t = np.arange(1, STIRLING + 1)
    with np.errstate(divide="ignore"):
        for c in range(1, STIRLING + 1):
            log[c, 1:] = np.logaddexp(log[c - 1, :-1], np.log(np.maximum(c - 1 - d * t, 0)) + log[c - 1, 1:])
    return log


def alone(d: float) -> np.ndarray:
    """S(c-1, t-1) / S(c, t) for c, t up to STIRLING: the probability that a customer sits alone."""
    log, t = log_stirling(d), np.arange(1, STIRLING + 1)
    out = np.ones((STIRLING + 1, STIRLING + 1))
    with np.errstate(invalid="ignore"):
        for c in range(1, STIRLING + 1):
            out[c, 1:] = np.where(t <= c, np.exp(log[c - 1, :-1] - log[c, 1:]), 1)
    return np.nan_to_num(out, nan=1.0)


def draw_few(c: int, a: np.ndarray, log: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of entries of c customers each, exactly by S(c, t) a^t."""
    t = np.arange(1, c + 1)
    p = log[c, 1 : c + 1] + np.log(a)[:, None] * t
    p = np.cumsum(np.exp(p - p.max(1, keepdims=True)), 1)
    return 1 + (p[:, :-1] <= (rng.random(len(a)) * p[:, -1])[:, None]).sum(1)


def draw_many(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of entries of many customers, by the mean and variance that S(c, t) a^t has in the limit.

    The sum of S(c, t) a^t x^c / c! over c and t is exp(a (1 - (1-x)^d) / d), so t is the number of a Poisson process of tables whose sizes
    add up to c. Where a x (1-x)^(d-1) = c, their expected number is m = a (1 - (1-x)^d) / d, and its variance given the sum is
    m - c (1-x) / (1 - d x). A binomial has both; for few tables it becomes 1 + Poisson(a / d), the limit for large c.
    """
    low, high = np.full(len(c), -700.0), np.zeros(len(c))  # of log(1-x)
    for _ in range(50):
        y = (low + high) / 2
        with np.errstate(divide="ignore"):
            less = np.log(a) + np.log(-np.expm1(y)) + (d - 1) * y < np.log(c)
        low, high = np.where(less, low, y), np.where(less, y, high)
    rest = np.exp(y)
    m = -a * np.expm1(d * y) / d
    q = np.clip(c * rest / (1 - d + d * rest) / np.maximum(m, 1e-300), 1e-9, 1 - 1e-9)  # 1 - variance / mean
    n = np.maximum(np.round(m / q), 1)
    return 1 + rng.binomial(n.astype(np.int64), np.minimum(m / n, 1))


class Level:
    """Tables of entries with c customers each; those of one customer always have one table."""

    def __init__(self, c: np.ndarray, d: float, rng: np.random.Generator, mass: np.ndarray) -> None:
        self.d, self.rng = d, rng
        self.log = log_stirling(d)
        self.reset(c, np.where(c > 0, np.maximum(1, np.round(1 + mass * np.log((mass + c) / (mass + 1)))), 0))

    def reset(self, c: np.ndarray, t: np.ndarray) -> None:
        self.c, self.t = c, np.clip(t, c > 0, c).astype(np.int64)

    def sweep(self, mass: np.ndarray) -> None:
        """Tables of all entries anew, given the mass of a new one."""
        order = np.argsort(self.c, kind="stable")
        counts = self.c[order]
        for c in np.unique(counts[(counts > 1) & (counts <= STIRLING)]).tolist():
            of = order[np.searchsorted(counts, c) : np.searchsorted(counts, c, "right")]
            step = max(1, 1_000_000 // c)
            for part in (of[i : i + step] for i in range(0, len(of), step)):
                self.t[part] = draw_few(c, mass[part], self.log, self.rng)
        large = order[np.searchsorted(counts, STIRLING, "right") :]
        if len(large):
            self.t[large] = np.minimum(draw_many(self.c[large], mass[large], self.d, self.rng), self.c[large])


class Seating:
    """The seating of a bucket's words, given the totals of all restaurants and the parent probabilities of frequent words."""

    def __init__(self, b: Bucket, number: int, d: float, root_d: float, tables: np.ndarray, customers: np.ndarray, root: tuple[float, float, int], p_hot: np.ndarray) -> None:
        self.p_hot = p_hot[b.hot_index]
        self.b, self.d, self.root_d, self.tables, self.total = b, d, root_d, tables, customers
        self.root_customers, self.root_tables, self.words = root
        rng = np.random.default_rng([SEED, number])
        known = np.maximum(b.counts, 0.5) / max(1.0, customers.sum())
        known[b.hot] = self.p_hot
        self.contexts = Level(b.customers, d, rng, self.mass(known))
        per_word = self.per_word()
        self.root = Level(per_word, root_d, rng, np.full(len(per_word), self.root_mass()))

    def mass(self, p_word: np.ndarray) -> np.ndarray:
        return (THETA + self.d * self.tables[self.b.context]) * p_word[self.b.word]

    def root_mass(self) -> float:
        return (ROOT_THETA + self.root_d * self.root_tables) / (self.words + 1)

    def tables_by_word(self) -> np.ndarray:
        return np.bincount(self.b.word, self.contexts.t, len(self.b.counts)).astype(np.int64)

    def per_word(self) -> np.ndarray:
        """Customers of the parent, but for frequent words, which other buckets hold too."""
        c = self.tables_by_word()
        c[self.b.hot] = 0
        return c

    def p_word(self) -> np.ndarray:
        p = (self.root.c - self.root_d * self.root.t + self.root_mass()) / (ROOT_THETA + self.root_customers)
        p[self.b.hot] = self.p_hot
        return p

    def sweep(self) -> None:
        self.contexts.sweep(self.mass(self.p_word()))
        c = self.per_word()
        self.root.reset(c, self.root.t)
        self.root.sweep(np.full(len(c), self.root_mass()))

    def samples(self) -> Iterator[int]:
        """Sweeps to each of the samples in turn; the same ones whenever it is run."""
        for _ in range(BURN_IN):
            self.sweep()
        for k in range(SAMPLES):
            self.sweep()
            yield k

    def predictive(self, of: dict) -> np.ndarray:
        """Given the totals of this very seating over all buckets, by which each context's probabilities add up to 1."""
        customers, tables = of["root"]
        p = (self.root.c - self.root_d * self.root.t + (ROOT_THETA + self.root_d * tables) / (self.words + 1)) / (ROOT_THETA + customers)
        p[self.b.hot] = of["p_hot"][self.b.hot_index]
        context = self.b.context
        back = (THETA + self.d * of["tables"][context]) * p[self.b.word]
        return (self.b.customers - self.d * self.contexts.t + back) / (THETA + self.total[context])


def frequent(hot_tables: np.ndarray, d: float, tables: int, customers: float, words: int, seed: int) -> tuple[int, np.ndarray]:
    """The parent's tables, with those of frequent words, whose customers are the tables of all buckets; and these words' probabilities."""
    mass = (ROOT_THETA + d * tables) / (words + 1)
    level = Level(hot_tables, d, np.random.default_rng([SEED, seed]), np.full(len(hot_tables), mass))
    level.sweep(np.full(len(hot_tables), mass))
    tables += int(level.t.sum())
    mass = (ROOT_THETA + d * tables) / (words + 1)
    return tables, (hot_tables - d * level.t + mass) / (ROOT_THETA + customers)


def totals(blobs: DataFrame, buckets: int, hot: dict[bytes, float]) -> dict:
    """The restaurants' totals, discounts and what is known of frequent words, after a first seating."""
    hot_list, shares = list(hot), np.array(list(hot.values()))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(pdf, hot_list)
        number = int(pdf["bucket"].iloc[0])
        customers = np.bincount(b.context, b.customers, CLASSES + 1)
        d = discount_of(*discount(b.customers))
        distinct = np.bincount(b.context, b.customers > 0, CLASSES + 1)
        own = b.counts > 0
        own[b.hot] = False
        words = int(own.sum())
        contexts = np.bincount(b.word, b.customers > 0, len(b.counts))[own]  # for the root's discount: a table a context
        # As if all buckets were like this one; the totals are summed over all before anything is scored.
        s = Seating(b, number, d, discount_of(*discount(contexts)), distinct * buckets, customers * buckets, (float(distinct.sum() * buckets), float(words * buckets), words * buckets), shares)
        for _ in range(BURN_IN):
            s.sweep()
        tables = np.bincount(b.context, s.contexts.t, CLASSES + 1)
        ones, twos = discount(b.customers)
        root_ones, root_twos = discount(contexts)
        parts = [
            {"m": np.arange(CLASSES + 1), "tables": tables, "customers": customers},
            {"m": [-1, -2, -3], "tables": [s.root.t.sum(), ones, root_ones], "customers": [words, twos, root_twos]},
            {"m": -4 - b.hot_index, "tables": s.tables_by_word()[b.hot], "customers": b.counts[b.hot]},
        ]
        return pd.concat([pd.DataFrame(p) for p in parts]).astype({"m": "int32", "tables": "int64", "customers": "int64"})

    with fleeting(blobs.sparkSession):
        out = blobs.groupBy("bucket").applyInPandas(run, "m int, tables long, customers long").groupBy("m").agg(F.sum("tables").alias("tables"), F.sum("customers").alias("customers"))
        found = {r["m"]: (r["tables"], r["customers"]) for r in out.collect()}  # CLASSES + 4 + HOT rows
    tables, customers = (np.array([found.get(m, (0, 0))[k] for m in range(CLASSES + 1)], float) for k in (0, 1))
    hot_tables, hot_counts = (np.array([found.get(-4 - i, (0, 0))[k] for i in range(len(hot))], np.int64) for k in (0, 1))
    root_tables, words = found.get(-1, (0, 0))
    words += int((hot_counts > 0).sum())
    d, root_d = discount_of(*found.get(-2, (0, 0))), discount_of(*found.get(-3, (0, 0)))
    root_tables, p_hot = frequent(hot_tables, root_d, root_tables, tables.sum(), words, 0)
    return {
        "tables": tables, "customers": customers, "root": (float(tables.sum()), float(root_tables), words), "d": d, "root_d": root_d,
        "p_hot": p_hot, "hot_counts": hot_counts, "hot": hot_list, "tokens": int(customers.sum()),
    }


def seated(pdf: pd.DataFrame, given: dict) -> Seating:
    b = Bucket(pdf, given["hot"])
    return Seating(b, int(pdf["bucket"].iloc[0]), given["d"], given["root_d"], given["tables"], given["customers"], given["root"], given["p_hot"])


def sample_totals(blobs: DataFrame, model: Broadcast) -> list[dict]:
    """For each sample, the restaurants' tables, the parent's customers and tables, and probabilities of frequent words."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s = seated(pdf, model.value)
        parts = []
        for k in s.samples():
            tables = np.bincount(s.b.context, s.contexts.t, CLASSES + 1)
            some = np.flatnonzero(tables)
            m = np.concatenate([some, [-1], -2 - s.b.hot_index])
            parts.append(pd.DataFrame({"k": k, "m": m, "tables": np.concatenate([tables[some], [s.root.t.sum()], s.tables_by_word()[s.b.hot]])}))
        return pd.concat(parts).astype({"k": "int32", "m": "int32", "tables": "int64"})

    given = model.value
    with fleeting(blobs.sparkSession):
        sums = blobs.groupBy("bucket").applyInPandas(run, "k int, m int, tables long").groupBy("k", "m").agg(F.sum("tables").alias("tables"))
        found = {(r["k"], r["m"]): r["tables"] for r in sums.collect()}  # SAMPLES * (CLASSES + 2 + HOT) rows
    out = []
    for k in range(SAMPLES):
        tables = np.array([found.get((k, m), 0) for m in range(CLASSES + 1)], float)
        hot_tables = np.array([found.get((k, -2 - i), 0) for i in range(len(given["hot"]))], np.int64)
        customers = float(tables.sum())
        root_tables, p_hot = frequent(hot_tables, given["root_d"], found.get((k, -1), 0), customers, given["root"][2], 1 + k)
        out.append({"tables": tables, "root": (customers, float(root_tables)), "p_hot": p_hot})
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of docs."""
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(size // BUCKET_BYTES))
    hot = hot_words(docs)
    packed = stage(pack_tokens(docs, buckets, hot), "tokens")
    blobs = packed.where("bucket IS NOT NULL").select("chunk", "bucket", "words", "many", "contexts", "places", "trains", "size")
    given = totals(blobs.drop("places", "size"), buckets, hot)
    n = given["tokens"]
    model = docs.sparkSession.sparkContext.broadcast(given)  # 2 * (CLASSES + 1) + 3 * HOT numbers
    own = docs.sparkSession.sparkContext.broadcast(sample_totals(blobs.drop("places", "size"), model))  # SAMPLES * (CLASSES + HOT + 3) numbers
    denominator = n + 0.1 * (given["root"][2] + 1)

    kinds = np.float64, np.float64, np.uint32

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s = seated(pdf, model.value)
        b = s.b
        mean = np.zeros(len(b.customers))
        for k in s.samples():
            mean += s.predictive(own.value[k]) / SAMPLES
        b.counts[b.hot] = model.value["hot_counts"][b.hot_index]
        # In steps of GRAIN, sums are the same in any order (up to 2 ** 53 steps), so equal texts have equal scores.
        logs = [np.round(v / GRAIN) * GRAIN for v in (np.log10(mean), np.log10((b.counts + 0.1) / denominator)[b.word])]
        values = *logs, (b.counts > 0)[b.word].astype(float)
        rows, at = [], 0
        for chunk, many, place in zip(b.chunks, b.docs, b.place, strict=True):
            of = b.of[at : at + len(place)]
            at += len(place)
            here = np.flatnonzero(np.bincount(place, minlength=many))  # few documents of a chunk, with many buckets
            rows.append((chunk, many, here.astype(np.uint16).tobytes(), *(np.bincount(place, v[of], many)[here].astype(k).tobytes() for v, k in zip(values, kinds, strict=True))))
        return pd.DataFrame(rows, columns=["chunk", "size", "places", "score", "base", "known"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        score, base, known = sums = [np.zeros(pdf["size"].iloc[0], k) for k in (np.float64, np.float64, np.int64)]
        for places, *parts in zip(pdf["places"], pdf["score"], pdf["base"], pdf["known"], strict=True):
            here = np.frombuffer(places, np.uint16)
            for of, part, kind in zip(sums, parts, kinds, strict=True):
                of[here] += np.frombuffer(part, kind)
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[0], "place": np.arange(len(score), dtype=np.int32), "score": score, "base_score": base, "n_known": known})

    parts = blobs.groupBy("bucket").applyInPandas(run, "chunk long, size int, places binary, score binary, base binary, known binary")
    sums = parts.groupBy("chunk").applyInPandas(add, "chunk long, place int, score double, base_score double, n_known long")
    rows = packed.where("bucket IS NULL").select("chunk", "place", "doc_id", "held_out", "n_tokens")
    return rows.join(sums, ["chunk", "place"]).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(scores: DataFrame) -> DataFrame:
    """held_out, perplexity: 10 ** -(sum of scores / tokens)."""
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


query = score
