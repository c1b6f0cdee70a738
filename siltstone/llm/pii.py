"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns (email, ip, card, phone) give the base spans, which always stay. The random field labels the tokens that
hold a digit or an @ with O, one of the four kinds or "secret" (keys, passwords, access tokens). Neighbouring tokens are
linked in a chain; all equal ones (ignoring case) are linked by skip edges to one hub, so that any two are two steps apart,
and a token new to the text to the last similar one before it (same domain of an address, same first eight characters). So the
number of edges grows with the tokens and not with their pairs. A hub is a node that has the features of its first
occurrence with a cue, if any; half of what it hears is this one's message and half the mean of all others', as many without a
cue are no more evidence than one. Loopy sum-product message passing, until a document's messages stop changing, gives each token's label
probabilities, which so agree across the document; a token at CERTAIN or more that no base span touches becomes a span of its own.

Weights are learned by pseudo-likelihood from SAMPLE rows (expected: a share of all by a hash of the row's number); of a row
with more than SAMPLE_TOKENS such tokens, a stretch of that many at a place by a hash of the text. Base spans, long mixed tokens after a cue such as
`token =`, and tokens equal to one of these in the document, are their labels. Tokens without a digit or an @ are no nodes: a password of letters
only is not found.

Edge cases: null and empty texts have no spans; a token whose likeliest labels tie takes the first in the order of LABELS; texts of any length are
worked on whole, those of many tokens by themselves, with some hundred bytes for each token; repeated rows are answered each; an
empty table gives an empty result (and no weights); columns other than doc_id and text are ignored. Patterns are matched in time linear
in a text's length.
"""

from __future__ import annotations

import pickle
import re
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import id_and_text, with_own_id

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("O", *KINDS)
SAMPLE, SAMPLE_TOKENS = 20_000, 64
CERTAIN = 0.9
WIDTH = 1 << 12  # hashed features
#: Messages that change by less have stopped; after each PATIENCE rounds they are damped more, so that cycles stop too.
STILL, PATIENCE = 1e-4, 100
#: Tokens of several texts, and edges of one, that are worked on at once.
TOGETHER, EDGES = 20_000, 1 << 17

LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive digits: a start within a run of digits fails where the run's first digit does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
CUE = re.compile(r"(?i)(?:token|secret|key|passw\w{0,4}|pwd|bearer|credential)s?[\"']?\s{0,3}[=:]?\s{0,3}[\"']?\Z")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: each starts as far left of its @ as the last match allows."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at)  # nothing left of this @ can start a later match
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end), sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = m.group().split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _shape(core: str) -> str:
    s = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "0", core)))
    return s[:12]


def tokens(text: str) -> list[tuple[int, int]]:
    """The cores of the tokens with a digit or an @: without marks at both ends."""
    out, done = [], 0
    for m in TOKEN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] not in " \t\n\v\f\r":
            start -= 1
        end = m.end()
        done = end
        while end > start and not (text[end - 1].isalnum() and text[end - 1] < "\x7f"):
            end -= 1
        while start < end and not (text[start].isalnum() and text[start] < "\x7f"):
            start += 1
        if start < end:
            out.append((start, end))
    return out


def graph(text: str, base: list[tuple[int, int, int]]):
    """Tokens, their feature ids, weak labels (both with those of hubs after them), chain edges, edges from hubs to equal tokens, edges to similar tokens."""
    spans = tokens(text)
    feats, labels, chain, equal, similar = array("H"), array("b"), array("q"), array("q"), array("q")
    places: dict = {}
    near: dict = {}
    known: dict = {}
    keys: list = []
    width = 0
    b = 0
    for i, (s, e) in enumerate(spans):
        core = text[s:e]
        digits = sum(c.isdigit() for c in core)
        mixed = digits > 0 and any(c.isalpha() for c in core) and core.isalnum()
        octets = core.split(".")
        cue, plus = bool(CUE.search(text[max(0, s - 24) : s])), text[max(0, s - 1) : s] == "+"
        names = [
            "bias", f"shape={_shape(core)}", f"len={min(len(core).bit_length(), 8)}", f"digits={min(digits, 20)}", f"at={'@' in core}", f"dots={min(core.count('.'), 5)}",
            f"cue={cue}", f"mixed={mixed}", f"cue,mixed={cue},{mixed and len(core) >= 16}", f"plus={plus}",
            f"luhn={core.isdigit() and 14 <= digits <= 19 and luhn(core)}", f"octets={len(octets) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in octets)}",
        ]
        feats.extend([zlib.crc32(n.encode()) % WIDTH for n in names])
        width = len(names)
        while b < len(base) and base[b][2] <= s:
            b += 1
        kind = next((k for a, k, z in base[b : b + 4] if a < e and z > s), None)
        labels.append(1 + kind if kind is not None else 5 if cue and mixed and len(core) >= 16 else 0)
        if i and s - spans[i - 1][1] <= 12:
            chain.extend((i - 1, i))
        key = core.lower()
        like = key.split("@")[1] if "@" in key else key[:8] if len(key) >= 12 else None
        if key not in places and like is not None and like in near:
            similar.extend((near[like], i))
        if labels[i]:
            known[key] = labels[i]
        keys.append(key)
        best = (not cue, not plus, i)
        held = places.get(key)
        if held is None:
            places[key] = best
        else:  # equal tokens: the best one and, in order, all
            if isinstance(held, tuple):
                held = places[key] = [held, array("q", [held[2]])]
            held[0] = min(held[0], best)
            held[1].append(i)
        if like is not None:
            near[like] = i
    for i, key in enumerate(keys):
        labels[i] = labels[i] or known.get(key, 0)  # equal tokens have one weak label
    nodes = len(spans)
    for key, held in places.items():
        if isinstance(held, list):
            (_, _, first), at = held
            for i in (first, *(i for i in at if i != first)):  # the one with a cue first
                equal.extend((nodes, i))
            feats.extend(feats[first * width : (first + 1) * width])
            labels.append(known.get(key, 0))
            nodes += 1
    pairs = [np.array(x, np.int64).reshape(-1, 2) for x in (chain, equal, similar)]
    return np.array(spans, np.int64).reshape(-1, 2), np.array(feats, np.uint16).reshape(nodes, -1 if nodes else 0), np.array(labels, np.int8), *pairs


def _stack(graphs):
    """Many documents as one graph: features, labels, edges by type, and what a message to the first end of an edge weighs."""
    offsets = np.cumsum([0, *[len(g[2]) for g in graphs]])
    offset = int(offsets[-1])
    some = [g for g in graphs if len(g[2])]
    feats = np.concatenate([g[1] for g in some]) if some else np.zeros((0, 0), np.uint16)
    labels = np.concatenate([np.zeros(0, np.int64), *[g[2] for g in some]])
    edges = [np.concatenate([np.zeros((0, 2), np.int64), *[g[3 + t] + o for g, o in zip(graphs, offsets, strict=False)]]) for t in range(3)]
    shares = [np.ones(len(e)) for e in edges]
    hub = edges[1][:, 0]
    shares[1] /= 2 * np.maximum(1, np.bincount(hub, minlength=offset)[hub] - 1)
    shares[1][np.diff(hub, prepend=-1) != 0] = 0.5
    return feats, labels, edges, shares


def _softmax(x):
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def train(graphs, steps: int = 200, rate: float = 0.5, decay: float = 1e-3):
    """(token weights, pair weights of the three edge types) by pseudo-likelihood, with Adagrad."""
    k = len(LABELS)
    node, pair = np.zeros((WIDTH, k)), np.zeros((3, k, k))
    feats, labels, edges, shares = _stack(graphs)
    if not len(labels):
        return node, pair
    sum_node, sum_pair = np.full_like(node, 1e-8), np.full_like(pair, 1e-8)
    truth = np.eye(k)[labels]
    for _ in range(steps):
        score = node[feats].sum(1)
        for t, (e, w) in enumerate(zip(edges, shares, strict=True)):
            np.add.at(score, e[:, 1], pair[t][labels[e[:, 0]]])
            np.add.at(score, e[:, 0], w[:, None] * pair[t][:, labels[e[:, 1]]].T)
        gap = (truth - _softmax(score)) / len(labels)
        g_node, g_pair = -decay / len(labels) * node, -decay / len(labels) * pair
        for j in range(feats.shape[1]):
            np.add.at(g_node, feats[:, j], gap)
        for t, (e, w) in enumerate(zip(edges, shares, strict=True)):
            np.add.at(g_pair[t], labels[e[:, 0]], gap[e[:, 1]])
            np.add.at(g_pair[t].T, labels[e[:, 1]], w[:, None] * gap[e[:, 0]])
        for w, g, s in ((node, g_node, sum_node), (pair, g_pair, sum_pair)):
            s += g * g
            w += rate * g / np.sqrt(s)
    return node, pair


def _local(node: np.ndarray, feats: np.ndarray) -> np.ndarray:
    out = np.zeros((len(feats), len(LABELS)))
    for column in feats.T:
        out += node[column]
    return out


class _Edges:
    """Edges of one type with their messages forth and back, and the places of both in the whole graph."""

    def __init__(self, ends, share, doc, pair, place=None, forth=None, back=None) -> None:
        self.ends, self.share, self.doc, self.pair = ends, share, doc, pair
        self.place = np.arange(len(ends)) if place is None else place
        self.forth = np.zeros((len(ends), len(LABELS)), np.float32) if forth is None else forth
        self.back = np.zeros((len(ends), len(LABELS)), np.float32) if back is None else back

    def part(self, rows: np.ndarray) -> _Edges:
        return _Edges(self.ends[rows], self.share[rows], self.doc[rows], self.pair, self.place[rows], self.forth[rows], self.back[rows])

    def add_to(self, belief: np.ndarray) -> None:
        for j in range(len(LABELS)):
            belief[:, j] += np.bincount(self.ends[:, 1], self.forth[:, j], len(belief))
            belief[:, j] += np.bincount(self.ends[:, 0], self.share * self.back[:, j], len(belief))

    def step(self, belief: np.ndarray, damp: float, moved: np.ndarray) -> None:
        """One round of messages; moved takes the greatest change of each document."""

        def sent(out: np.ndarray, table: np.ndarray) -> np.ndarray:
            new = np.log(np.exp(out - out.max(1, keepdims=True)) @ table)
            return new - new.max(1, keepdims=True)

        table = np.exp(self.pair)
        for a in range(0, len(self.ends), EDGES):
            at = slice(a, a + EDGES)
            ends, forth, back = self.ends[at], self.forth[at], self.back[at]
            one = damp * (sent(belief[ends[:, 0]] - self.share[at, None] * back, table) - forth)
            two = damp * (sent(belief[ends[:, 1]] - forth, table.T) - back)
            forth += one.astype(np.float32)
            back += two.astype(np.float32)
            np.maximum.at(moved, self.doc[at], np.maximum(np.abs(one).max(1), np.abs(two).max(1)))


def marginals(graphs, weights) -> np.ndarray:
    """Label probabilities of all tokens by loopy sum-product message passing; a document's goes on until its messages have stopped."""
    node, pair = weights
    feats, _, edges, shares = _stack(graphs)
    local = _local(node, feats) if len(feats) else np.zeros((0, len(LABELS)))
    is_token = np.concatenate([np.zeros(0, bool), *[np.arange(len(g[2])) < len(g[0]) for g in graphs]])
    of = np.repeat(np.arange(len(graphs)), [len(g[2]) for g in graphs])
    done = [_Edges(e, s, of[e[:, 0]], p) for e, s, p in zip(edges, shares, pair, strict=True)]
    live, rounds = [d.part(np.arange(len(d.ends))) for d in done], 0
    while any(len(x.ends) for x in live):
        belief, moved = local.copy(), np.zeros(len(graphs))
        for x in live:
            x.add_to(belief)
        for x in live:
            x.step(belief, 0.5 ** (1 + rounds // PATIENCE), moved)
        rounds += 1
        still = [moved[x.doc] < STILL for x in live]
        if 4 * sum(int(s.sum()) for s in still) >= sum(len(s) for s in still):
            for x, d, s in zip(live, done, still, strict=True):
                d.forth[x.place[s]], d.back[x.place[s]] = x.forth[s], x.back[s]
            live = [x.part(np.flatnonzero(~s)) for x, s in zip(live, still, strict=True)]
    belief = local.copy()
    for d in done:
        d.add_to(belief)
    return _softmax(belief[is_token])


def stretch(text: str) -> str:
    """The text, or its part of SAMPLE_TOKENS tokens at a place by hash, with what stands before the first."""
    held = tokens(text)
    if len(held) <= SAMPLE_TOKENS:
        return text
    a = zlib.crc32(text.encode("utf-8", "surrogatepass")) % (len(held) - SAMPLE_TOKENS + 1)
    return text[max(held[a - 1][1] if a else 0, held[a][0] - 24) : held[a + SAMPLE_TOKENS - 1][1]]


def fit(docs: DataFrame):
    """Weights from a sample of the documents."""

    def run(batches):
        for b in batches:
            rows = []
            for text in b["text"]:
                if TOKEN.search(text):
                    text = stretch(text)
                    g = graph(text, base_spans(text))
                    if len(g[0]):
                        rows.append((zlib.crc32(text.encode("utf-8", "surrogatepass")), pickle.dumps(g)))
            yield pd.DataFrame(rows, columns=["h", "g"])

    share = min(1.0, SAMPLE / max(1, docs.count()))
    rows = docs.select("text", F.monotonically_increasing_id().alias("row"))
    sample = rows.where(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) / 1_000_000 < share).where(F.col("text").isNotNull()).select("text")
    rows = sorted((r["h"], bytes(r["g"])) for r in sample.mapInPandas(run, "h long, g binary").collect())
    return train([pickle.loads(g) for _, g in rows])


def find(texts, weights):
    """For each text (start, index in KINDS, end, from the base) sorted by start and kind."""
    out, held, size = [], [], 0
    for text in texts:
        text = text or ""
        base = base_spans(text)
        g = graph(text, base) if TOKEN.search(text) else graph("", [])
        if held and size + len(g[0]) > TOGETHER:
            out += _found(held, weights)
            held, size = [], 0
        held.append((text, base, g))
        size += len(g[0])
    return out + _found(held, weights)


def _found(held, weights):
    out, offset = [], 0
    prob = marginals([g for _, _, g in held], weights)
    for text, base, g in held:
        found = [(*b, True) for b in base]
        best = prob[offset : offset + len(g[0])]
        offset += len(g[0])
        kinds = best.argmax(1)
        b = 0
        for i in np.flatnonzero((kinds > 0) & (best.max(1) >= CERTAIN)):
            (s, e), k = g[0][i].tolist(), int(kinds[i])
            while b < len(base) and base[b][2] <= s:
                b += 1
            if not any(a < e and z > s for a, _, z in base[b : b + 4]):
                joins = found and not found[-1][3] and found[-1][1] == k - 1 and not text[found[-1][2] : s].strip()
                if joins:  # parts of one number
                    s = found.pop()[0]
                found.append((s, k - 1, e, False))
        out.append(sorted(found))
    return out


def spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, base), by start and kind; offsets in code points."""
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs))  # WIDTH * 6 numbers

    def run(batches):
        for b in batches:
            found = find(list(b["text"]), weights.value)
            yield pd.DataFrame({"doc_id": b["doc_id"], "spans": [[{"kind": KINDS[k], "start": s, "end": e, "base": o} for s, k, e, o in f] for f in found]})

    out = id_and_text(docs).mapInPandas(run, "doc_id string, spans array<struct<kind:string,start:long,end:long,base:boolean>>")
    return with_own_id(out, docs)


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span of text replaced by its kind, as in <EMAIL>; a column n_chars follows, all others stay."""
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs))

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, find(list(texts), weights.value), strict=True):
            parts, at = [], 0
            for s, k, e, _ in found:
                if s >= at:
                    parts += [text[at:s], f"<{KINDS[k].upper()}>"]
                at = max(at, e)
            out.append("".join([*parts, text[at:]]) if found else text)
        return pd.Series(out, dtype=object)

    out = docs.withColumn("text", masked("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def query(docs: DataFrame) -> DataFrame:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return spans(docs).select(
        "doc_id", *[count(k) for k in KINDS[:4]],
        F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", one), ",").alias("spans"),
    )
