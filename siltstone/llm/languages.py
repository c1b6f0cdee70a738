"""Language identification by nearest centroid: hashed character n-grams, TF-IDF, several centroids a language.

Texts are lower-cased; all but letters becomes a space; runs of 2 and 3 characters with a letter are hashed into WIDTH
columns. Vectors are (1 + log count) * idf, normalised; idf comes from all training documents. Some SAMPLE / languages training
documents of each language, chosen by a hash of their ids (an expected number: a share of each language is taken),
are clustered by spherical k-means into CENTROIDS centroids. A text goes to the language of the centroid of highest cosine.
It is rejected (a column of its own) if its distance, 1 - cosine, is above what nearly all of that language's sample
documents have; score is the softmax of the languages' best cosines.

Edge cases: null texts and texts without a letter are `und` with score 0; rows with null lang or null id are predicted, rows
with null lang are not learned from; without any training document all are `und`; a tie (equal cosines) goes to the language whose name
is first; a very long text is counted whole, in one vector of fixed width; repeated rows are answered each; an empty table gives an empty result; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import fold, id_and_text, with_own_id

WIDTH = 4096
SAMPLE = 4000
CENTROIDS = 4
REJECT_SHARE = 0.995
TEMPERATURE = 0.04
TOGETHER = 1_000_000  # characters worked on at once

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def groups(texts) -> Iterator[list[str]]:
    """Texts, lower-cased, some TOGETHER characters or 256 texts at a time."""
    part, size = [], 0
    for t in texts:
        t = (t or "").lower()
        part.append(t)
        size += len(t)
        if size >= TOGETHER or len(part) == 256:
            yield part
            part, size = [], 0
    if part:
        yield part


def count(part: list[str]) -> np.ndarray:
    """N-gram counts, a row for each text."""
    codes = np.frombuffer("\n".join([*part, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(part)), [len(t) + 1 for t in part])
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, 32)
    out = np.zeros(len(part) * WIDTH, np.float32)
    for n, mix in ((2, 40503), (3, 2654435761)):
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        value, some, same = codes[:last].copy(), is_letter[:last].copy(), row[:last] == row[n - 1 :]
        for k in range(1, n):
            value = value * 1_000_003 + codes[k : k + last]
            some |= is_letter[k : k + last]
        column = (value * mix >> 7) % WIDTH
        out += np.bincount((row[:last] * WIDTH + column)[some & same], minlength=len(out)).astype(np.float32)
    return out.reshape(len(part), WIDTH)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def cluster(v: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means from the documents farthest from those chosen before."""
    chosen = [int((v @ v.mean(0)).argmax())]
    while len(chosen) < min(k, len(v)):
        chosen.append(int((v @ v[chosen].T).max(1).argmin()))
    centroids = v[chosen]
    for _ in range(rounds):
        own = (v @ centroids.T).argmax(1)
        centroids = np.stack([v[own == c].sum(0) if (own == c).any() else centroids[c] for c in range(len(chosen))])
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-9)
    return centroids


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log((n + 1) / (df + 1)) + 1 of each column, over all documents given."""

    def run(batches):
        total, n = np.zeros(WIDTH, np.int64), 0
        for b in batches:
            for part in groups(b["text"]):
                total += (count(part) > 0).sum(0)
                n += len(part)
        yield pd.DataFrame({"c": np.arange(-1, WIDTH), "n": [n, *total]})

    rows = docs.select("text").mapInPandas(run, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()  # WIDTH + 1 rows
    df = {r["c"]: r["n"] for r in rows}
    return (np.log((df.get(-1, 0) + 1) / (np.array([df.get(c, 0) for c in range(WIDTH)]) + 1)) + 1).astype(np.float32)


def fit(training: DataFrame):
    """(idf, centroids, language of each centroid, greatest distance of each language) from (doc_id, text, lang)."""
    training = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = {r["lang"]: r["n"] for r in training.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not langs:
        return None
    idf = inverse_frequencies(training)
    size = SAMPLE / len(langs)
    share = F.lit(0.0)
    for lang, n in sorted(langs.items()):
        share = F.when(F.col("lang") == lang, min(1.0, size / n)).otherwise(share)
    picked = F.pmod(F.xxhash64("row"), F.lit(1_000_000)) / 1_000_000 < share  # by row, as ids may be null or repeated

    def run(batches):
        for b in batches:
            done = 0
            for part in groups(b["text"]):
                v = vectors(count(part), idf).astype(np.float16)
                yield pd.DataFrame({"lang": b["lang"].iloc[done : done + len(part)].to_numpy(), "v": [x.tobytes() for x in v]})
                done += len(part)

    rows = training.select("text", "lang", F.monotonically_increasing_id().alias("row")).where(picked).select("text", "lang").mapInPandas(run, "lang string, v binary").collect()
    centroids, names, far = [], [], {}
    for lang in sorted(langs):
        own = sorted(r["v"] for r in rows if r["lang"] == lang)
        if not own:
            continue
        v = np.frombuffer(b"".join(own), np.float16).reshape(len(own), WIDTH).astype(np.float32)
        v = v[np.linalg.norm(v, axis=1) > 0.5]
        if not len(v):
            continue
        c = cluster(v, CENTROIDS)
        far[lang] = float(np.quantile(1 - (v @ c.T).max(1), REJECT_SHARE))
        centroids.append(c)
        names += [lang] * len(c)
    return (idf, np.concatenate(centroids), names, far) if centroids else None


def identify(docs: DataFrame, model) -> DataFrame:
    """doc_id, lang_pred, score, distance, rejected."""
    model = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH * CENTROIDS numbers a language

    def run(batches):
        found = model.value
        if found:
            idf, centroids, names, far = found
            langs = sorted(set(names))
            own = [[i for i, n in enumerate(names) if n == lang] for lang in langs]
        for b in batches:
            done = 0
            for part in groups(b["text"]):
                counts = count(part)
                none = counts.sum(1) == 0
                if not found:
                    pred, score, distance, rejected = np.array(["und"] * len(part), object), np.zeros(len(part)), np.ones(len(part)), np.ones(len(part), bool)
                else:
                    cosine = vectors(counts, idf) @ centroids.T
                    best = np.stack([cosine[:, i].max(1) for i in own], 1)
                    k = best.argmax(1)
                    soft = np.exp((best - best.max(1, keepdims=True)) / TEMPERATURE)
                    score = np.where(none, 0.0, 1 / soft.sum(1))
                    pred = np.where(none, "und", np.array(langs, object)[k])
                    distance = np.where(none, 1.0, np.clip(1 - best.max(1), 0, 1)).astype(float)
                    rejected = none | (distance > np.array([far[lang] for lang in langs])[k])
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[done : done + len(part)].to_numpy(), "lang_pred": pred, "score": score, "distance": distance, "rejected": rejected})
                done += len(part)

    out = id_and_text(docs).mapInPandas(run, "doc_id string, lang_pred string, score double, distance double, rejected boolean")
    return with_own_id(out, docs)


def query(docs: DataFrame) -> DataFrame:
    held = fold(F.col("doc_id"), 4) == 2
    out = identify(docs, fit(docs.select("doc_id", "text", "lang").where(~held)))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "distance", "rejected")
