"""Quality by compression: zstandard dictionaries of good and of bad text, compared on each document.

One half of the training sample gives two dictionaries (PIECES pieces of at most PIECE bytes a class, cut from whole
texts and chosen by hash); the other half is compressed with both. A document's number is the difference of its compressed sizes,
normalised by its own size: (bad - good) / bytes. Isotonic regression on the second half makes it a probability; nothing else is
looked at. Whole texts are compressed.

Edge cases: null and empty texts have the number 0 and are scored; a tie (equal numbers) is an equal score; a very long text is compressed
as one; repeated rows are scored each; a doc_id labelled twice counts with its largest label, one with several texts with the least;
null labels and ids are not learned from; without labels of both kinds all scores are their mean (0 if there are none); an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import isotonic, sigmoid
from .columns import fold
from .toxicity import labelled_sample, sample_texts

SAMPLE = 6000
PIECES, PIECE = 3000, 4096
DICTIONARY = 112_640
LEVEL = 3
THRESHOLD = 0.7


class Difference:
    """The normalised difference of a text's compressed sizes with the bad and with the good dictionary."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.by = [zstandard.ZstdCompressor(**plain, **({"dict_data": zstandard.ZstdCompressionDict(d)} if d else {})) for d in (good, bad)]

    def __call__(self, text: str | None) -> float:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0
        good, bad = (len(c.compress(raw)) for c in self.by)
        return (bad - good) / len(raw)


class Calibration:
    """Rising probabilities of numbers, by isotonic regression; a logistic curve breaks ties within a hundredth."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.constant = float(np.average(y, weights=weight)) if len(y) else 0.0
        self.apart = len(y) >= 10 and len(set(y.tolist())) == 2
        if self.apart:
            self.at, self.value = isotonic(x, y, weight)
            self.scale = float(x.std()) or 1.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.apart:
            return np.full(len(x), self.constant)
        return np.clip(0.99 * np.interp(x, self.at, self.value) + 0.01 * sigmoid(x / self.scale), 0, 1)


def dictionary(sample: DataFrame, label: int) -> bytes:
    """A dictionary from the pieces of lowest hash of the class's texts."""

    def run(batches):
        for b in batches:
            rows = []
            for text in b["text"]:
                raw = text.encode("utf-8", "surrogatepass")
                pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
                rows += [(zlib.crc32(p), p) for p in pieces if len(p) >= 32]
            yield pd.DataFrame(rows, columns=["h", "piece"])

    pieces = sample.where(F.col("label") == label).select("text").mapInPandas(run, "h long, piece binary")
    rows = [bytes(r["piece"]) for r in pieces.distinct().orderBy("h", "piece").limit(PIECES).collect()]  # at most 12 MB
    if len(rows) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, sum(map(len, rows)) // 10)), rows).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b""


def fit(docs: DataFrame, labels: DataFrame, training):
    """(good dictionary, bad dictionary, calibration)."""
    rows, totals = labelled_sample(labels, "quality", training, SAMPLE)
    sample = sample_texts(docs, rows)
    first = sample.where("half = 0")
    good, bad = dictionary(first, 1), dictionary(first, 0)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        difference = Difference(good, bad)
        return pd.Series([difference(t) for t in texts], dtype="float64")

    scored = sample.where("half = 1").select("label", run("text").alias("x")).collect()  # at most 2 * SAMPLE
    scored.sort(key=lambda r: (r["x"], r["label"]))
    x, y = np.array([r["x"] for r in scored], float), np.array([r["label"] for r in scored], float)
    weight = np.array([totals[int(v)] / max(1, (y == v).sum()) for v in y])
    return good, bad, Calibration(x, y, weight / weight.mean() if len(y) else weight)


def scorer(model):
    """A column function: text to the probability of good quality."""
    good, bad, calibration = model

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        difference = Difference(good, bad)
        for texts in batches:
            yield pd.Series(calibration(np.array([difference(t) for t in texts], float)))

    return run


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = fold(F.col("doc_id"), 4) == 2
    score = scorer(fit(docs, labels, ~held))
    out = docs.select("doc_id", held.alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
