"""Harmonic packing of documents into sequences of a fixed capacity.

A document becomes its token ids and one end id. It is cut greedily into pieces whose lengths are
capacity // k for k = 1 ... 16, which leaves a rest shorter than capacity // 16. Each length is a reciprocal-capacity
class: its bins hold exactly capacity // length pieces, so a bin of a class is short by less than one token a piece
(all pieces of a class are equally long; for the rests of r tokens, by less than r). Workers cut and number the
pieces of their partitions on their own; a table of counts by partition and class (as long as there are
partitions) then gives each worker the place at which its bins begin, so that bins are filled without moving text or ids.
What the last bin of each class lacks is at most capacity // length - 1 pieces, some 5,000 small pieces over all
classes whatever the input; these are packed first-fit decreasing.

Edge cases: null and empty texts are the end id alone; null ids, repeated rows and texts of any length are packed as they
come; an empty table gives no sequences; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import stage
from .columns import id_and_text, with_own_id

CAPACITY = 1024
EXACT = 16
#: tiktoken and tokenizers agree on these code points; a text with others goes through tokenizers itself.
PLAIN = re.compile("[^\x00-ɏ]")


class Encoder:
    """Ids as the tokenizers library gives them for the JSON of a byte-level BPE."""

    def __init__(self, source: str) -> None:
        import tiktoken

        spec = json.loads(source)
        # Byte-level vocabularies write each byte as a printable character.
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(shown[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.quick = tiktoken.Encoding("bytes", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        self.source, self.exact = source, None

    def encode(self, text: str) -> list[int]:
        if PLAIN.search(text) or any(s in text for s in self.special):
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_str(self.source)
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)


def class_lengths(capacity: int = CAPACITY) -> list[int]:
    """Rising: every length below capacity // 16, then capacity // k for k = 16 ... 1."""
    least = max(1, capacity // EXACT)
    return sorted({*range(1, least), *(capacity // k for k in range(1, min(EXACT, capacity) + 1))})


def cut(n: int, lengths: list[int]) -> list[int]:
    """Lengths of the pieces of n tokens, greatest first."""
    full, rest = divmod(n, lengths[-1])
    out = [lengths[-1]] * full
    while rest:
        out.append(lengths[bisect_right(lengths, rest) - 1])
        rest -= out[-1]
    return out


def first_fit_decreasing(pieces: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, rank) of the few last pieces to (length, rank, bin, offset)."""
    used: list[int] = []
    out, first, last = [], 0, None
    for length, rank in sorted(pieces, reverse=True):
        first = first if length == last else 0  # bins that had no room for this length have none later either
        last = length
        while first < len(used) and used[first] + length > capacity:
            first += 1
        if first == len(used):
            used.append(0)
        out.append((length, rank, first, used[first]))
        used[first] += length
    return out


def cut_documents(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY) -> DataFrame:
    """(part, length, local, doc_id, start, doc_tokens, ids): pieces, numbered by partition and length.

    ids are little-endian unsigned 32-bit numbers.
    """
    source = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a vocabulary file: 2 MB or so
    lengths = class_lengths(capacity)

    def pieces(batches):
        encoder, part, seen = Encoder(source.value), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encoder.encode(text or ""), 0], "<u4")
                start = 0
                for n in cut(len(ids), lengths):
                    rows.append((part, n, seen[n], doc_id, start, len(ids), ids[start : start + n].tobytes()))
                    seen[n] += 1
                    start += n
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    names = ["part", "length", "local", "doc_id", "start", "doc_tokens", "ids"]
    out = id_and_text(docs).mapInPandas(pieces, "part int, length int, local long, doc_id string, start long, doc_tokens long, ids binary")
    return with_own_id(out, docs)


def pack(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, digest=None) -> DataFrame:
    """Pieces with sequence_id (0, 1, ...) and offset. digest: columns in place of ids, from the staged ids."""
    spark = docs.sparkSession
    pieces = stage(cut_documents(docs, tokenizer_json, capacity), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "counts")

    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each class
    bins, classes, rest = 0, [], []
    for length in sorted(totals, reverse=True):
        each = capacity // length
        full = totals[length] // each
        classes.append((length, each, bins, full * each))
        rest += [(length, rank) for rank in range(full * each, totals[length])]
        bins += full
    last = [(n, rank, bins + b, o) for n, rank, b, o in first_fit_decreasing(rest, capacity)]
    classes = spark.createDataFrame(classes, "length int, each int, first_bin long, whole long")
    last = spark.createDataFrame(last, "length int, rank long, last_bin long, last_offset long")

    kept = pieces.select("part", "length", "local", "doc_id", "start", "doc_tokens", *(digest or ["ids"]))
    ranked = kept.join(counts.drop("n"), ["part", "length"]).withColumn("rank", F.col("first") + F.col("local"))
    placed = ranked.join(F.broadcast(classes), "length").join(F.broadcast(last), ["length", "rank"], "left")
    whole = F.col("rank") < F.col("whole")
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), *[c for c in kept.columns[6:]], "doc_tokens",
        F.when(whole, F.col("first_bin") + F.floor(F.col("rank") / F.col("each"))).otherwise(F.col("last_bin")).cast("long").alias("sequence_id"),
        F.when(whole, F.col("rank") % F.col("each") * F.col("length")).otherwise(F.col("last_offset")).cast("long").alias("offset"),
    )


def query(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    return pack(docs, tokenizer_json, digest=[F.crc32("ids").alias("ids_crc32")])
