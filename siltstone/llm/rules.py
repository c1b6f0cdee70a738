"""Quality rules by weak supervision: rules vote or abstain, EM estimates how they err, a posterior decides.

Each rule votes good (1), bad (-1) or abstains (0). Rules are taken as independent given the true class (Dawid and
Skene's model): P(vote | class) of each rule and the share of good documents are estimated by expectation-maximisation over
the counts of vote patterns in all documents. There are at most 3 ** 10 = 59,049 patterns however many documents
there are; only their counts reach the driver. A document is kept if P(good | votes) is at least THRESHOLD and the base
rules don't fail it.

Edge cases: null text has no words and fails the base rules, as empty texts do; repeated rows are judged each; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .columns import id_and_text, with_own_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW = 8
THRESHOLD = 0.5

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct long, n_top long, n_upper long, n_marks long, n_pipes long"


def repeated_words(words: list[str], size: int = WINDOW) -> int:
    """Words in windows of size (a power of two) words that occur twice or more."""
    n = len(words)
    if n <= size:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == n:
        return 0
    span = 1
    while span < size:  # names for windows of twice the length, from pairs of names
        pairs = ids[:-span] * (int(ids.max()) + 1) + ids[span:]
        _, ids = np.unique(pairs, return_inverse=True)
        span *= 2
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The columns of FEATURES for one text."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    counts = Counter(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), len(counts), max(counts.values(), default=0),
        sum(w.isupper() for w in words), text.count("!") + text.count("?"), text.count("|"),
    )


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the columns of FEATURES, in one pass without a shuffle."""
    names = ["doc_id", *(x.split()[0] for x in FEATURES.split(", "))]

    def run(batches):
        for b in batches:
            yield pd.DataFrame([(i, *measure(t)) for i, t in zip(b["doc_id"], b["text"], strict=True)], columns=names)

    return with_own_id(id_and_text(docs).mapInPandas(run, f"doc_id string, {FEATURES}"), docs)


def _rule(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b))


def rules() -> dict[str, Column]:
    """Each rule's vote. A share votes good up to its first bound and bad above its second."""
    size, length = F.col("n_words"), _share("word_chars", "n_words")
    shares = {
        "symbols": (_share("n_symbols", "word_chars"), 0.01, 0.1),
        "dup_lines": (_share("n_dup_lines", "n_lines"), 0.0, 0.3),
        "repeats": (_share("n_repeat_words", "n_words"), 0.02, 0.2),
        "upper": (_share("n_upper", "n_words"), 0.1, 0.3),
        "marks": (_share("n_marks", "n_words"), 0.05, 0.2),
        "pipes": (_share("n_pipes", "n_words"), 0.01, 0.1),
        "top": (_share("n_top", "n_words"), 0.12, 0.2),
        "same": (1 - _share("n_distinct", "n_words"), 0.6, 0.85),
    }
    out = {"length": _rule(size, size >= 50, size < 20), "word_length": _rule(length, length.between(3, 9), (length < 2) | (length > 12))}
    return out | {name: _rule(v, v <= good, v > bad) for name, (v, good, bad) in shares.items()}


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """EM over distinct vote patterns: the share of good, and P(vote | class) [class: bad, good][rule][vote + 1]."""
    onehot = (votes[:, :, None] + 1 == np.arange(3)).astype(float)
    # Rules are better than chance: at first, a pattern is the likelier good the fewer bad votes it has.
    good = 0.95 * 0.25 ** (votes < 0).sum(1)
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        share = (weight[1].sum() + 2) / (counts.sum() + 4)
        table = np.einsum("cp,prv->crv", weight, onehot) + 0.5
        table /= table.sum(2, keepdims=True)
        new = posterior(votes, share, table)
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return share, table


def posterior(votes: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    odds = np.log(share / (1 - share)) + np.log(table[1] / table[0])[np.arange(votes.shape[1]), votes + 1].sum(1)
    return 1 / (1 + np.exp(-odds))


def judge(docs: DataFrame) -> DataFrame:
    """Features, one vote_<rule> column a rule, p_good, base_failed and kept, a row per document."""
    f = stage(features(docs), "features")
    names = [f"vote_{k}" for k in rules()]
    f = f.select("*", *[v.alias(f"vote_{k}") for k, v in rules().items()])
    seen = f.groupBy(*names).agg(F.count("*").alias("n")).collect()  # at most 3 ** len(names)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    if not seen:
        return f.select("*", F.lit(0.0).alias("p_good"), failed.alias("base_failed"), F.lit(False).alias("kept"))
    share, table = fit(np.array([[r[k] for k in names] for r in seen]), np.array([r["n"] for r in seen], float))
    odds = F.lit(float(np.log(share / (1 - share))))
    for k, name in enumerate(names):
        by_vote = np.log(table[1][k] / table[0][k])
        odds = odds + F.when(F.col(name) < 0, float(by_vote[0])).when(F.col(name) > 0, float(by_vote[2])).otherwise(float(by_vote[1]))
    f = f.withColumn("p_good", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed)
    return f.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= THRESHOLD))


def query(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
