"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features (dense numbers only): densities of a learned lexicon, its hits near second-person words, capitals, punctuation
and rates of obfuscated spellings. The lexicon holds words and stems (written with a final -) that are far likelier in
toxic documents, of at least MIN_GROUPS different groups of near copies (a document's group: the least hash of its words).
Each half of the training sample is measured with the lexicon of the other half, so that words that only training
documents hold mislead no tree; the final scores use the lexicon of both.

SAMPLE is the number of labelled documents of each class that are fitted on (expected: a share chosen by a hash of their
ids); their weights restore the shares that all labels give. All documents are scored, whole.

Edge cases: null and empty texts have all features 0 and are scored; repeated rows are scored each; a doc_id labelled twice
counts with its largest label; null labels and ids are not learned from; without labels of both kinds all scores are their mean (0
if there are none); an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import stage
from .boosting import Calibrated
from .columns import fold

SAMPLE = 6000
LEXICON = 1000
MIN_GROUPS, MIN_ODDS = 5, 3.0
STEMS = range(3, 9)  # lengths of stems
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")
#: Words with signs or digits inside, and letters set apart by signs, as in "id1ot", "id*ot" or "i.d.i.o.t".
OBFUSCATED = re.compile(r"(?<![^\W_])(?:[^\W_]++(?:[@$!*|+][^\W_]++)+|[^\W\d_]*+[0134579]++[^\W\d_]++(?:[0134579]++[^\W\d_]*+)*|[^\W\d_](?:[.\-_][^\W\d_]){3,})(?![^\W_])")
PLAIN = str.maketrans("013457@$!|+", "oieastasilt")
STRETCHED = re.compile(r"(.)\1{2,}")
#: Second-person words of the languages at hand.
SECOND = frozenset("you your yours yourself u ur tu tus te ti usted ustedes vosotros vous votre vos toi ton du dich dir dein deine ihr euch euer".split())
NEAR = 5
FEATURES = (
    "hits", "hit_share", "weight_share", "weight_most", "distinct_hits", "hits_near_second", "second_share", "obfuscated", "obfuscated_share",
    "obfuscated_hits", "upper_share", "upper_hits", "exclaims", "questions", "punctuation", "log_words", "word_length",
)


def unmask(word: str) -> list[str]:
    """Plain readings of an obfuscated spelling; a * is left out or any letter, which the lexicon's skeletons see to."""
    w = re.sub(r"[ .\-_]", "", word.lower().translate(PLAIN))
    return [STRETCHED.sub(r"\1", w), STRETCHED.sub(r"\1\1", w)]


def units(word: str) -> list[str]:
    """What of a lower-case word may stand in the lexicon: itself and its stems."""
    return [word, *(word[:k] + "-" for k in STEMS if k < len(word))]


#: What is known of a token (between white space), to be summed up over a text.
PARTS = ("words", "letters", "hits", "weight", "seconds", "masked", "hidden", "hidden_weight", "upper", "upper_hits", "exclaims", "questions", "signs", "single", "best")
W, L, HIT, WEIGHT, SECOND_AT, MASKED, HIDDEN, HIDDEN_WEIGHT, UPPER, UPPER_HIT, EXCLAIM, QUESTION, SIGNS, SINGLE, BEST = range(len(PARTS))


class Measure:
    """FEATURES of texts by a lexicon. Tokens met lately are remembered."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon, self.gaps = lexicon, starred(lexicon)
        self.heads = {u[: STEMS[0]] for u in lexicon}
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1 << 16, len(PARTS)), np.float32)

    def weight(self, word: str) -> float:
        if word[: STEMS[0]] not in self.heads:
            return 0.0
        return max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0)

    def token(self, token: str) -> list[float]:
        core = token.strip(string.punctuation)
        if core.isalpha() and not STRETCHED.search(core):  # most tokens: one plain word
            word, n, signs, upper = core.lower(), len(core), len(token) - len(core), len(core) > 1 and core.isupper()
            v = self.weight(word)
            marks = (token.count("!"), token.count("?")) if signs else (0, 0)
            return [1, n, v > 0, v, word in SECOND, 0, 0, 0, upper, upper and v > 0, *marks, signs, n == 1 and not signs, v]
        raw = WORD.findall(token)
        weights = [self.weight(w.lower()) for w in raw]
        hidden, masked = [], 0
        for m in OBFUSCATED.finditer(token):
            masked += 1
            hidden.append(max(max(map(self.weight, unmask(m.group()))), self.gaps.get(m.group().lower(), 0.0)))
        if STRETCHED.search(token):
            hidden += [max(map(self.weight, unmask(w))) for w, v in zip(raw, weights, strict=True) if not v and len(w) > 4 and STRETCHED.search(w)]
        hidden = [v for v in hidden if v]
        upper = [len(w) > 1 and w.isupper() for w in raw]
        return [
            len(raw), sum(map(len, raw)), sum(v > 0 for v in weights), sum(weights), sum(w.lower() in SECOND for w in raw), masked, len(hidden), sum(hidden),
            sum(upper), sum(u and v > 0 for u, v in zip(upper, weights, strict=True)), token.count("!"), token.count("?"), sum(map(token.count, string.punctuation)),
            len(raw) == 1 and len(token) == 1, max([*weights, *hidden], default=0.0),
        ]

    def learn(self, token: str) -> int:
        at = self.known[token] = len(self.known)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.token(token)
        return at

    def __call__(self, text: str | None) -> list[float]:
        tokens = (text or "").split()
        if not tokens:
            return [0.0] * len(FEATURES)
        if len(self.known) > 250_000:
            self.known.clear()
        get, learn = self.known.get, self.learn
        at = [learn(t) if (i := get(t)) is None else i for t in tokens]
        rows = self.rows[at]
        s, best = rows.sum(0, dtype=np.float64), float(rows[:, BEST].max())
        hidden, hidden_weight = s[HIDDEN], s[HIDDEN_WEIGHT]
        if s[SINGLE] >= 4:  # letters set apart by spaces
            for run in re.findall(r"(?:[^\W\d_] ){3,}[^\W\d_]", " ".join(t if len(t) == 1 else "--" for t in tokens)):
                if v := max(map(self.weight, unmask(run.replace(" ", "")))):
                    hidden, hidden_weight, best = hidden + 1, hidden_weight + v, max(best, v)
        hits, seconds = np.flatnonzero(rows[:, HIT]), np.flatnonzero(rows[:, SECOND_AT])
        near = int(((np.searchsorted(seconds, hits + NEAR, "right") - np.searchsorted(seconds, hits - NEAR)) > 0).sum())
        many = max(s[W], 1)
        return [
            s[HIT], s[HIT] / many, (s[WEIGHT] + hidden_weight) / many, best, len({at[i] for i in hits.tolist()}), near, s[SECOND_AT] / many, s[MASKED], s[MASKED] / many,
            hidden, s[UPPER] / many, s[UPPER_HIT], s[EXCLAIM] / many, s[QUESTION] / many, s[SIGNS] / max(len(text), 1), float(np.log1p(s[W])), s[L] / many,
        ]


def starred(lexicon: dict[str, float]) -> dict[str, float]:
    return {w[:i] + "*" * k + w[i + k :]: v for w, v in lexicon.items() if w[-1] != "-" for k in (1, 2, 3) for i in range(1, len(w) - k)}


def labelled_sample(labels: DataFrame, column: str, training, size: int = SAMPLE) -> tuple[list[tuple], dict[int, int]]:
    """(doc_id, label) of some size documents of each label, and how many each label has.

    They are the share of each label that gives size, by a hash of the id, so that no more than the sample moves.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).where(training)
    one = one.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    totals = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect() if r["label"] in (0, 1)}
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, min(1.0, size / n)).otherwise(share)
    rows = one.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) / 1_000_000 < share).collect()
    return sorted((r["doc_id"], r["label"]) for r in rows), totals


@F.pandas_udf(T.LongType())
def copy_group(texts: pd.Series) -> pd.Series:
    """The least hash of a text's words: near copies mostly share it."""
    return pd.Series([min((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in set(t.split())), default=0) for t in texts], dtype="int64")


def sample_texts(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    """(doc_id, text, label, grp, half): the sample's texts, staged. Near copies fall into the same half, 0 or 1."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(rows, f"doc_id {kind}, label int")  # at most 2 * SAMPLE rows
    both = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    both = both.groupBy("doc_id", "label").agg(F.min("text").alias("text")).withColumn("grp", copy_group("text"))  # a repeated id is one document
    return stage(both.withColumn("half", F.pmod(F.xxhash64("grp"), F.lit(2)).cast("int")), "labelled")


def learn_lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """Of half 0, of half 1 and of both: words and stems far likelier in toxic documents, with their log odds."""

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 100):  # a text has thousands of units
                part, rows = b.iloc[at : at + 100], []
                for text, grp, label, half in zip(part["text"], part["grp"], part["label"], part["half"], strict=True):
                    found = {w.lower() for w in WORD.findall(text)}
                    rows += [(u, grp, int(label), int(half)) for u in {u for w in found for u in units(w)} | {""}]
                yield pd.DataFrame(rows, columns=["unit", "grp", "label", "half"])

    seen = sample.select("text", "grp", "label", "half").mapInPandas(run, "unit string, grp long, label int, half int").distinct()
    names = [(kind, h) for kind in (1, 0) for h in (0, 1)]
    count = lambda k, h: F.count_if((F.col("label") == k) & (F.col("half") == h)).alias(f"n{k}{h}")
    counts = stage(seen.groupBy("unit").agg(*[count(k, h) for k, h in names]).where((F.col("n10") + F.col("n11") >= MIN_GROUPS) | (F.col("unit") == "")), "units")
    total = counts.where("unit = ''").first()
    out = []
    for halves in ((0,), (1,), (0, 1)):
        bad, good = (sum((F.col(f"n{k}{h}") for h in halves), F.lit(0)) for k in (1, 0))
        all_bad, all_good = (sum(total[f"n{k}{h}"] for h in halves) if total else 0 for k in (1, 0))
        if not all_bad or not all_good:
            out.append({})
            continue
        odds = F.log((bad + 0.5) / (all_bad + 1)) - F.log((good + 0.5) / (all_good + 1))
        found = counts.where("unit <> ''").select("unit", odds.alias("odds"), bad.alias("bad")).where((F.col("bad") >= MIN_GROUPS) & (F.col("odds") >= MIN_ODDS))
        best = found.orderBy((F.col("odds") * F.sqrt("bad")).desc(), "unit").limit(LEXICON)
        out.append({r["unit"]: r["odds"] for r in best.collect()})
    return out


def fit(docs: DataFrame, labels: DataFrame, training):
    """(lexicon, calibrated trees); training: the condition on doc_id of the rows that may be learned from."""
    rows, totals = labelled_sample(labels, "toxic", training)
    sample = sample_texts(docs, rows)
    *halves, lexicon = learn_lexicons(sample)
    scored = []  # at most 2 * SAMPLE rows
    for h in (0, 1):
        part = numbers(sample.where(F.col("half") == h), halves[1 - h], "label", "grp", "doc_id")
        scored += part.select("label", "grp", "doc_id", "x").collect()
    scored.sort(key=lambda r: (r["grp"], r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in scored]).reshape(len(scored), len(FEATURES))
    y = np.array([r["label"] for r in scored], float)
    weight = np.array([totals[int(v)] / max(1, (y == v).sum()) for v in y])
    return lexicon, Calibrated().fit(x, y, weight / weight.mean() if len(y) else weight)


def numbers(sample: DataFrame, lexicon: dict[str, float], *columns: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = Measure(lexicon)
        for texts in batches:
            yield pd.Series([measure(t) for t in texts])

    return sample.selectExpr("text", *columns).withColumn("x", run("text")).drop("text")


def scorer(model):
    """A column function: text to probability."""
    lexicon, trees = model

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = Measure(lexicon)
        for texts in batches:
            yield pd.Series(trees.score(np.array([measure(t) for t in texts]).reshape(len(texts), len(FEATURES))))

    return run


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those whose score is threshold or more; learns from all labels. Without a model, all stay."""
    model = fit(docs, labels, F.lit(True))
    if model[1].trees is None:
        return docs
    score = scorer(model)
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, score("text")).where(F.col(name) < threshold).drop(name)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = fold(F.col("doc_id"), 3) == 1
    score = scorer(fit(docs, labels, ~held))
    out = docs.select("doc_id", held.alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
