"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for each operator and stage."""

import pytest

from siltstone.llm import compression, decontamination, jaccard, language_model, languages, licenses, packing, pii, rules, toxicity
from siltstone.llm.queries import tokenizer_json

LONG = "word another third " * 12_000
ROWS = [
    (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "   \n\t ", None, "s", 0), (None, "a text without an id, but with words in it", "en", "s", 9), (4, LONG, "en", "s", len(LONG)),
    (5, "the same text twice over for the test", "en", None, 5), (5, "the same text twice over for the test", "en", None, 5), (6, "das ist ein Satz", "de", "s", None), (7, "!!! ??? 123 +1 (555) 123-4567", None, None, 1),
    (8, "the same text twice over for the test", "en", "s", 5), (9, "😀 é   ñ\x00x", "es", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use within.
CLASH = ["uid", "w", "label", "score", "words", "bucket", "chunk", "set_key", "sketch", "component", "x", "rep_id", "_toxicity", "spans", "key", "kind", "held_out", "half", "grp"]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASH:
        d = d.selectExpr("*", f"'{c}' AS `{c}`")
    return d


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 0, 1), (5, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "the same text twice over for the"), (2, None), (3, ""), (None, "x"), (4, "satz")], "item_id long, text string")


QUERIES = {
    "op1": lambda d, l, b: language_model.query(d), "op2": lambda d, l, b: rules.query(d), "op3": lambda d, l, b: toxicity.query(d, l), "op4": lambda d, l, b: languages.query(d),
    "op5": lambda d, l, b: compression.query(d, l), "op6": lambda d, l, b: jaccard.query(d), "op7": lambda d, l, b: licenses.query(d), "op9": lambda d, l, b: pii.query(d), "op10": lambda d, l, b: decontamination.query(d, b),
}


@pytest.mark.parametrize("name", QUERIES)
def test_a_row_for_each_row(docs, labels, benchmark, name):
    out = QUERIES[name](docs, labels, benchmark)
    rows = out.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    five = [r for r in rows if r["doc_id"] == 5]
    assert five[0] == five[1]
    if "score" in out.columns and name != "op1":
        assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(docs, labels, benchmark, name):
    none = docs.limit(0)
    assert QUERIES[name](none, labels, benchmark).count() == 0
    assert QUERIES[name](none, labels.limit(0), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op3", "op5", "op10"])
def test_empty_other_tables(docs, labels, benchmark, name):
    rows = QUERIES[name](docs, labels.limit(0), benchmark.limit(0)).collect()
    assert len(rows) == len(ROWS) and all(r["score"] == 0 for r in rows if name != "op10") and all(not r["contaminated"] for r in rows if name == "op10")


def test_what_the_cases_give(docs, labels, benchmark):
    by = lambda name: {r["doc_id"]: r for r in QUERIES[name](docs, labels, benchmark).collect()}
    lm, lang, near, rule, lic, hit = by("op1"), by("op4"), by("op6"), by("op2"), by("op7"), by("op10")
    assert lm[1]["n_tokens"] == 1 and lm[2]["n_tokens"] == 1 and lm[4]["n_tokens"] == 36_001
    assert lang[1]["lang_pred"] == lang[7]["lang_pred"] == "und" and lang[6]["lang_pred"] == "de"
    assert near[5]["component_id"] == near[8]["component_id"] == 5 and near[1]["component_id"] == 1 and near[1]["n_shingles"] == 0 and near[None]["component_id"] is None
    assert rule[1]["base_failed"] and not rule[2]["kept"] and rule[4]["n_repeat_words"] == 36_000
    assert lic[1]["n_words"] == 0 and lic[1]["labels"] == "" and lic[1]["first_word"] is None
    assert hit[5]["n_hit"] == 7 and hit[6]["n_items"] == 1 and hit[1]["n_words"] == 0


def test_packing(spark, docs):
    json_text = tokenizer_json()
    rows = packing.query(docs, json_text).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1 and sum(r["length"] for r in rows if r["doc_id"] == 5) == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 5)
    assert packing.query(docs.limit(0), json_text).count() == 0


def test_stages_keep_columns(docs, labels, benchmark):
    for out in (toxicity.reject(docs, labels), jaccard.deduplicate(docs), decontamination.decontaminate(docs, benchmark), pii.redact(docs)):
        assert out.columns == docs.columns
        assert out.where("doc_id = 2").count() == 1  # an empty text is no fault
    assert jaccard.deduplicate(docs).where("doc_id = 8").count() == 0
    assert decontamination.decontaminate(docs, benchmark).where("doc_id IN (5, 6, 8)").count() == 0
    masked = pii.redact(docs).where("doc_id = 7").first()
    assert masked["text"] == "!!! ??? 123 <PHONE>" and masked["n_chars"] == len(masked["text"])
    assert pii.redact(docs).where("doc_id IS NULL").count() == 1


def test_stages_on_empty_tables(docs, labels, benchmark):
    none = docs.limit(0)
    for out in (toxicity.reject(none, labels), jaccard.deduplicate(none), decontamination.decontaminate(none, benchmark), pii.redact(none)):
        assert out.count() == 0


def test_stages_decide_by_row(spark, benchmark):
    """Null and repeated ids: a row's fault is no fault of others with its id, and copies under one id are one document."""
    r = [" ".join(f"{k}{i}" for i in range(30)) for k in "abcdef"]
    rows = [(None, r[0]), (None, r[1]), (1, r[0]), (2, r[2]), (2, r[3]), (3, r[3]), (4, r[4]), (4, r[4]), (None, r[5]), (None, r[5]), (None, None), (None, ""), (5, None), (5, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' AS uid")
    got = jaccard.deduplicate(d)
    assert got.columns == d.columns
    want = [(None, r[1]), (1, r[0]), (2, r[2]), (2, r[3]), (4, r[4]), (None, r[5]), (None, None), (None, ""), (5, None), (5, None)]
    assert sorted(((x[0], x[1]) for x in got.collect()), key=repr) == sorted(want, key=repr)
    hit = "here the same text twice over for the test"
    rows = [(None, hit), (None, r[0]), (None, None), (7, hit), (7, r[1]), (8, r[2])]
    got = decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([x for x in rows if x[1] != hit], key=repr)
