import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions.text import clean_page, only_url, strip
from siltstone.operators.chunking import SHORT, ChunkSettings, chunks, join_pages, page_at

BREAKS = [re.compile(p) for p in (r"\n\n", r"\n", r"[.!?]\s", r"\s")]


def model(text, c):
    """A walk through the text, chunk by chunk."""
    out, at = [], 0
    while at < len(text):
        hard = min(at + c.size, len(text))
        end = hard
        if hard < len(text):
            region = text[max(0, hard - c.window) : hard]
            for p in BREAKS:
                if found := [m.end() for m in p.finditer(region)]:
                    end = max(0, hard - c.window) + found[-1]
                    break
        piece = text[at:end].strip()
        if not piece:
            break
        if end >= len(text) and len(piece) < c.least and out:
            out[-1] += "\n" + piece
            break
        out.append(piece)
        at = max(at + c.size - c.overlap, end - c.overlap)
    return out


TEXTS = [
    "", "short", "x" * 4000, "x" * 4001, "y" * 9000, "word " * 3000, "a. b! c? " * 900, "one\n\ntwo\nthree. " * 500, "😀é ñ " * 1200,
    "tail " * 720 + "e", "z" * 3799 + " " + "q" * 199, "z" * 3799 + " " + "q" * 201, "a" + " \n" * 3000 + "b", " lead and trail ",
]


@pytest.mark.parametrize("settings", [ChunkSettings(), SHORT, ChunkSettings(300, 200, 120, 50), ChunkSettings(100, 0, 0, 100)])
def test_chunks_equal_a_sequential_walk(spark, settings):
    docs = spark.createDataFrame(list(enumerate(t.strip() for t in TEXTS)), "doc_id long, text string")
    got = {}
    for r in chunks(docs, F.col("doc_id").cast("string"), settings).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r["doc_id"], []).append(r["chunk_text"])
        assert r["start"] == r["chunk_index"] * (settings.size - settings.overlap)
    assert got == {i: m for i, t in enumerate(TEXTS) if (m := model(t.strip(), settings))}


def test_chunk_ids_and_lost_characters(spark):
    docs = spark.createDataFrame([(1, "word " * 2000)], "doc_id long, text string")
    rows = chunks(docs, F.lit("s"), ChunkSettings(1000, 10, 0, 200)).collect()
    assert all(re.fullmatch(r"chunk-\d{4}-[0-9a-f]{12}", r["chunk_id"]) for r in rows) and len({r["chunk_id"] for r in rows}) == len(rows)
    assert all(r["gap_chars"] >= 0 for r in rows)


def test_settings_are_checked():
    for bad in ((100, 100), (100, -1), (100, 10, -1), (100, 10, 1, 101)):
        with pytest.raises(ValueError):
            ChunkSettings(*bad)


def test_cleaning(spark):
    cases = {
        "Page 3 of 9\ntext": "text", "a\n 12 \nb": "a\n\nb", "a  \t b": "a b", "a\n\n\n\nb": "a\n\nb", " x ": "x", "PAGE 4\nx\n5 of 6": "x", "v1 2": "v1 2", "": "",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", clean_page(F.col("t")).alias("c")).collect()
    assert {r["t"]: r["c"] for r in rows} == cases


def test_strip_is_pythons(spark):
    texts = [chr(c) + "x" + chr(c) for c in [*range(1, 0x100), 0x1680, 0x2000, 0x200A, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000, 0xFEFF]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s")).collect()
    assert all(r["s"] == r["t"].strip() for r in rows)


def test_links(spark):
    cases = {"https://a.b/c": "https://a.b/c", "  HTTP://a.b \n\n": "HTTP://a.b", "x\nhttps://a.b": "https://a.b", "a\nb\nc\nhttps://a.b": None, "see https://a.b": None, "": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", only_url(F.col("t")).alias("u")).collect()
    assert {r["t"]: r["u"] for r in rows} == cases


def test_pages(spark):
    pages = spark.createDataFrame([("d", 0, "abc"), ("d", 2, "de"), ("d", 1, ""), ("e", 5, "x"), ("d", 3, None)], "doc_id string, page_num int, text string")
    got = {r["doc_id"]: r for r in join_pages(pages).collect()}
    assert got["d"]["text"] == "abc\n\nde" and [tuple(s) for s in got["d"]["spans"]] == [(0, 0), (5, 2)] and [tuple(s) for s in got["e"]["spans"]] == [(0, 5)]
    at = join_pages(pages).where("doc_id = 'd'").select(*[page_at(F.col("spans"), F.lit(o)).alias(f"p{o}") for o in (0, 3, 4, 5, 6)]).first()
    assert list(at) == [0, 0, 0, 2, 2]
