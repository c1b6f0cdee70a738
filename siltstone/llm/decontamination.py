"""Benchmark decontamination: a positional inverted index over the corpus, in DataFrame operations.

1. Benchmark items become windows of 10 consecutive words (a shorter item is one window).
2. One pass over the corpus counts how long each benchmark word's list of postings is.
3. A match of a window may differ from it in at most 1 - NEAR of its places. Words that the corpus lacks differ in any case; of the others, the
   rarest are looked up, one more than may still differ, so that a match has one of them at its place.
4. A second pass stores the postings (document, position, the words around) of the looked-up words only.
5. Lists less their offsets in the window are intersected from the rarest on: around each posting, the words that stand at the places of the
   window's others are counted. All places: an exact hit. A share of NEAR or more: a proximity match.

The words around a posting are the entries of all other terms' lists that may meet it, so that lists are intersected where a rare
one stands and the longer ones are never stored, sorted or moved. No text or posting is shuffled. The benchmark is worked off in blocks of a
bounded number of windows, which alone (not the items that hold them) are broadcast, so the benchmark may grow too.

Edge cases: null text has no words, null or wordless items no windows; repeated rows are answered each; an empty benchmark
hits nothing; words of the same count are looked up from the left; a place that one window hits and another one nearly is in both lists; a text
may be of any length, a posting is a row; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .columns import MARKS, ROW, lower_ascii, with_row, words

WINDOW = 10
#: Windows in a block: 20,000 windows of 10 words, each under at most 3 words, are some 10 MB.
BLOCK = 20_000
#: Percentage of a window's words that must agree for a proximity match.
NEAR = 80


def _tokens(text: Column) -> Column:
    return words(lower_ascii(text), MARKS)


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """((wid, win): the distinct windows; (wid, item_id): their items, ids as text), staged."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), _tokens(F.col("text")).alias("w"))
    items = items.where((F.size("w") > 0) & F.col("item_id").isNotNull())
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    held = stage(items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("win")).distinct(), "windows")
    wins = stage(held.select("win").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    return wins, stage(held.join(wins, "win").select("wid", "item_id"), "items")


def _lookups(wins: DataFrame, df: DataFrame) -> DataFrame:
    """(wid, win, word, o): the words by which each window is looked up, and their offsets from 0."""
    w = wins.select("wid", "win", F.posexplode("win").alias("o", "word")).join(F.broadcast(df), "word", "left")
    w = w.groupBy("wid").agg(
        F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", "o", "word")))).alias("r"), F.first("win").alias("win")
    )
    may_differ = F.size("win") - F.ceil(F.size("win") * NEAR / 100).cast("int")
    w = w.withColumn("many", may_differ - (F.size("win") - F.size("r")) + 1).where("many > 0")
    return w.select("wid", "win", F.explode(F.slice("r", F.lit(1), F.col("many"))).alias("p")).select("wid", "win", "p.word", "p.o")


def _is_one_of(column: str, rows: DataFrame) -> Column:
    """Whether the column is among the words of rows, which become literals. Words hold neither quotes nor backslashes."""
    found = [r[0] for r in rows.distinct().collect()]  # at most BLOCK * WINDOW words
    return F.expr(f"{column} IN ({', '.join(f"'{w}'" for w in found)})") if found else F.lit(False)


def _postings(docs: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """(uid, doc_id, pos, word, near): the places of the terms, each with the words up to reach before and after, joined.

    Each row of docs has one more entry, of the empty word, after its last one.
    """
    t = docs.select("uid", "doc_id", _tokens(F.col("text")).alias("w"))
    t = t.select("uid", "doc_id", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word")).where((F.col("word") == "") | _is_one_of("word", terms))
    around = F.when(F.col("word") != "", F.array_join(F.slice("w", F.greatest(F.col("pos") - reach, F.lit(0)) + 1, 2 * reach + 1), " "))
    return t.select("uid", "doc_id", "pos", "word", around.alias("near"))


def _block(docs: DataFrame, wins: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The staged postings table for a block of windows, and (uid, wid, start, n, same) of its matches."""
    spark = docs.sparkSession
    places = docs.select(F.explode(_tokens(F.col("text"))).alias("word")).where(_is_one_of("word", wins.select(F.explode("win"))))
    lists = places.groupBy("word").agg(F.count("*").alias("n"))
    rows = [(r["word"], r["n"]) for r in lists.collect()]  # no more rows than the windows have words
    wins = stage(_lookups(wins, spark.createDataFrame(rows, "word string, n long")), "lookups")
    reach = size - 1
    table = stage(_postings(docs, wins.select("word"), reach), "postings")
    start = F.least(F.col("pos"), F.lit(reach)) - F.col("o")  # of the window among the words around
    same = sum((F.when(F.get("near", F.col("first") + i) == F.get("win", F.lit(i)), 1).otherwise(0) for i in range(size)), F.lit(0))
    found = (
        table.where("word <> ''").select("uid", "pos", "word", F.split("near", " ").alias("near")).join(F.broadcast(wins), "word")
        .select("uid", "wid", (F.col("pos") - F.col("o")).alias("start"), F.size("win").alias("n"), "near", "win", start.alias("first")).where("first >= 0")
        .select("uid", "wid", "start", "n", same.alias("same"))
        .where(100 * F.col("same") >= NEAR * F.col("n"))
    )
    return table, found.distinct()


def find_matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per row of docs: uid, doc_id, n_words, hits (start, n; exact), near (start, n), items (ids as text, sorted).

    uid tells repeated rows apart.
    """
    return _matches(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), benchmark, size, block)


def _matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK, staged: bool = False) -> DataFrame:
    """find_matches of (uid, doc_id, text), which may be staged already."""
    wins, items = benchmark_windows(benchmark, size)
    blocks = max(1, -(-wins.count() // block))
    if blocks > 1 and not staged:  # each block passes over the same uids
        docs = stage(docs, "texts")
    done = [_block(docs, wins.where(F.pmod(F.xxhash64("wid"), F.lit(blocks)) == b), size) for b in range(blocks)]
    rows = done[0][1]
    for _, more in done[1:]:
        rows = rows.unionByName(more)
    rows = stage(rows, "matches")
    hit, span = F.col("same") == F.col("n"), F.struct("start", "n")
    per = rows.groupBy("uid").agg(F.array_sort(F.collect_set(F.when(hit, span))).alias("hits"), F.array_sort(F.collect_set(F.when(~hit, span))).alias("near"))
    held = rows.where(hit).select("uid", "wid").distinct().join(items, "wid").groupBy("uid").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    spans, ids = F.array().cast("array<struct<start:int,n:int>>"), F.array().cast("array<string>")
    ends = done[0][0].where("word = ''").select("uid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return ends.join(per.join(held, "uid", "left"), "uid", "left").select(
        "uid", "doc_id", "n_words", F.coalesce("hits", spans).alias("hits"), F.coalesce("near", spans).alias("near"), F.coalesce("items", ids).alias("items")
    )


def _n_hit(hits: Column) -> Column:
    return F.size(F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1)))))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark window, whatever other rows have their ids."""
    docs = with_row(docs)
    found = _matches(docs.select(F.col(ROW).alias("uid"), "doc_id", "text"), benchmark, staged=True)
    bad = found.where(F.size("hits") > 0).select("uid")
    return docs.join(bad, docs[ROW] == bad["uid"], "left_anti").drop(ROW)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    m = find_matches(docs, benchmark)
    return m.select(
        "doc_id", "n_words", _n_hit(F.col("hits")).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
        F.array_join(F.transform("near", lambda s: F.concat_ws(":", s["start"].cast("string"), s["n"].cast("string"))), ",").alias("near"),
    )


#: The contract in DuckDB SQL; near: places where some window agrees in 80 of 100 of its words, but not in all.
SQL = r"""
WITH iw AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT item_id, w[i : least(i + 9, len(w))] AS ws FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT row_number() OVER () AS uid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
lens AS (SELECT DISTINCT len(ws) AS n FROM win),
dg AS (SELECT uid, n, i - 1 AS s, w[i : i + n - 1] AS ws FROM (SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT uid, s, dg.n, item_id FROM dg JOIN win USING (ws)),
wp AS (SELECT DISTINCT ws, len(ws) AS n FROM win), wo AS (SELECT ws, n, unnest(range(1, n + 1)) AS o, unnest(ws) AS x FROM wp),
dp AS (SELECT uid, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM dw),
nr AS (SELECT DISTINCT uid, s, n FROM (SELECT uid, p - o AS s, n, ws, count(*) AS same FROM dp JOIN wo USING (x) WHERE p >= o GROUP BY ALL) WHERE 100 * same >= 80 * n AND same < n),
nrs AS (SELECT uid, string_agg(s || ':' || n, ',' ORDER BY s, n) AS near FROM nr GROUP BY uid),
pos AS (SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT uid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT uid, s, n FROM hit)) GROUP BY uid),
its AS (SELECT uid, count(*) AS n_items, string_agg(i, ',' ORDER BY i COLLATE "C") AS ids FROM (SELECT DISTINCT uid, item_id::VARCHAR AS i FROM hit) GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(near, '') AS near
FROM dw LEFT JOIN pos USING (uid) LEFT JOIN its USING (uid) LEFT JOIN nrs USING (uid)
"""
