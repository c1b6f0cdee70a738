"""Pages to overlapping chunks.

A chunk starts at every multiple of step = size - overlap, so each chunk follows from its number alone and nothing
is walked through in sequence. Texts are cut into step-long pieces once; a chunk's window is made of neighbouring pieces, so the
work is linear in a text's length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import strip

NEVER = 2**31 - 1


@dataclass(frozen=True)
class ChunkSettings:
    size: int = K.CHUNK_SIZE
    overlap: int = K.CHUNK_OVERLAP
    least: int = K.CHUNK_LEAST
    window: int = K.CHUNK_WINDOW

    def __post_init__(self) -> None:
        if not 0 <= self.overlap < self.size:
            raise ValueError("overlap must be at least 0 and below the chunk size")
        if self.least < 0 or not 0 <= self.window <= self.size:
            raise ValueError("least and window must be at least 0, the window at most the chunk size")


#: What the command line uses.
SHORT = ChunkSettings(1500, 150)


def join_pages(pages: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, spans) from (doc_id, page_num, text): pages two newlines apart, spans array<struct<offset, page_num>>.

    Empty pages are left out; the others keep their numbers.
    """
    pages = pages.where(F.coalesce(F.col("text"), F.lit("")) != "")
    before = Window.partitionBy(doc_id).orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.withColumn("offset", F.coalesce(F.sum(F.length("text") + 2).over(before), F.lit(0)).cast("int"))
    held = F.array_sort(F.collect_list(F.struct(F.col("offset"), F.col("page_num").cast("int").alias("page_num"), F.col("text"))))
    grouped = pages.groupBy(doc_id).agg(held.alias("p"))
    return grouped.select(
        doc_id, F.array_join(F.transform("p", lambda p: p["text"]), "\n\n").alias("text"),
        F.transform("p", lambda p: F.struct(p["offset"].alias("offset"), p["page_num"].alias("page_num"))).alias("spans"),
    )


def page_at(spans: Column, offset: Column) -> Column:
    """The page of an offset: the last that starts at it or before. A separator belongs to the page before it."""
    return F.coalesce(F.try_element_at(F.filter(spans, lambda s: s["offset"] <= offset), F.lit(-1))["page_num"], F.lit(0))


def soft_cut(region: Column) -> Column:
    """How many characters of a region stay in front of its best break; all, if there is none."""
    found = [F.length(F.regexp_extract(region, rf"(?s)^.*(?:{p})", 0)) for p in ("\n\n", "\n", rf"[.!?]{K.SPACE}", K.SPACE)]
    return F.coalesce(*[F.when(n > 0, n) for n in found], F.length(region))


def chunks(docs: DataFrame, source: Column, settings: ChunkSettings = ChunkSettings()) -> DataFrame:
    """Chunks of docs (text cleaned, perhaps spans), with all other columns of docs but text and spans.

    Adds chunk_index, chunk_id, chunk_text, start, end, page_start, page_end, char_count, oversized, gap_chars (characters between
    this chunk and the next that are in neither).
    """
    size, step = settings.size, settings.size - settings.overlap
    spans = F.col("spans") if "spans" in docs.columns else F.expr("array(named_struct('offset', 0, 'page_num', 0))")
    others = [c for c in docs.columns if c not in ("text", "spans")]
    d = docs.select(
        *others, source.alias("_source"), spans.alias("_spans"), F.length("text").alias("_n"),
        F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{step}}}"), F.lit(0)).alias("_pieces"),
    )
    many = -(-size // step)

    def cut(_, k):
        start = k * step
        raw = F.substring(F.array_join(F.slice("_pieces", k + 1, many), ""), 1, size)
        whole = start + size >= F.col("_n")
        region = F.substring(raw, size - settings.window + 1, settings.window)
        kept = F.when(whole, F.length(raw)).otherwise(size - settings.window + soft_cut(region))
        return F.struct(k.alias("k"), start.alias("start"), (start + kept).alias("end"), strip(F.substring(raw, F.lit(1), kept)).alias("text"))

    d = d.withColumn("_cuts", F.transform("_pieces", cut))
    blank = F.filter("_cuts", lambda c: c["text"] == "")
    runt = F.filter("_cuts", lambda c: (c["k"] > 0) & (c["end"] >= F.col("_n")) & (F.length(c["text"]) < settings.least) & (c["text"] != ""))
    d = d.withColumn("_blank", F.coalesce(F.get(blank, F.lit(0))["k"], F.lit(NEVER))).withColumn("_runt", F.get(runt, F.lit(0)))
    d = d.withColumn("_runt", F.when(F.col("_runt")["k"] < F.col("_blank"), F.col("_runt")))
    kept = F.filter("_cuts", lambda c: (c["k"] < F.col("_blank")) & (c["k"] < F.coalesce(F.col("_runt")["k"], F.lit(NEVER))))
    d = d.select(*others, "_source", "_spans", "_n", "_runt", F.explode(kept).alias("c"))
    merged = F.coalesce(F.col("_runt")["k"] == F.col("c")["k"] + 1, F.lit(False))
    text = F.when(merged, F.concat(F.col("c")["text"], F.lit("\n"), F.col("_runt")["text"])).otherwise(F.col("c")["text"])
    end = F.when(merged, F.col("_runt")["end"]).otherwise(F.col("c")["end"])
    digest = F.sha2(F.concat(F.col("_source"), F.lit("|"), F.col("c")["k"].cast("string"), F.lit("|"), F.substring(F.col("c")["text"], 1, 256)), 256)
    return d.select(
        *others, F.col("c")["k"].alias("chunk_index"), F.concat(F.format_string("chunk-%04d-", F.col("c")["k"]), F.substring(digest, 1, 12)).alias("chunk_id"),
        text.alias("chunk_text"), F.col("c")["start"].alias("start"), end.alias("end"), page_at(F.col("_spans"), F.col("c")["start"]).alias("page_start"),
        page_at(F.col("_spans"), F.least(end - 1, F.col("_n") - 1)).alias("page_end"), F.length(text).alias("char_count"),
        (F.length(text) > int(size * K.OVERSIZE)).alias("oversized"),
        F.when(end < F.col("_n"), F.greatest(F.lit(0), F.col("c")["start"] + step - end)).otherwise(0).alias("gap_chars"),
    )
