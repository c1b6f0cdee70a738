"""Queries over the driver's tables, one for each operator family; their DuckDB twins are in oracles.py.

Each takes (spark, sf_dir) and runs over its whole tables. Arrays are joined to strings, so that results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import constants as K
from .functions.entities import (
    banned_opener,
    clamp_confidence,
    correct_type,
    entity_id,
    first_name,
    reclass_metric,
    score,
    storage_errors,
    validate,
)
from .functions.responses import balanced_json, extract_json, message_content, unwrap
from .functions.text import chunk_fault, clean_page, only_url, tokens
from .operators.batching import fixed_batches, size_batches
from .operators.chunking import SHORT, ChunkSettings, chunks, join_pages
from .operators.generation import best_attempt
from .operators.merging import list_union, registry_key
from .operators.similarity import clusters, edge_type, enrich, fallback_candidates, jaccard_pairs, nearest_candidates, within_candidates
from .plans import knowledge, spec
from .plans.staging import stage
from .sources.html import html_text, html_text_faithful
from .sources.store import numbered, upsert

RAW_TYPES = ("product", "metric", "NegativeBoundary", "kpi", "use case", "xkpiz", "unknown_zzz", "")
NOW = "2026-01-01T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-like rows made of documents and labels."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    d = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    i = F.col("doc_id")
    kind = "array<struct<type:string,target:string,_auto_generated:boolean>>"
    edge = lambda target, k: F.struct(_pick((*K.RELATIONSHIP_TYPES, "relates_to"), k).alias("type"), F.concat(F.lit("E"), target.cast("string")).alias("target"), F.lit(False).alias("_auto_generated"))
    edges = F.when(i % 3 == 0, F.array().cast(kind)).when(i % 3 == 1, F.array(edge(i + 1, i)).cast(kind)).otherwise(F.array(edge(i + 1, i), edge(i, i + 4)).cast(kind))
    scores = (
        F.when(F.col("quality") == 1, F.create_map(F.lit("classification"), F.lit(1.0)))
        .when(F.col("quality") == 0, F.create_map(F.lit("classification"), F.lit(0.5), F.lit("description"), F.lit(0.7)))
        .otherwise(F.expr("cast(map() as map<string,double>)"))
    )
    return d.select(
        i.alias("ord"), "doc_id", F.concat(F.lit("E"), i.cast("string")).alias("entity_id"), _pick(RAW_TYPES, i).alias("entity_type"),
        F.substring("text", 1, 40).alias("name"), F.substring("text", 1, 400).alias("description"), F.array("lang", "source").alias("domain"),
        edges.alias("relationships"), scores.alias("confidence_scores"), F.when(i % 5 == 1, "duplicate").when(i % 5 == 2, None).when(i % 5 == 4, "draft").otherwise("canonical").alias("status"),
    )


def _clean(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", clean_page(F.col("text")).alias("text"))


def _chunks(spark, sf_dir, settings) -> DataFrame:
    return chunks(_clean(spark, sf_dir), F.col("doc_id").cast("string"), settings)


def _pages(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page_num"), clean_page(F.col("text")).alias("text"))
    made = chunks(join_pages(pages, "conv_id"), F.col("conv_id").cast("string"), ChunkSettings(300, 60, 40, 50))
    return made.select("conv_id", "chunk_index", "chunk_id", "start", "end", "page_start", "page_end", "char_count")


def _joined(c: str) -> Column:
    return F.array_join(c, ";").alias(c)


def _validated(step: int) -> Callable:
    def run(spark, sf_dir):
        v = validate(entities(spark, sf_dir), step)
        return v.select("doc_id", "entity_type", "status", "passed", _joined("errors"), _joined("warnings"), _joined("auto_fixes"))

    return run


def _linked(spark, sf_dir) -> DataFrame:
    """Texts of one to four lines around a link."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    made = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("  "), "url", F.lit(" \n")))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("notes\n"), "url", F.lit("\n\nmore")))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("a\nb\nc\n"), "url"))
        .otherwise(F.concat(F.lit("see "), "url"))
    )
    return p.select("page_id", only_url(made).alias("found"))


def _part_ids(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    attributes = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"))
    return p.select("p_partkey", entity_id(F.col("p_type"), F.col("p_name"), attributes).alias("entity_id"))


def _scored(spark, sf_dir) -> DataFrame:
    return score(entities(spark, sf_dir).withColumn("entity_type", correct_type(F.col("entity_type"))))


def _pairs(spark, sf_dir) -> DataFrame:
    return jaccard_pairs(table(spark, sf_dir, "documents").where(F.col("text").isNotNull()), "doc_id", F.col("text"))


def _clusters(spark, sf_dir) -> DataFrame:
    text = F.concat_ws(" ", "name", "description")
    return clusters(entities(spark, sf_dir), "doc_id", text)


def _document_clusters(spark, sf_dir) -> DataFrame:
    """Clusters of documents by their whole texts; q23_clusters is bound by its SQL to their first 400 characters."""
    return clusters(table(spark, sf_dir, "documents"), "doc_id", F.coalesce("text", F.lit("")))


def _responses(spark, sf_dir) -> DataFrame:
    """Answers as a model might give them: pure, fenced, in prose, broken."""
    e = table(spark, sf_dir, "events").select("event_id", "props")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.col("props"))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone.")))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("Result: "), "props", F.lit(" as asked {")))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit("{\"a\": "), "props"))
        .otherwise(F.concat(F.lit("[1, 2] then "), "props"))
    )
    return e.select("event_id", text.alias("text"))


def _unwrapped(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"results": ['), "props", F.lit(", "), "props", F.lit("]}")).alias("text"))
    rows = e.select("event_id", F.posexplode(unwrap(F.try_parse_json("text"))).alias("place", "v"))
    return rows.select("event_id", "place", F.to_json("v").alias("entity"))


def _attempts(spark, sf_dir) -> DataFrame:
    """Events of a user as attempts in the order of their ids."""
    e = table(spark, sf_dir, "events").where("user_id IS NOT NULL")
    passes = F.floor(F.coalesce("value", F.lit(0.0))).cast("long") % 5
    return best_attempt(e.withColumn("passes", passes), "user_id", F.col("event_id"), F.col("passes") == 4, F.col("passes"), F.col("event_id")).withColumnRenamed("answer", "event_id")


def _store_rows(spark, sf_dir) -> DataFrame:
    """Entities of which up to four documents share an id, most of them also a name."""
    g = F.floor(F.col("doc_id") / 4).cast("long")
    e = entities(spark, sf_dir).withColumn("entity_id", F.concat(F.lit("S"), g.cast("string"))).withColumn("entity_type", _pick(RAW_TYPES, g))
    name = F.when(F.col("doc_id") % 7 == 6, F.col("name")).otherwise(F.concat(F.lit("Concept "), g.cast("string")))
    return e.withColumn("name", name).withColumn("status", F.when(F.col("doc_id") % 6 == 5, "duplicate").otherwise("canonical"))


def _waves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Documents of even ids are stored first, those of odd ids after."""
    rows = _store_rows(spark, sf_dir)
    first, folded = upsert(rows.where("doc_id % 2 = 0"), None, NOW)
    second, merged = upsert(rows.where("doc_id % 2 = 1"), folded.select("rkey", "record"), NOW)
    rest = folded.join(merged.select("rkey"), "rkey", "left_anti")
    return first.unionByName(second), merged.select("rkey", "record").unionByName(rest.select("rkey", "record"))


def _merged(spark, sf_dir) -> DataFrame:
    r = _waves(spark, sf_dir)[1].select("rkey", "record.*")
    return r.select("rkey", "name", "description", "status", F.array_join("domain", ",").alias("domain"), F.size("relationships").alias("n_edges"), F.col("confidence_scores")["description"].alias("c_description"))


def _numbers(spark, sf_dir) -> DataFrame:
    rows = _store_rows(spark, sf_dir)
    folded = upsert(rows, None, NOW)[1]
    out = numbered(folded.select("rkey", "first_ord", "record"), "first_ord", 1)
    return out.select("rkey", F.format_string("%03d_%s.json", "number", F.col("record.entity_id")).alias("file_name"))


def _dangling(spark, sf_dir) -> DataFrame:
    e = entities(spark, sf_dir)
    edges = e.select("entity_id", F.explode("relationships").alias("r")).select("entity_id", F.col("r.target").alias("target"))
    return edges.join(e.select(F.col("entity_id").alias("target")), "target", "left_anti")


def _rule_pipeline(spark, sf_dir) -> DataFrame:
    made = knowledge.usable_chunks(table(spark, sf_dir, "documents"), SHORT)
    e = knowledge.stamped(knowledge.arranged(knowledge.rule_extract(made.where("fault IS NULL"))))
    return e.groupBy("entity_type").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("n_ids"))


def _knowledge(spark, sf_dir) -> DataFrame:
    """Documents of a fixed model, through clustering and refining."""
    e = knowledge.arranged(knowledge.rule_extract(knowledge.usable_chunks(table(spark, sf_dir, "documents"), ChunkSettings()).where("fault IS NULL")))
    done = knowledge.refined(stage(knowledge.stamped(e), "extracted"))
    return done.groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("cluster_id").alias("n_clusters"))


def _spec_errors(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    kind = _pick(spec.TYPES, F.col("doc_id"))
    e = d.select(
        "doc_id", spec.slug_id(kind, F.substring("text", 1, 40)).alias("entity_id"), kind.alias("entity_type"), F.substring("text", 1, 40).alias("name"), F.substring("text", 1, 400).alias("description"),
        F.when(F.col("doc_id") % 3 > 0, "kb:product:base").alias("owner"), F.col("source").alias("source_document"), F.lit(0.9).alias("confidence"),
        F.array().cast("array<struct<type:string,target_id:string,context:string>>").alias("relationships"), F.create_map(F.lit("status"), F.lit("active")).alias("texts"),
        F.create_map(F.lit("steps"), F.array(F.lit("a"), F.lit("b"))).alias("lists"), F.lit(None).cast("array<struct<option:string,rejection_reason:string>>").alias("alternatives"),
    )
    return e.select("doc_id", "entity_id", F.array_join(spec.errors(), ";").alias("errors"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    e = entities
    pairs = lambda c: c.select("eid", "cid", "sim")
    return {
        "q01_clean_text": lambda s, d: _clean(s, d).select("doc_id", "text"),
        "q02_chunks": lambda s, d: _chunks(s, d, ChunkSettings()).drop("lang"),
        "q03_chunks_short": lambda s, d: _chunks(s, d, SHORT).drop("lang"),
        "q04_chunks_small": lambda s, d: _chunks(s, d, ChunkSettings(300, 200, 120, 50)).drop("lang"),
        "q05_chunk_pages": _pages,
        "q06_chunk_guard": lambda s, d: _chunks(s, d, SHORT).groupBy("lang", chunk_fault(F.col("chunk_text")).isNull().alias("usable")).agg(F.count("*").alias("n"), F.sum("char_count").alias("chars")),
        "q07_url_lines": _linked,
        "q08_html_text": lambda s, d: table(s, d, "pages").select("page_id", html_text("html").alias("text")),
        "q09_html_text_faithful": lambda s, d: table(s, d, "pages").select("page_id", html_text_faithful("html").alias("text")),
        "q10_entity_id": _part_ids,
        "q11_type_alias": lambda s, d: e(s, d).select("doc_id", correct_type(F.col("entity_type")).alias("entity_type"), entity_id(F.col("entity_type"), F.col("name")).alias("entity_id")),
        "q12_type_reclass": lambda s, d: e(s, d).select("doc_id", reclass_metric(F.lit("metric"), F.col("name"), F.col("description")).alias("entity_type")),
        "q13_confidence_clamp": lambda s, d: e(s, d).withColumn("c", clamp_confidence(F.col("confidence_scores"))).select("doc_id", F.col("c")["classification"].alias("classification"), F.col("c")["description"].alias("description")),
        "q14_name_fix": lambda s, d: table(s, d, "documents").select("doc_id", first_name(F.when(F.col("doc_id") % 4 > 0, F.array("source", "lang")).otherwise(F.array().cast("array<string>"))).alias("name")),
        "q15_validate_1": _validated(1),
        "q16_validate_2": _validated(2),
        "q17_validate_3": _validated(3),
        "q18_score": lambda s, d: _scored(s, d).select("doc_id", "description_depth", "relationship_quality", "type_confidence", "uniqueness", "total", "verdict"),
        "q19_verdict_counts": lambda s, d: _scored(s, d).groupBy("verdict").agg(F.count("*").alias("n")),
        "q20_canonical_gate": lambda s, d: e(s, d).groupBy((F.coalesce(F.col("status"), F.lit("")) == "canonical").alias("kept")).agg(F.count("*").alias("n")),
        "q21_tokens": lambda s, d: table(s, d, "documents").select("doc_id", F.array_join(F.array_sort(tokens(F.col("text"))), " ").alias("tokens")),
        "q22_jaccard_pairs": _pairs,
        "q23_clusters": _clusters,
        "q24_domain_candidates": lambda s, d: pairs(within_candidates(e(s, d))),
        "q25_fallback_candidates": lambda s, d: pairs(fallback_candidates(e(s, d).withColumn("domain", F.array(F.col("entity_id"))))),
        "q26_top2": lambda s, d: nearest_candidates(e(s, d), anywhere=False).select("eid", "cid", "rank"),
        "q27_enrich": lambda s, d: enrich(e(s, d)).select("doc_id", F.array_join(F.transform("relationships", lambda r: F.concat_ws(":", r["type"], r["target"])), ";").alias("edges"), F.col("confidence_scores")["relationships"].alias("confidence")),
        "q28_edge_type": lambda s, d: e(s, d).select("doc_id", edge_type(correct_type(F.col("entity_type")), _pick(("metric", "architecture", "implementation_ops", "product"), F.col("doc_id"))).alias("type")),
        "q29_document_clusters": _document_clusters,
        "q30_size_batches": lambda s, d: size_batches(table(s, d, "documents"), "source", "doc_id", "n_chars"),
        "q31_fixed_batches": lambda s, d: fixed_batches(table(s, d, "documents").select("doc_id", "source"), F.col("source"), "doc_id"),
        "q32_message_content": lambda s, d: table(s, d, "events").select("event_id", message_content(F.concat(F.lit('{"choices":[{"message":{"content":"'), F.coalesce("event_type", F.lit("")), F.lit('"}}]}'))).alias("content")),
        "q33_unwrap": _unwrapped,
        "q34_balanced_json": lambda s, d: _responses(s, d).select("event_id", balanced_json("text").alias("span"), extract_json("text").alias("value")),
        "q35_best_attempt": _attempts,
        "q40_registry_key": lambda s, d: e(s, d).select("doc_id", registry_key(F.col("domain"), correct_type(F.col("entity_type")), F.col("entity_id")).alias("rkey")),
        "q41_upsert_outcome": lambda s, d: _waves(s, d)[0].select(F.col("ord").alias("doc_id"), "outcome"),
        "q42_merged_fields": _merged,
        "q43_conflicts": lambda s, d: _waves(s, d)[0].where("outcome = 'conflicts'").select(F.col("ord").alias("doc_id"), "rkey", "message"),
        "q44_numbering": _numbers,
        "q45_list_union": lambda s, d: e(s, d).select("doc_id", F.array_join(list_union(F.col("domain"), F.array(F.lit("en"), F.lit("x"), F.lit("en"))), ",").alias("domain")),
        "q46_dangling_edges": _dangling,
        "q47_storage_errors": lambda s, d: e(s, d).select("doc_id", F.array_join(storage_errors(), ";").alias("errors"), banned_opener(F.col("description")).alias("banned")),
        "q50_pipeline_rule": _rule_pipeline,
        "q51_knowledge": _knowledge,
        "q60_spec_errors": _spec_errors,
    }
