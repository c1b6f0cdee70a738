"""The whole way from documents to the knowledge base, one DataFrame per step.

Model calls are pluggable: `extract` makes entities of chunks, `normalise` and `refine` may change them. The defaults are rules, so that
the plan runs, and can be checked, without a model; model_extract(...) puts a generator in place of the first.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.entities import clamp_confidence, correct_type, entity_id, reclass_metric, score
from ..functions.responses import entity_json
from ..functions.text import chunk_fault, clean_page
from ..operators.batching import fixed_batches, size_batches
from ..operators.chunking import ChunkSettings, chunks
from ..operators.generation import extraction_faults, generate
from ..operators.similarity import clusters, enrich
from .staging import stage

EDGES = "array<struct<type:string,target:string,_auto_generated:boolean>>"


@dataclass
class Result:
    chunks: int = 0
    unusable: int = 0
    extracted: int = 0
    normalised: int = 0
    refined: int = 0
    stats: dict = field(default_factory=dict)
    errors: list = field(default_factory=list)
    duration_ms: int = 0


def usable_chunks(docs: DataFrame, settings: ChunkSettings) -> DataFrame:
    """Chunks of (doc_id, text, ...) with fault, null where they are worth a call."""
    clean = docs.where(F.col("text").isNotNull()).withColumn("text", clean_page(F.col("text")))
    return chunks(clean, F.col("doc_id").cast("string"), settings).withColumn("fault", chunk_fault(F.col("chunk_text")))


def rule_extract(usable: DataFrame) -> DataFrame:
    """One entity a chunk: its first 60 characters as name and 400 as description. A stand-in, not a model's answer."""
    others = [F.col(c) for c in ("lang", "source") if c in usable.columns]
    return usable.select(
        "doc_id", "chunk_index", F.when(F.col("chunk_text").rlike(r"\p{Nd}"), "metric").otherwise("concept").alias("entity_type"),
        F.substring("chunk_text", 1, 60).alias("name"), F.substring("chunk_text", 1, 400).alias("description"),
        (F.array(*others) if others else F.array(F.lit("general"))).alias("domain"),
        F.create_map(F.lit("classification"), F.lit(0.5).cast("double")).alias("confidence_scores"), F.lit("canonical").alias("status"),
    )


def model_extract(generator, system: str = "", retries: int = K.VALIDATION_RETRIES, **settings) -> Callable[[DataFrame], DataFrame]:
    """An extract step that asks a model for each chunk; chunks without an answer give no entity."""

    def run(usable: DataFrame) -> DataFrame:
        head = F.format_string("Extract all entities from this document chunk (chunk %d, pages %d-%d):\n\n%s", "chunk_index", "page_start", "page_end", "chunk_text")
        asked = generate(usable.withColumn("prompt", head), "prompt", generator, system, extraction_faults, retries, **settings)
        e = asked.select("doc_id", "chunk_index", F.explode(entity_json(F.col("answer.raw_text"))).alias("json"))
        v = F.try_parse_json("json")
        get = lambda path, kind: F.try_variant_get(v, path, kind)
        name = F.coalesce(F.when(F.schema_of_variant(v).contains("name: ARRAY"), get("$.name[0]", "string")), get("$.name", "string"))
        return e.select(
            "doc_id", "chunk_index", get("$.entity_type", "string").alias("entity_type"), name.alias("name"), get("$.description", "string").alias("description"),
            get("$.domain", "array<string>").alias("domain"), get("$.confidence_scores", "map<string,double>").alias("confidence_scores"),
            get("$.status", "string").alias("status"),
            F.filter(get("$.relationships", EDGES), lambda r: r["type"].isNotNull() & r["target"].isNotNull()).alias("relationships"),
            get("$.attributes", "map<string,string>").alias("attributes"),
        )

    return run


def arranged(entities: DataFrame) -> DataFrame:
    """entities with ord: the order of documents, chunks, names and, as these may repeat, rows; relationships as extracted, or none. To be staged."""
    e = entities.withColumn("ord", F.struct("doc_id", "chunk_index", "name", "entity_type", F.monotonically_increasing_id().alias("row")))
    empty = F.array().cast(EDGES)
    return e.withColumn("relationships", F.coalesce("relationships", empty) if "relationships" in e.columns else empty)


def corrected(entities: DataFrame, types_first: bool) -> DataFrame:
    kinds = [lambda c: reclass_metric(c, F.col("name"), F.col("description")), correct_type]
    for f in kinds[::-1] if types_first else kinds:
        entities = entities.withColumn("entity_type", f(F.col("entity_type")))
    return entities


def stamped(entities: DataFrame) -> DataFrame:
    """entities with aliases of types resolved, an entity_id, and metrics that measure nothing reclassed."""
    e = entities.withColumn("entity_type", correct_type(F.col("entity_type")))
    own = [F.col("attributes")] if "attributes" in e.columns else []
    return corrected(e.withColumn("entity_id", entity_id(F.col("entity_type"), F.col("name"), *own)), False)


def refined(entities: DataFrame, refine=None) -> DataFrame:
    """entities after clusters: singletons pass, larger ones go through refine, or keep their first member as canonical.

    Clusters are of rows, by ord, as ids may repeat; cluster_id is the ord of the first.
    """
    e = entities.withColumn("_text", F.concat_ws(" ", "name", "description"))
    label = stage(clusters(e, "ord", F.col("_text")), "clusters")
    heads = label.where("cluster_id <> ord").select(F.col("cluster_id").alias("ord"), F.lit(True).alias("_heads")).distinct()
    e = e.drop("_text").join(label, "ord").join(heads, "ord", "left")
    e = e.withColumn("_many", F.coalesce("_heads", F.col("cluster_id") != F.col("ord"))).drop("_heads")
    single = e.where(~F.col("_many"))
    many = e.where("_many")
    if refine:
        many = refine(many)
    else:
        many = many.withColumn("status", F.when(F.col("cluster_id") == F.col("ord"), "canonical").otherwise("duplicate"))
    out = single.withColumn("status", F.when(F.coalesce("status", F.lit("")) == "", "canonical").otherwise(F.col("status")))
    return out.unionByName(many).drop("_many")


def run(spark: SparkSession, docs: DataFrame, base=None, now: str = "", settings: ChunkSettings = ChunkSettings(), extract=rule_extract, normalise=None, refine=None) -> tuple[DataFrame, Result]:
    """(entities, result): chunk, extract, stamp, normalise, enrich, cluster, refine and, with a KnowledgeBase, persist."""
    began, result = time.monotonic(), Result()
    all_chunks = stage(usable_chunks(docs, settings), "chunks")
    result.chunks, result.unusable = (all_chunks.agg(F.count("*"), F.count("fault")).first()[i] for i in (0, 1))
    raw = stage(stamped(arranged(extract(all_chunks.where("fault IS NULL")))), "extracted")
    result.extracted = raw.count()
    normal = raw
    if normalise:
        sized = raw.withColumn("size", F.length(F.to_json(F.struct("entity_id", "entity_type", "name", "description", "domain"))))
        batched = raw.join(size_batches(sized, "doc_id", "ord", "size"), ["doc_id", "ord"])
        normal = normalise(batched)
    normal = corrected(normal, False).withColumn("confidence_scores", clamp_confidence(F.col("confidence_scores")))
    normal = stage(enrich(normal), "normalised")
    result.normalised = normal.count()
    done = stage(refined(normal, refine), "refined")
    result.refined = done.where("status = 'canonical'").count()
    if base is not None:
        result.stats = base.persist(done, now)
    result.duration_ms = int((time.monotonic() - began) * 1000)
    return score(done), result


def batches_for_refining(entities: DataFrame) -> DataFrame:
    """entities with batch_id: fixed batches in order, for a second refining over clusters."""
    return fixed_batches(entities, F.lit(0), "ord")
