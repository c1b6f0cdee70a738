"""The knowledge base: versioned Parquet tables with a registry and a log of conflicts.

    <base>/v=<n>-<id>/entities    records, by entity_type and primary_domain
    <base>/v=<n>-<id>/registry    a row for each key: number, file_name, path, ...
    <base>/v=<n>-<id>/conflicts   what this version didn't merge
    <base>/CURRENT                the folders of all versions, a line each; the last one is valid

A version is written whole, to a folder of its own attempt, before CURRENT is replaced by a rename; a run that breaks off leaves the
last version valid, and a folder that nothing names and no later run meets. One writer at a time: a version that has moved on meanwhile is an
error, not overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.entities import correct_type, score, storage_errors
from ..operators.merging import RECORD, fold, record, registry_key
from ..plans.staging import stage

FIELDS = ("entity_id", "entity_type", "name", "description", "status", "_quality_score", "domain", "relationships", "confidence_scores", "last_updated")
OUTCOMES = ("saved", "merged", "skipped", "conflicts", "invalid")


class _Files:
    """The store's folder, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.jvm, self.base = spark.sparkContext._jvm, base.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def versions(self) -> list[str]:
        """The folders of all versions."""
        at = self.path("CURRENT")
        if not self.fs.exists(at):
            return []
        stream = self.fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode().split()
        finally:
            stream.close()

    def current(self) -> int:
        return len(self.versions())

    def swap(self, versions: list[str]) -> None:
        temporary, final = self.path(f"CURRENT.{versions[-1]}"), self.path("CURRENT")
        out = self.fs.create(temporary, True)
        out.write(bytearray("\n".join(versions).encode()))
        out.hsync()
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        kinds = self.jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        kinds[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf).rename(temporary, final, kinds)


def numbered(rows: DataFrame, order: str, first: int) -> DataFrame:
    """rows with number: first, first + 1, ... by order. Ranges are numbered on their own; only their sizes meet."""
    ranges = stage(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return ranges.join(F.broadcast(sizes), "_part").withColumn("number", place + F.col("_before") + first - 1).drop("_part", "_before")


def safe(part: Column) -> Column:
    """A name that is one step of a path."""
    return F.when(part.isin("", ".", ".."), "_").otherwise(F.regexp_replace(part, r"[/\\\x00]", "_"))


def judged(entities: DataFrame) -> DataFrame:
    """entities with outcome: skipped, invalid, or null for those that reach the store; reasons tells why."""
    e = score(entities.withColumn("entity_type", correct_type(F.col("entity_type"))))
    e = e.withColumn("_quality_score", F.round("total", 3)).withColumn("reasons", storage_errors())
    canonical = F.coalesce(F.col("status") == "canonical", F.lit(False))
    outcome = F.when(~canonical, "skipped").when((F.size("reasons") > 0) | (F.col("verdict") == "reject"), "invalid")
    return e.withColumn("outcome", outcome)


def arrivals(good: DataFrame, now: Column) -> DataFrame:
    key = registry_key(F.col("domain"), F.col("entity_type"), F.col("entity_id"))
    return good.select(key.alias("rkey"), "ord", record(now).alias("record"))


def upsert(entities: DataFrame, existing: DataFrame | None, now: str) -> tuple[DataFrame, DataFrame]:
    """(outcomes: ord, rkey, outcome, message; folded: rkey, known, first_ord, record, log)."""
    clock = F.lit(now)
    e = stage(judged(entities), "judged")
    folded = stage(fold(arrivals(e.where("outcome IS NULL"), clock), existing, clock), "folded")
    stored = folded.select("rkey", F.explode("log").alias("l")).select("l.ord", "rkey", "l.outcome", "l.message")
    refused = e.where("outcome IS NOT NULL").select("ord", F.lit(None).cast("string").alias("rkey"), "outcome", F.array_join("reasons", ";").alias("message"))
    return stored.unionByName(refused), folded


class KnowledgeBase:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base, self.files = spark, base.rstrip("/"), _Files(spark, base)

    def _read(self, table: str) -> DataFrame | None:
        version = self.files.current()
        return self.spark.read.parquet(f"{self.base}/{self.files.versions()[version - 1]}/{table}") if version else None

    def entities(self) -> DataFrame | None:
        """The records, with primary_domain; filters on entity_type and primary_domain prune folders."""
        return self._read("entities")

    def registry(self) -> DataFrame | None:
        return self._read("registry")

    def conflicts(self) -> DataFrame | None:
        """Of all versions."""
        versions = self.files.versions()
        return self.spark.read.parquet(*[f"{self.base}/{v}/conflicts" for v in versions]) if versions else None

    def persist(self, entities: DataFrame, now: str) -> dict[str, int]:
        """Save or merge canonical entities in their order (ord); how many had each outcome."""
        count_before = self.files.current()
        versions = self.files.versions()[:count_before]
        before, registry = self.entities(), self.registry()
        existing = None
        if before is not None:
            existing = before.select("rkey", F.struct(*FIELDS).cast(RECORD).alias("record"))
        outcomes, folded = upsert(entities, existing, now)
        outcomes = stage(outcomes, "outcomes")
        count = registry.agg(F.max("number")).first()[0] or 0 if registry is not None else 0
        version = f"v={len(versions) + 1}-{uuid.uuid4().hex}"
        target = f"{self.base}/{version}"

        new = numbered(folded.where(~F.col("known")).select("rkey", "first_ord", "record"), "first_ord", count + 1)
        new = new.select("rkey", "number", F.concat(F.format_string("%03d", "number"), F.lit("_"), F.col("record")["entity_id"], F.lit(".json")).alias("file_name"), "record")
        path = F.concat_ws("/", F.col("record")["entity_type"], safe(F.get(F.col("record")["domain"], F.lit(0))), safe(F.col("file_name")))
        rows = new.select("rkey", "number", "file_name", F.col("record")["entity_type"].alias("entity_type"), F.col("record")["domain"].alias("domain"), path.alias("path"), F.col("record")["last_updated"].alias("last_updated"))
        merged = folded.where("known AND exists(log, l -> l.outcome = 'merged')").select("rkey", F.col("record")["domain"].alias("m_domain"), F.col("record")["last_updated"].alias("m_updated"))
        if registry is not None:
            old = registry.join(merged, "rkey", "left").withColumn("domain", F.coalesce("m_domain", "domain")).withColumn("last_updated", F.coalesce("m_updated", "last_updated"))
            rows = rows.unionByName(old.drop("m_domain", "m_updated"))
        rows.write.parquet(f"{target}/registry")

        records = folded.select("rkey", "record.*")
        if before is not None:
            records = records.unionByName(before.join(folded.select("rkey"), "rkey", "left_anti").select(records.columns))
        records = records.withColumn("primary_domain", safe(F.get("domain", F.lit(0)))).withColumn("type", F.col("entity_type"))
        records.write.partitionBy("type", "primary_domain").parquet(f"{target}/entities")

        clashes = outcomes.where("outcome = 'conflicts'").join(entities, "ord")
        incoming = F.to_json(F.struct("entity_id", "entity_type", "name", "description", "domain", "status"))
        clashes.select(F.col("rkey").alias("registry_key"), "message", F.lit(now).alias("timestamp"), incoming.alias("incoming_entity")).write.parquet(f"{target}/conflicts")

        if self.files.current() != count_before:
            raise RuntimeError(f"another writer has moved {self.base} on from version {count_before}")
        self.files.swap([*versions, version])
        counts = {r["outcome"]: r["n"] for r in outcomes.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
        return {k: counts.get(k, 0) for k in OUTCOMES}

    def export_json(self, path: str) -> None:
        """The records as JSON lines, in folders by type and domain."""
        self.entities().write.partitionBy("type", "primary_domain").mode("overwrite").json(path)


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """Records from JSON files of one object each, below path; a missing path is an empty table."""
    files = _Files(spark, path)
    schema = spark.createDataFrame([], "r " + RECORD).select("r.*").schema
    if not files.fs.exists(files.path("")):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
