"""Column expressions that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import stage

#: What separates words of non-space characters, and words of letters and digits (ASCII ones, and all beyond ASCII).
SPACES = r"[\x20\x09-\x0D]+"
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Pure ASCII takes the quicker lower()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, separators: str) -> Column:
    """The words between separators; null has none."""
    return F.coalesce(F.array_remove(F.split(text, separators), ""), F.array().cast("array<string>"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as text, and text: for pandas, which has no exact 64-bit integers next to nulls."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def with_own_id(out: DataFrame, docs: DataFrame) -> DataFrame:
    """out with doc_id in the type that it has in docs."""
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


#: The number of a row, where null or repeated ids don't tell rows apart.
ROW = "_siltstone_row"


def with_row(docs: DataFrame) -> DataFrame:
    """docs staged with ROW, which so is the same whenever it is read."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


#: Rows of an Arrow batch. Texts may be long, and a batch is held several times over, by the JVM and by Python.
BATCH_ROWS = 500


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to BATCH_ROWS rows, if they are larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
