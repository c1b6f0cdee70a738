"""Batches of entities for model calls."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K


@F.pandas_udf(T.IntegerType())
def json_size(rows: pd.Series) -> pd.Series:
    """Length of the compact-separator JSON that a model is sent, from Spark's JSON text (another spacing and escaping)."""
    return rows.map(lambda s: len(json.dumps(json.loads(s), default=str)) if s is not None else None).astype("Int32")


def size_batches(rows: DataFrame, group: str, order: str, size: str, most: int = K.STEP2_CHARS) -> DataFrame:
    """(group, order, batch_id): a batch ends before the row that would take it beyond most; large rows stand alone.

    The fold runs over each group's sizes only. Groups are documents, or whatever bounds a batch.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(size).cast("long").alias("size"))))
    folded = F.aggregate(
        ordered,
        F.expr(f"named_struct('used', 0L, 'batch', -1, 'out', array_repeat(named_struct('{order}', cast(null as {rows.schema[order].dataType.simpleString()}), 'batch', 0), 0))"),
        lambda acc, r: F.when(
            (acc["batch"] < 0) | (acc["used"] + r["size"] > most),
            F.struct(r["size"].alias("used"), (acc["batch"] + 1).alias("batch"), F.concat(acc["out"], F.array(F.struct(r[order].alias(order), (acc["batch"] + 1).alias("batch")))).alias("out")),
        ).otherwise(
            F.struct((acc["used"] + r["size"]).alias("used"), acc["batch"].alias("batch"), F.concat(acc["out"], F.array(F.struct(r[order].alias(order), acc["batch"].alias("batch")))).alias("out"))
        ),
        lambda acc: acc["out"],
    )
    out = rows.groupBy(group).agg(folded.alias("o")).select(group, F.explode("o").alias("o"))
    return out.select(group, F.col("o")[order].alias(order), F.col("o")["batch"].alias("batch_id"))


def fixed_batches(rows: DataFrame, group: Column, order: str, size: int = K.STEP3_SIZE) -> DataFrame:
    """rows with batch_id: size rows of a group each, by order."""
    number = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("batch_id", F.floor((number - 1) / size).cast("int"))
