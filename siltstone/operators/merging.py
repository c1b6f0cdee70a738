"""Ordered merging of entities that share a registry key.

Merging is not commutative, so arrivals of a key are folded in order, in one aggregate expression over their sorted array:
a new key is saved, an arrival whose name differs at equal confidence is a conflict and changes nothing, any other is merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALARS = ("entity_id", "entity_type", "name", "description", "status", "_quality_score")
RECORD = (
    "struct<entity_id:string,entity_type:string,name:string,description:string,status:string,_quality_score:double,"
    "domain:array<string>,relationships:array<struct<type:string,target:string,_auto_generated:boolean>>,"
    "confidence_scores:map<string,double>,last_updated:string>"
)


def registry_key(domain: Column, entity_type: Column, entity_id: Column) -> Column:
    return F.concat(F.get(domain, F.lit(0)), F.lit("::"), entity_type, F.lit("::"), entity_id)


def list_union(a: Column, b: Column) -> Column:
    """Both lists without repeats, in order of first occurrence; null counts as empty, unless both are."""
    return F.coalesce(F.array_distinct(F.concat(a, b)), a, b)


def _confidence(scores: Column, field: str) -> Column:
    return F.coalesce(F.try_element_at(scores, F.lit(field)), F.lit(0.0))


def conflict(existing: Column, incoming: Column) -> Column:
    """A code of what can't be merged, or null: type, or a field of identity that differs at equal confidence."""

    def both(field):
        e, i = existing[field], incoming[field]
        return F.coalesce((e != "") & (i != "") & (e != i), F.lit(False))

    code = F.when(both("entity_type"), F.concat(F.lit("entity_type:"), existing["entity_type"], F.lit("|"), incoming["entity_type"]))
    for field in ("name", "entity_type"):
        tie = _confidence(existing["confidence_scores"], field) == _confidence(incoming["confidence_scores"], field)
        code = F.coalesce(code, F.when(both(field) & tie, F.concat(F.lit(f"{field}:"), existing[field], F.lit("|"), incoming[field])))
    return code


def merge(existing: Column, incoming: Column, now: Column) -> Column:
    """Scalars: the incoming one if it is not null and its confidence not lower. Lists: union. Confidences follow the scalars."""
    te, se = existing["confidence_scores"], incoming["confidence_scores"]
    fields, entries = [], []
    for f in SCALARS:
        e, i = existing[f], incoming[f]
        ce, ci = _confidence(te, f), _confidence(se, f)
        fields.append(F.when(i.isNull(), e).when(e.isNull() | (ci >= ce), i).otherwise(e).alias(f))
        value = F.when(i.isNull(), F.lit(None)).when(e.isNull(), F.try_element_at(se, F.lit(f))).when(ci >= ce, ci)
        entries.append(F.struct(F.lit(f).alias("key"), value.alias("value")))
    new = F.map_from_entries(F.filter(F.array(*entries), lambda x: x["value"].isNotNull()))
    kept = F.coalesce(te, F.expr("cast(map() as map<string,double>)"))
    scores = F.map_concat(F.map_filter(kept, lambda k, v: ~F.map_contains_key(new, k)), new)
    return F.struct(
        *fields, list_union(existing["domain"], incoming["domain"]).alias("domain"),
        list_union(existing["relationships"], incoming["relationships"]).alias("relationships"),
        F.when(F.size(scores) > 0, scores).otherwise(te).alias("confidence_scores"), now.alias("last_updated"),
    ).cast(RECORD)


def record(now: Column) -> Column:
    columns = [F.col(c) for c in (*SCALARS, "domain", "relationships", "confidence_scores")]
    return F.struct(*columns, now.alias("last_updated")).cast(RECORD)


def fold(arrivals: DataFrame, existing: DataFrame | None, now: Column) -> DataFrame:
    """(rkey, known, first_ord, record, log): the record of each key after all arrivals.

    arrivals: (rkey, ord, record); existing: (rkey, record). log: array<struct<ord, outcome, message, incoming>> of the arrivals that
    were not merged silently: each has an outcome of saved, merged or conflicts.
    """
    by_order = lambda x, y: F.when(x["ord"] < y["ord"], -1).when(x["ord"] > y["ord"], 1).otherwise(0)
    lists = arrivals.groupBy("rkey").agg(F.array_sort(F.collect_list(F.struct("ord", "record")), by_order).alias("a"), F.min("ord").alias("first_ord"))
    if existing is not None:
        lists = lists.join(existing.withColumnRenamed("record", "before"), "rkey", "left")
    else:
        lists = lists.withColumn("before", F.lit(None).cast(RECORD))
    kind = arrivals.schema["ord"].dataType.simpleString()
    log = f"array<struct<ord:{kind},outcome:string,message:string>>"
    zero = F.struct(F.col("before").alias("record"), F.array().cast(log).alias("log"))

    def step(acc, x):
        message = conflict(acc["record"], x["record"])
        outcome = F.when(acc["record"].isNull(), "saved").when(message.isNotNull(), "conflicts").otherwise("merged")
        after = F.when(acc["record"].isNull(), x["record"]).when(message.isNotNull(), acc["record"]).otherwise(merge(acc["record"], x["record"], now))
        entry = F.struct(x["ord"].alias("ord"), outcome.alias("outcome"), F.when(outcome == "conflicts", message).alias("message"))
        return F.struct(after.alias("record"), F.concat(acc["log"], F.array(entry)).cast(log).alias("log"))

    done = lists.withColumn("f", F.aggregate("a", zero, step))
    return done.select("rkey", F.col("before").isNotNull().alias("known"), "first_ord", F.col("f")["record"].alias("record"), F.col("f")["log"].alias("log"))
