"""Entity columns: identifiers, type correction, confidence, validation, scoring.

Entities have the columns entity_id, entity_type, name, description, domain array<string>, relationships
array<struct<type, target, ...>>, confidence_scores map<string,double>, status, ord (order of arrival).
Errors and warnings are arrays of codes, so that they can be counted and joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import constants as K
from .text import sentences, strip


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _contains_any(text: Column, parts) -> Column:
    return _any(text.contains(p) for p in parts)


def entity_id(entity_type: Column, name: Column, attributes: Column | None = None) -> Column:
    """TYPE-<12 hex digits> of type, name and attributes (a map; null values don't count)."""
    kind, name = strip(F.lower(F.coalesce(entity_type, F.lit("unknown")))), strip(F.lower(F.coalesce(name, F.lit(""))))
    signature = F.lit("")
    if attributes is not None:
        held = F.filter(F.map_entries(attributes), lambda e: e["value"].isNotNull())
        signature = F.coalesce(F.array_join(F.array_sort(F.transform(held, lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "|"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(kind, F.lit("::"), name, F.lit("::"), signature), 256), 1, 12)
    return F.concat(F.substring(F.replace(F.upper(kind), F.lit(" "), F.lit("-")), 1, 8), F.lit("-"), digest)


def correct_type(entity_type: Column) -> Column:
    """Valid types stay; else the alias, the snake case, or the first alias that is part of it or holds it."""
    low = F.lower(entity_type)
    exact = F.coalesce(*[F.when(low == a, v) for a, v in K.TYPE_ALIASES])
    snake = F.lower(F.regexp_replace(entity_type, "([a-z0-9])([A-Z])", "$1_$2"))
    partial = F.coalesce(*[F.when(low.contains(a) | F.lit(a).contains(low), v) for a, v in K.TYPE_ALIASES])
    return F.when(entity_type.isin(*K.ENTITY_TYPES), entity_type).otherwise(
        F.coalesce(exact, F.when(snake.isin(*K.ENTITY_TYPES), snake), partial, entity_type)
    )


def reclass_metric(entity_type: Column, name: Column, description: Column) -> Column:
    """Types of metrics that measure nothing."""
    desc = F.lower(F.coalesce(description, F.lit("")))
    keyword = _contains_any(F.concat(desc, F.lit(" "), F.lower(F.coalesce(name, F.lit("")))), K.METRIC_KEYWORDS)
    digit = desc.rlike(r"\p{Nd}")
    new = (
        F.when(keyword & digit, "metric")
        .when(
            _contains_any(desc, K.NON_METRIC_SIGNALS),
            F.when(_contains_any(desc, ("feature", "captures", "detects")), "product_theory")
            .when(_contains_any(desc, ("designed to", "system", "device", "component")), "architecture")
            .when(_contains_any(desc, ("step", "procedure", "implements")), "implementation_ops")
            .otherwise("product_theory"),
        )
        .when(~digit & ~keyword, "product_theory")
        .otherwise("metric")
    )
    return F.when(entity_type == "metric", new).otherwise(entity_type)


def first_name(names: Column) -> Column:
    """The name of an entity that was given a list of names."""
    return F.coalesce(F.get(names, F.lit(0)), F.lit(""))


def clamp_confidence(scores: Column) -> Column:
    """All of exactly 1.0 become 0.85."""
    sure = (F.size(scores) > 0) & F.forall(F.map_values(scores), lambda v: v == 1.0)
    return F.when(sure, F.transform_values(scores, lambda k, v: F.lit(0.85))).otherwise(scores)


def banned_opener(description: Column) -> Column:
    low = F.lower(strip(description))
    return F.coalesce(_any(low.startswith(b) for b in K.BANNED_OPENERS), F.lit(False))


def _codes(*codes: Column) -> Column:
    return F.filter(F.array(*codes), lambda x: x.isNotNull())


def _blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def extraction_errors(kind: Column, name: Column, domain: Column, description: Column) -> tuple[Column, Column]:
    """(errors, warnings) of an extracted entity whose type has been corrected."""
    desc = F.coalesce(description, F.lit(""))
    n, s = F.length(desc), sentences(desc)
    low = F.lower(desc)
    errors = _codes(
        F.when(~F.coalesce(kind.isin(*K.ENTITY_TYPES), F.lit(False)), F.concat(F.lit("entity_type:"), F.coalesce(kind, F.lit("")))),
        F.when(_blank(name), F.lit("name")),
        F.when(domain.isNull() | (F.size(domain) < 1), F.lit("domain")),
        F.when(n < K.DESCRIPTION_LEAST, F.concat(F.lit("description_length:"), n.cast("string"))).when(
            s < K.SENTENCES_LEAST, F.concat(F.lit("description_sentences:"), s.cast("string"))
        ),
        F.when(banned_opener(desc), F.lit("description_opener")),
    )
    warnings = _codes(F.when((kind == "metric") & (desc != "") & ~desc.rlike(r"\p{Nd}") & ~_contains_any(low, K.METRIC_KEYWORDS), F.lit("metric_evidence")))
    return errors, warnings


def relationship_errors(relationships: Column, eid: Column) -> Column:
    """Codes with the place of each faulty edge."""

    def of(r, i):
        where = F.concat(F.lit("relationship["), i.cast("string"), F.lit("]"))
        target = F.coalesce(r["target"], F.lit(""))
        kind = F.coalesce(r["type"], F.lit(""))
        return _codes(
            F.when(~kind.isin(*K.RELATIONSHIP_TYPES), F.concat(where, F.lit(".type:"), kind)),
            F.when(target == "", F.concat(where, F.lit(".target"))),
            F.when((target != "") & (target == F.coalesce(eid, F.lit(""))), F.concat(where, F.lit(".self"))),
        )

    none = relationships.isNull() | (F.size(relationships) < 1)
    return F.when(none, F.array(F.lit("relationships"))).otherwise(F.flatten(F.transform(relationships, of)))


def validate(entities: DataFrame, step: int) -> DataFrame:
    """entities with entity_type, status and confidence_scores corrected, and errors, warnings, passed, auto_fixes.

    step 1: after extraction; 2: after normalising; 3: after merging (names are unique, by order of arrival).
    """
    e = entities.withColumn("_raw", F.col("entity_type")).withColumn("entity_type", correct_type(F.col("entity_type")))
    errors, warnings = extraction_errors(F.col("entity_type"), F.col("name"), F.col("domain"), F.col("description"))
    fixes = [F.when(~F.col("_raw").eqNullSafe(F.col("entity_type")), F.lit("entity_type"))]
    if step >= 2:
        errors = F.concat(errors, _codes(F.when(_blank(F.col("entity_id")), F.lit("entity_id"))), relationship_errors(F.col("relationships"), F.col("entity_id")))
        e = e.withColumn("_clamped", clamp_confidence(F.col("confidence_scores")))
        fixes.append(F.when(F.col("_clamped")["classification"].isNotNull() & ~F.array_sort(F.map_values("_clamped")).eqNullSafe(F.array_sort(F.map_values("confidence_scores"))), F.lit("confidence_scores")))
        scores = F.col("confidence_scores")
        missing = [F.when(scores.isNotNull() & scores[k].isNull(), F.lit(f"confidence_scores.{k}")) for k in K.CONFIDENCE_KEYS]
        warnings = F.concat(warnings, _codes(F.when(scores.isNull(), F.lit("confidence_scores")), *missing))
    e = e.withColumn("errors", errors)
    if step >= 3:
        e = e.withColumn("_known", F.coalesce(F.col("status").isin("canonical", "duplicate"), F.lit(False))).withColumn("_good", F.size("errors") == 0)
        known, good = F.col("_known"), F.col("_good")
        fixes.append(F.when(~known & good, F.lit("status")))
        e = e.withColumn("errors", F.when(~known & ~good, F.concat("errors", F.array(F.concat(F.lit("status:"), F.coalesce("status", F.lit("")))))).otherwise(F.col("errors")))
        e = e.withColumn("status", F.when(~known & good, "canonical").otherwise(F.col("status")))
        named = ~_blank(F.col("name"))
        holder = F.first("entity_id").over(Window.partitionBy(F.when(named, F.lower(strip(F.col("name"))))).orderBy("ord"))
        edges, length = F.coalesce(F.size("relationships"), F.lit(0)), F.length(F.coalesce("description", F.lit("")))
        e = e.withColumn("_holder", F.when(named, holder))
        warnings = F.concat(
            warnings,
            _codes(
                F.when((F.col("status") == "canonical") & (edges < 2), F.concat(F.lit("few_relationships:"), edges.cast("string"))),
                F.when(length < K.DESCRIPTION_GOOD, F.concat(F.lit("description_length:"), length.cast("string"))),
                F.when(F.col("_holder") != F.col("entity_id"), F.concat(F.lit("name_of:"), F.col("_holder"))),
            ),
        )
    e = e.withColumn("warnings", warnings).withColumn("auto_fixes", _codes(*fixes)).withColumn("passed", F.size("errors") == 0)
    if step >= 2:
        e = e.withColumn("confidence_scores", F.col("_clamped"))
    return e.drop("_raw", "_clamped", "_holder", "_known", "_good")


def storage_errors() -> Column:
    """Codes of what keeps an entity out of the store."""
    domain, eid, status, kind = F.col("domain"), F.col("entity_id"), F.col("status"), F.col("entity_type")
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in ("entity_id", "entity_type", "domain", "status")]
    blank = F.transform(domain, lambda d, i: F.when(_blank(d), F.concat(F.lit("domain["), i.cast("string"), F.lit("]"))))
    return F.concat(
        _codes(*missing, F.when(F.size(domain) == 0, F.lit("domain"))),
        F.coalesce(F.filter(blank, lambda x: x.isNotNull()), F.array().cast("array<string>")),
        _codes(
            F.when(~kind.isin(*K.ENTITY_TYPES), F.concat(F.lit("entity_type:"), kind)),
            F.when(strip(eid) == "", F.lit("entity_id")),
            F.when(eid.contains("/") | eid.contains("\\"), F.lit("entity_id_path")),
            F.when(strip(status) == "", F.lit("status")),
        ),
    )


def score(entities: DataFrame, seen: Column | None = None) -> DataFrame:
    """entities with description_depth, relationship_quality, type_confidence, uniqueness, total and verdict.

    seen: whether the name has been met before; unknown without it.
    """
    desc = F.coalesce("description", F.lit(""))
    depth = F.least(
        F.lit(1.0),
        F.least(F.lit(1.0), sentences(desc) / 3) * 0.4 + F.least(F.lit(1.0), F.length(desc) / 200) * 0.3 + F.when(banned_opener(desc), 0.0).otherwise(0.3),
    )
    edges = F.least(F.lit(1.0), F.coalesce(F.when(F.col("relationships").isNotNull(), F.size("relationships")), F.lit(0)) / 3)
    sure = F.coalesce(F.col("confidence_scores")["classification"], F.col("confidence_scores")["entity_type"], F.lit(0.5))
    unique = F.lit(0.8) if seen is None else F.when(seen, 0.3).otherwise(1.0)
    e = entities.withColumn("description_depth", depth).withColumn("relationship_quality", edges)
    e = e.withColumn("type_confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), sure))).withColumn("uniqueness", unique)
    e = e.withColumn("total", F.col("description_depth") * 0.35 + F.col("relationship_quality") * 0.25 + F.col("type_confidence") * 0.25 + F.col("uniqueness") * 0.15)
    return e.withColumn("verdict", F.when(F.col("total") >= K.ACCEPT, "accept").when(F.col("total") >= K.WARN, "warn").otherwise("reject"))
