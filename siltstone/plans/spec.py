"""An optional richer entity profile (an extension): slug identifiers, identity rules, field-wise merging, constraints.

Entities have entity_id, entity_type, name, aliases array<string>, description, owner, source_document, confidence double,
relationships array<struct<type, target_id, context>>, texts map<string,string> (prose and enumerated fields),
lists map<string,array<string>>, alternatives array<struct<option, rejection_reason>>, version int.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.similarity import jaccard

# The profile's vocabularies and limits.
TYPES = ("product", "component", "capability", "workflow", "decision", "constraint", "data_concept", "problem")
EDGE_TYPES = ("depends_on", "enables", "constrains", "owns", "solves", "uses", "contrasts_with", "rejects")
ENUMS = {
    "product_type": ("application", "platform_service", "legacy_system"), "deployment_model": ("cloud", "edge", "hybrid"),
    "status": ("active", "legacy", "transitional"), "execution_context": ("edge", "cloud", "hybrid"),
    "constraint_type": ("boundary", "non_goal", "limitation", "regulatory"), "concept_type": ("entity", "metric", "lifecycle_state"),
}
TIERS = ("platform", "tier_1", "tier_2", "stub")
REQUIRED_TEXTS = {
    "product": ("product_type", "deployment_model", "status", "purpose"), "component": (), "capability": ("responsibility_class",),
    "workflow": ("trigger", "completion_condition"), "decision": ("decision_statement",), "constraint": ("constraint_type", "why_it_exists"),
    "data_concept": ("concept_type", "represents"), "problem": (),
}
REQUIRED_LISTS = {
    "component": {"responsibilities": 1, "non_responsibilities": 1}, "capability": {"what_it_owns": 1, "what_it_does_not_own": 1},
    "workflow": {"steps": 2}, "decision": {"rationale": 1, "tradeoffs_accepted": 1}, "constraint": {"what_is_prevented": 1},
    "problem": {"why_hard": 1, "consequences_without": 1, "how_solved": 1},
}
NAME_CHARS, DESCRIPTION_CHARS, EDGES_MOST, CONTEXT_MOST, SLUG_MOST, SAME_NAME = (2, 200), (50, 1000), 15, 200, 60, 0.75
SEVERITY = {"description": "warning", "enum": "info", "entity_type": "error", "weaker": "info"}


def slug(name: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[™®©]", ""), r"[ \-/&]", "_")
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9_]", ""), "_+", "_")
    return F.substring(F.regexp_replace(s, r"^_+|_+\z", ""), 1, SLUG_MOST)


def slug_id(entity_type: Column, name: Column, namespace: str = "kb") -> Column:
    return F.concat_ws(":", F.lit(namespace), entity_type, slug(name))


def name_tokens(name: Column) -> Column:
    """Sorted tokens of a name, as names are compared."""
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[™®©]", ""), r"[\-/&]", " ")
    return F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(s, "[^a-z0-9 ]", ""), " +"), lambda w: w != "")))


def identity(existing: Column, incoming: Column) -> Column:
    """merge, review or null for a pair of structs; never across types."""
    aliases = F.transform(F.coalesce(existing["aliases"], F.array().cast("array<string>")), lambda a: F.array_join(name_tokens(a), " "))
    by_alias = F.array_contains(aliases, F.array_join(name_tokens(incoming["name"]), " "))
    near = jaccard(name_tokens(existing["name"]), name_tokens(incoming["name"])) >= SAME_NAME
    same = existing["entity_type"] == incoming["entity_type"]
    return F.when(same & ((existing["entity_id"] == incoming["entity_id"]) | by_alias), "merge").when(same & near, "review")


def _stronger(e: Column, i: Column, ce: Column, ci: Column, longer: bool) -> Column:
    """The value of higher confidence; at a tie the longer, or the incoming one."""
    tie = F.when(F.length(e) > F.length(i), e).otherwise(i) if longer else i
    return F.when(i.isNull(), e).when(e.isNull(), i).when(ci > ce, i).when(ci < ce, e).otherwise(tie)


def union_folded(a: Column, b: Column) -> Column:
    """Items of both lists, the first of those that are equal but for case and outer spaces."""
    both = F.concat(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>")))
    keys = F.transform(both, lambda x: F.lower(F.trim(x)))
    return F.filter(both, lambda x, i: F.array_position(keys, F.lower(F.trim(x))) == i + 1)


def _by_key(a: Column, b: Column, key, prefer_b: Column) -> Column:
    """Structs of both lists by key; of equal keys b's if it is preferred."""
    first, second = F.when(prefer_b, b).otherwise(a), F.when(prefer_b, a).otherwise(b)
    keys = F.transform(first, key)
    extra = F.filter(second, lambda x: ~F.array_contains(keys, key(x)))
    return F.when(prefer_b, F.concat(extra, first)).otherwise(F.concat(first, extra))


def merge(e: Column, i: Column) -> Column:
    """Two structs of one entity as one. Nothing is lost: lists and edges grow, confidence never falls, the id stays."""
    ce, ci = F.coalesce(e["confidence"], F.lit(0.0)), F.coalesce(i["confidence"], F.lit(0.0))
    prose = F.map_zip_with(e["texts"], i["texts"], lambda k, x, y: F.when(k.isin(*ENUMS), _stronger(x, y, ce, ci, False)).otherwise(_stronger(x, y, ce, ci, True)))
    items = F.map_zip_with(e["lists"], i["lists"], lambda k, x, y: F.when(k == "steps", F.when(F.coalesce(F.size(y), F.lit(0)) > F.coalesce(F.size(x), F.lit(0)), y).otherwise(x)).otherwise(union_folded(x, y)))
    sources = F.array_distinct(F.filter(F.transform(F.split(F.concat_ws(",", e["source_document"], i["source_document"]), ","), lambda s: F.trim(s)), lambda s: s != ""))
    return F.struct(
        e["entity_id"].alias("entity_id"), e["entity_type"].alias("entity_type"),
        F.when(F.length(i["name"]) > F.length(e["name"]), i["name"]).otherwise(F.coalesce(e["name"], i["name"])).alias("name"),
        union_folded(e["aliases"], i["aliases"]).alias("aliases"),
        _stronger(e["description"], i["description"], ce, ci, True).alias("description"), _stronger(e["owner"], i["owner"], ce, ci, False).alias("owner"),
        F.array_join(sources, ", ").alias("source_document"), F.greatest(ce, ci).alias("confidence"),
        _by_key(e["relationships"], i["relationships"], lambda r: F.concat_ws("|", r["type"], r["target_id"]), ci > ce).alias("relationships"),
        prose.alias("texts"), items.alias("lists"), _by_key(e["alternatives"], i["alternatives"], lambda a: a["option"], ci > ce).alias("alternatives"),
        (F.coalesce(e["version"], F.lit(1)) + 1).alias("version"),
    )


def conflicts(e: Column, i: Column) -> Column:
    """array<struct<code, severity>> of a pair."""
    ce, ci = F.coalesce(e["confidence"], F.lit(0.0)), F.coalesce(i["confidence"], F.lit(0.0))
    enum = F.exists(F.array(*[F.lit(k) for k in ENUMS]), lambda k: F.coalesce((e["texts"][k] != i["texts"][k]) & (ce == ci), F.lit(False)))
    found = {"entity_type": e["entity_type"] != i["entity_type"], "description": (e["description"] != i["description"]) & (ce == ci), "enum": enum, "weaker": ci < ce}
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(k).alias("code"), F.lit(SEVERITY[k]).alias("severity"))) for k, c in found.items()]), lambda x: x.isNotNull())


def errors(namespace: str = "kb") -> Column:
    """Codes of what the profile's constraints forbid, over the columns of an entity."""
    kinds = "|".join(TYPES)
    c, texts, lists = F.col, F.col("texts"), F.col("lists")
    missing = lambda x: F.coalesce(F.length(x), F.lit(0)) == 0
    kind = c("entity_type")
    pattern = rf"^{namespace}:({kinds}):[a-z0-9_]+\z"
    checks = [
        ("entity_id", ~F.coalesce(c("entity_id").rlike(pattern), F.lit(False))), ("entity_type", ~F.coalesce(kind.isin(*TYPES), F.lit(False))),
        ("name", ~F.coalesce(F.length("name").between(*NAME_CHARS), F.lit(False))), ("description", ~F.coalesce(F.length("description").between(*DESCRIPTION_CHARS), F.lit(False))),
        ("source_document", missing(c("source_document"))), ("confidence", ~F.coalesce(c("confidence").between(0, 1), F.lit(False))),
        ("relationships", c("relationships").isNull() | (F.size("relationships") > EDGES_MOST)),
        ("owner", F.when(kind != "product", ~F.coalesce(c("owner").rlike(rf"^{namespace}:product:[a-z0-9_]+\z"), F.lit(False))).otherwise(F.coalesce(~c("owner").rlike(rf"^{namespace}:product:[a-z0-9_]+\z"), F.lit(False)))),
        ("edges", F.coalesce(~F.forall("relationships", lambda r: F.coalesce(r["type"].isin(*EDGE_TYPES) & r["target_id"].rlike(pattern) & (F.length(r["context"]) <= CONTEXT_MOST), F.lit(False))), F.lit(False))),
        (f"{namespace}_tier", (kind == "product") & ~F.coalesce(texts[f"{namespace}_tier"].isin(*TIERS), F.lit(False))),
    ]
    for t, names in REQUIRED_TEXTS.items():
        checks += [(f"{t}.{n}", (kind == t) & missing(texts[n])) for n in names]
    for t, sizes in REQUIRED_LISTS.items():
        checks += [(f"{t}.{n}", (kind == t) & (F.coalesce(F.size(lists[n]), F.lit(0)) < least)) for n, least in sizes.items()]
    checks += [(k, F.coalesce(~texts[k].isin(*values), F.lit(False))) for k, values in ENUMS.items()]
    checks.append(("decision.alternatives", (kind == "decision") & c("alternatives").isNull()))
    return F.filter(F.array(*[F.when(cond, F.lit(code)) for code, cond in checks]), lambda x: x.isNotNull())
