"""DuckDB SQL of the queries in queries.py, written on its own: other functions, windows and recursive queries."""

from __future__ import annotations

from .functions import constants as K
from .operators.chunking import SHORT, ChunkSettings
from .plans import spec
from .queries import RAW_TYPES

S = K.SPACE


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^{S}+', ''), '{S}+\z', '')"


def _clean(x: str) -> str:
    x = f"regexp_replace({x}, '(?im){K.NUMBER_LINE}', '', 'g')"
    return _strip(rf"regexp_replace(regexp_replace({x}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[({index}) % {len(values)} + 1]"


TYPES, ALIASES = _list(K.ENTITY_TYPES), "[" + ", ".join(f"{{'a': '{a}', 'v': '{v}'}}" for a, v in K.TYPE_ALIASES) + "]"


def _type(x: str) -> str:
    snake = rf"lower(regexp_replace({x}, '([a-z0-9])([A-Z])', '\1_\2', 'g'))"
    return (
        f"CASE WHEN list_contains({TYPES}, {x}) THEN {x} ELSE coalesce(list_filter({ALIASES}, lambda p: p.a = lower({x}))[1].v, "
        f"CASE WHEN list_contains({TYPES}, {snake}) THEN {snake} END, "
        f"list_filter({ALIASES}, lambda p: contains(lower({x}), p.a) OR contains(p.a, lower({x})))[1].v, {x}) END"
    )


def _any(x: str, parts) -> str:
    return "(" + " OR ".join(f"contains({x}, '{p}')" for p in parts) + ")"


def _banned(x: str) -> str:
    return "(" + " OR ".join(f"starts_with(lower({_strip(x)}), '{b}')" for b in K.BANNED_OPENERS) + ")"


def _id(kind: str, name: str, signature: str = "''") -> str:
    k, n = _strip(f"lower(coalesce({kind}, 'unknown'))"), _strip(f"lower(coalesce({name}, ''))")
    return f"substr(replace(upper({k}), ' ', '-'), 1, 8) || '-' || substr(sha256({k} || '::' || {n} || '::' || {signature}), 1, 12)"


EDGE = lambda target, k: f"{{'type': {_pick((*K.RELATIONSHIP_TYPES, 'relates_to'), k)}, 'target': 'E' || ({target})}}"
ENT = f"""lab AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
ent AS (SELECT d.doc_id, d.doc_id AS ord, 'E' || d.doc_id AS entity_id, {_pick(RAW_TYPES, "d.doc_id")} AS raw_type, substr(text, 1, 40) AS name,
  substr(text, 1, 400) AS description, [lang, source] AS domain,
  CASE d.doc_id % 3 WHEN 0 THEN [] WHEN 1 THEN [{EDGE("d.doc_id + 1", "d.doc_id")}] ELSE [{EDGE("d.doc_id + 1", "d.doc_id")}, {EDGE("d.doc_id", "d.doc_id + 4")}] END AS rels,
  CASE quality WHEN 1 THEN 1.0 WHEN 0 THEN 0.5 END::DOUBLE AS c_class, CASE quality WHEN 0 THEN 0.7 END::DOUBLE AS c_desc,
  CASE d.doc_id % 5 WHEN 1 THEN 'duplicate' WHEN 2 THEN NULL WHEN 4 THEN 'draft' ELSE 'canonical' END AS status
  FROM documents d LEFT JOIN lab USING (doc_id)),
e AS (SELECT *, {_type("raw_type")} AS entity_type FROM ent)"""


def _chunks(source: str, c: ChunkSettings, key: str = "doc_id", pages: str = "") -> str:
    """source: a table expression with key and t, the clean text."""
    size, step, window = c.size, c.size - c.overlap, c.window
    cuts = ", ".join(rf"nullif(length(regexp_extract(region, '(?s)^.*(?:{p})')), 0)" for p in (r"\n\n", r"\n", rf"[.!?]{S}", S))
    page = (lambda x: f"(SELECT arg_max(page_num, o) FROM spans WHERE spans.{key} = z.{key} AND o <= {x})") if pages else (lambda x: "0")
    return f"""{pages}
src AS (SELECT {key}, t, length(t) AS n FROM {source} WHERE t <> ''),
k AS (SELECT {key}, t, n, unnest(range(0, ((n + {step} - 1) // {step})::BIGINT)) AS k FROM src),
raw AS (SELECT *, k * {step} AS start, substr(t, (k * {step} + 1)::BIGINT, {size}) AS raw, k * {step} + {size} >= n AS whole FROM k),
reg AS (SELECT *, substr(raw, {size - window + 1}, {window}) AS region FROM raw),
cut AS (SELECT *, CASE WHEN whole THEN length(raw) ELSE {size - window} + coalesce({cuts}, length(region)) END AS kept FROM reg),
txt AS (SELECT *, {_strip("substr(raw, 1, kept)")} AS x, start + kept AS fin FROM cut),
blank AS (SELECT {key}, min(k) AS b FROM txt WHERE x = '' GROUP BY {key}),
runt0 AS (SELECT {key}, min(k) AS g FROM txt WHERE k > 0 AND fin >= n AND x <> '' AND length(x) < {c.least} GROUP BY {key}),
runt AS (SELECT {key}, g FROM runt0 LEFT JOIN blank USING ({key}) WHERE b IS NULL OR g < b),
z AS (SELECT txt.*, g, r.x AS rx, r.fin AS rfin FROM txt LEFT JOIN blank USING ({key}) LEFT JOIN runt USING ({key})
  LEFT JOIN (SELECT {key}, k, x, fin FROM txt) r ON r.{key} = txt.{key} AND r.k = txt.k + 1 AND r.k = g
  WHERE (b IS NULL OR txt.k < b) AND (g IS NULL OR txt.k < g)),
ch AS (SELECT {key}, k::INTEGER AS chunk_index, printf('chunk-%04d-', k) || substr(sha256({key}::VARCHAR || '|' || k || '|' || substr(x, 1, 256)), 1, 12) AS chunk_id,
  CASE WHEN rx IS NULL THEN x ELSE x || chr(10) || rx END AS chunk_text, start::INTEGER AS start, coalesce(rfin, fin)::INTEGER AS "end", n,
  {page("z.start")}::INTEGER AS page_start, {page("least(coalesce(z.rfin, z.fin) - 1, z.n - 1)")}::INTEGER AS page_end FROM z),
chunk AS (SELECT {key}, chunk_index, chunk_id, chunk_text, start, "end", page_start, page_end, length(chunk_text)::INTEGER AS char_count, length(chunk_text) > {int(size * K.OVERSIZE)} AS oversized,
  CASE WHEN "end" < n THEN greatest(0, start + {step} - "end") ELSE 0 END::INTEGER AS gap_chars FROM ch)"""


def _doc_chunks(c: ChunkSettings) -> str:
    return f"WITH cl AS (SELECT doc_id, {_clean('text')} AS t FROM documents), {_chunks('cl', c)} SELECT * FROM chunk"


PAGES = """p0 AS (SELECT conv_id, turn, {clean} AS t FROM conversations), p AS (SELECT * FROM p0 WHERE t <> ''),
po AS (SELECT conv_id, turn AS page_num, t, coalesce(sum(length(t) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM p),
spans AS (SELECT conv_id, page_num, o FROM po), cl AS (SELECT conv_id, string_agg(t, chr(10) || chr(10) ORDER BY page_num) AS t FROM po GROUP BY conv_id),"""

_DESC, _LOW = "coalesce(description, '')", "lower(coalesce(description, ''))"
_SENT = _count(_DESC, K.SENTENCE)
_JOIN = "array_to_string(list_filter({0}, lambda x: x IS NOT NULL), ';')"
ERR1 = f"""[CASE WHEN NOT list_contains({TYPES}, entity_type) THEN 'entity_type:' || entity_type END, CASE WHEN {_strip("name")} = '' THEN 'name' END,
  CASE WHEN length({_DESC}) < 80 THEN 'description_length:' || length({_DESC}) WHEN {_SENT} < 2 THEN 'description_sentences:' || {_SENT} END,
  CASE WHEN {_banned(_DESC)} THEN 'description_opener' END]"""
WARN1 = f"[CASE WHEN entity_type = 'metric' AND {_DESC} <> '' AND NOT regexp_matches({_DESC}, '\\p{{Nd}}') AND NOT {_any(_LOW, K.METRIC_KEYWORDS)} THEN 'metric_evidence' END]"
_RTYPES = _list(K.RELATIONSHIP_TYPES)
ERR2 = f"""CASE WHEN len(rels) = 0 THEN ['relationships'] ELSE flatten(list_transform(rels, lambda r, i: [
  CASE WHEN NOT list_contains({_RTYPES}, r.type) THEN 'relationship[' || (i - 1) || '].type:' || r.type END, CASE WHEN r.target = entity_id THEN 'relationship[' || (i - 1) || '].self' END])) END"""
WARN2 = "[CASE WHEN c_class IS NULL THEN 'confidence_scores.classification' END, CASE WHEN c_desc IS NULL THEN 'confidence_scores.description' END, 'confidence_scores.relationships']"
FIX1, FIX2 = "[CASE WHEN raw_type <> entity_type THEN 'entity_type' END]", "[CASE WHEN c_class = 1.0 AND (c_desc IS NULL OR c_desc = 1.0) THEN 'confidence_scores' END]"


def _no_nulls(x: str) -> str:
    return f"list_filter({x}, lambda x: x IS NOT NULL)"


def _validate(step: int) -> str:
    errors, warnings, fixes = _no_nulls(ERR1), _no_nulls(WARN1), _no_nulls(FIX1)
    if step >= 2:
        errors, warnings, fixes = f"list_concat({errors}, {_no_nulls(ERR2)})", f"list_concat({warnings}, {_no_nulls(WARN2)})", f"list_concat({fixes}, {_no_nulls(FIX2)})"
    head = f"WITH {ENT}, v AS (SELECT *, {errors} AS er, {warnings} AS wa, {fixes} AS fi FROM e)"
    if step < 3:
        return f"{head} SELECT doc_id, entity_type, status, len(er) = 0 AS passed, array_to_string(er, ';') AS errors, array_to_string(wa, ';') AS warnings, array_to_string(fi, ';') AS auto_fixes FROM v"
    known = "coalesce(status IN ('canonical', 'duplicate'), false)"
    return f"""{head},
w AS (SELECT * REPLACE (CASE WHEN NOT {known} AND len(er) > 0 THEN list_append(er, 'status:' || coalesce(status, '')) ELSE er END AS er,
  CASE WHEN NOT {known} AND len(er) = 0 THEN list_append(fi, 'status') ELSE fi END AS fi, CASE WHEN NOT {known} AND len(er) = 0 THEN 'canonical' ELSE status END AS status) FROM v),
h AS (SELECT lower({_strip("name")}) AS low, arg_min(entity_id, ord) AS holder FROM ent WHERE {_strip("name")} <> '' GROUP BY 1),
x AS (SELECT w.*, holder, list_concat(wa, {_no_nulls(f"[CASE WHEN status = 'canonical' AND len(rels) < 2 THEN 'few_relationships:' || len(rels) END, CASE WHEN length({_DESC}) < 120 THEN 'description_length:' || length({_DESC}) END, CASE WHEN holder <> entity_id THEN 'name_of:' || holder END]")}) AS wb
  FROM w LEFT JOIN h ON h.low = lower({_strip("name")}))
SELECT doc_id, entity_type, status, len(er) = 0 AS passed, array_to_string(er, ';') AS errors, array_to_string(wb, ';') AS warnings, array_to_string(fi, ';') AS auto_fixes FROM x"""


SCORED = f"""{ENT}, sc AS (SELECT *, least(1.0::DOUBLE, least(1.0::DOUBLE, {_SENT}::DOUBLE / 3) * 0.4::DOUBLE + least(1.0::DOUBLE, length({_DESC})::DOUBLE / 200) * 0.3::DOUBLE + CASE WHEN {_banned(_DESC)} THEN 0.0 ELSE 0.3 END::DOUBLE) AS description_depth,
  least(1.0::DOUBLE, len(rels)::DOUBLE / 3) AS relationship_quality, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(c_class, 0.5::DOUBLE))) AS type_confidence, 0.8::DOUBLE AS uniqueness FROM e),
st AS (SELECT *, description_depth * 0.35::DOUBLE + relationship_quality * 0.25::DOUBLE + type_confidence * 0.25::DOUBLE + uniqueness * 0.15::DOUBLE AS total FROM sc),
scored AS (SELECT *, CASE WHEN total >= 0.6::DOUBLE THEN 'accept' WHEN total >= 0.4::DOUBLE THEN 'warn' ELSE 'reject' END AS verdict FROM st)"""

_TOK = lambda x: f"list_distinct(regexp_extract_all(lower({x}), '{K.TOKEN}'))"
CAND = f"""{ENT}, t AS (SELECT entity_id, ord, rels, {{domain}} AS domain, {_TOK("name || ' ' || description")} AS t FROM ent),
tk AS (SELECT entity_id, domain, len(t) AS n, unnest(t) AS token FROM t),
com AS (SELECT a.entity_id AS eid, b.entity_id AS cid, a.n AS na, b.n AS nb, count(*) AS c, bool_or(len(list_intersect(a.domain, b.domain)) > 0) AS near
  FROM tk a JOIN tk b ON a.token = b.token AND a.entity_id <> b.entity_id WHERE a.entity_id IN (SELECT entity_id FROM t WHERE len(rels) = 0) GROUP BY 1, 2, 3, 4),
cand AS (SELECT eid, cid, c / (na + nb - c) AS sim, near FROM com WHERE c / (na + nb - c) > 0.05::DOUBLE)"""
_DOM = "list_transform(domain, lambda x: lower(x))"
EDGE_TYPE = """CASE WHEN {t} = 'metric' AND {s} IN ('product', 'product_theory', 'architecture') THEN 'constrains' WHEN {s} = 'metric' AND {t} IN ('product', 'product_theory', 'architecture') THEN 'constrains'
  WHEN {t} = 'architecture' AND {s} = 'implementation_ops' THEN 'implements' WHEN {s} = 'architecture' AND {t} = 'implementation_ops' THEN 'implements' WHEN {s} = {t} THEN 'refines' ELSE 'depends_on' END"""
BEST = f"""{CAND.replace('{domain}', _DOM)}, best AS (SELECT eid, cid, row_number() OVER (PARTITION BY eid ORDER BY sim DESC, ord) AS rank FROM cand JOIN ent ON ent.entity_id = cid WHERE near QUALIFY rank <= 2)"""
PAIRS = """tk AS (SELECT {key}, len(t) AS n, unnest(t) AS token FROM tok),
pr AS (SELECT a.{key} AS a, b.{key} AS b, a.n AS na, b.n AS nb, count(*) AS c FROM tk a JOIN tk b ON a.token = b.token AND a.{key} < b.{key} GROUP BY ALL),
pairs AS (SELECT a, b, c / (na + nb - c) AS sim FROM pr WHERE c / (na + nb - c) >= 0.5::DOUBLE)"""

STORE = f"""{ENT}, s0 AS (SELECT * REPLACE ('S' || doc_id // 4 AS entity_id, {_pick(RAW_TYPES, "doc_id // 4")} AS raw_type,
  CASE WHEN doc_id % 7 = 6 THEN name ELSE 'Concept ' || doc_id // 4 END AS name, CASE WHEN doc_id % 6 = 5 THEN 'duplicate' ELSE 'canonical' END AS status) FROM ent),
s1 AS (SELECT * , {_type("raw_type")} AS entity_type FROM s0)"""
JUDGED = SCORED.replace(ENT, STORE).replace("FROM e)", "FROM s1)") + f""",
jd AS (SELECT *, domain[1] || '::' || entity_type || '::' || entity_id AS rkey, CASE WHEN status <> 'canonical' THEN 'skipped' WHEN NOT list_contains({TYPES}, entity_type) OR verdict = 'reject' THEN 'invalid' END AS refused FROM scored)"""
FOLD = JUDGED.replace("lab AS", "RECURSIVE lab AS", 1) + """,
ar AS (SELECT *, row_number() OVER (PARTITION BY rkey ORDER BY {order}) AS i FROM jd WHERE refused IS NULL),
f AS (SELECT rkey, i, doc_id, 'saved' AS outcome, NULL::VARCHAR AS message, name, description, status, domain, rels, c_desc FROM ar WHERE i = 1
  UNION ALL SELECT ar.rkey, ar.i, ar.doc_id, CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN 'conflicts' ELSE 'merged' END,
  CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN 'name:' || f.name || '|' || ar.name END, CASE WHEN ar.name = '' OR f.name = '' OR f.name = ar.name THEN ar.name ELSE f.name END,
  CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN f.description WHEN coalesce(ar.c_desc, 0) >= coalesce(f.c_desc, 0) THEN ar.description ELSE f.description END,
  CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN f.status ELSE ar.status END,
  CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN f.domain ELSE list_concat(f.domain, list_filter(ar.domain, lambda d: NOT list_contains(f.domain, d))) END,
  CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN f.rels ELSE list_concat(f.rels, list_filter(ar.rels, lambda r: NOT list_contains(f.rels, r))) END,
  CASE WHEN f.name <> ar.name AND f.name <> '' AND ar.name <> '' THEN f.c_desc WHEN coalesce(ar.c_desc, 0) >= coalesce(f.c_desc, 0) THEN coalesce(ar.c_desc, 0) ELSE f.c_desc END
  FROM f JOIN ar ON ar.rkey = f.rkey AND ar.i = f.i + 1)"""
WAVES = FOLD.replace("{order}", "doc_id % 2, doc_id")


def _spec() -> str:
    kind, slug = _pick(spec.TYPES, "doc_id"), r"lower(substr(text, 1, 40))"
    for pattern, new in (("[™®©]", ""), (r"[ \-/&]", "_"), ("[^a-z0-9_]", ""), ("_+", "_"), (r"^_+|_+\z", "")):
        slug = f"regexp_replace({slug}, '{pattern}', '{new}', 'g')"
    checks = [
        ("entity_id", r"NOT regexp_matches(eid, '^kb:[a-z_]+:[a-z0-9_]+\z')"), ("name", "length(substr(text, 1, 40)) < 2"), ("description", "length(substr(text, 1, 400)) < 50"),
        ("owner", "kind <> 'product' AND doc_id % 3 = 0"), ("kb_tier", "kind = 'product'"),
    ]
    for t, names in spec.REQUIRED_TEXTS.items():
        checks += [(f"{t}.{n}", f"kind = '{t}'") for n in names if n != "status"]
    for t, sizes in spec.REQUIRED_LISTS.items():
        checks += [(f"{t}.{n}", f"kind = '{t}'") for n in sizes if n != "steps"]
    checks.append(("decision.alternatives", "kind = 'decision'"))
    codes = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in checks)
    return f"""WITH d AS (SELECT *, {kind} AS kind, 'kb:' || {kind} || ':' || substr({slug}, 1, 60) AS eid FROM documents)
SELECT doc_id, eid AS entity_id, array_to_string(list_filter([{codes}], lambda x: x IS NOT NULL), ';') AS errors FROM d"""


def oracle_sql() -> dict[str, str]:
    reclass_low, both = "lower(description)", "lower(description) || ' ' || lower(name)"
    keyword, digit = _any(both, K.METRIC_KEYWORDS), r"regexp_matches(lower(description), '\p{Nd}')"
    rule_name, rule_desc = "substr(chunk_text, 1, 60)", "substr(chunk_text, 1, 400)"
    rl, rb = f"lower({rule_desc})", f"lower({rule_desc}) || ' ' || lower({rule_name})"

    def reclass(low, text, digits):
        return f"""CASE WHEN {_any(text, K.METRIC_KEYWORDS)} AND {digits} THEN 'metric' WHEN {_any(low, K.NON_METRIC_SIGNALS)} THEN CASE WHEN {_any(low, ("feature", "captures", "detects"))} THEN 'product_theory'
  WHEN {_any(low, ("designed to", "system", "device", "component"))} THEN 'architecture' WHEN {_any(low, ("step", "procedure", "implements"))} THEN 'implementation_ops' ELSE 'product_theory' END
  WHEN NOT {digits} AND NOT {_any(text, K.METRIC_KEYWORDS)} THEN 'product_theory' ELSE 'metric' END"""

    usable = f"NOT regexp_matches(chunk_text, '^{S}*https?://[^{S[1:-1]}]+{S}*\\z') AND length({_strip('chunk_text')}) >= 200"
    page_lines = "CASE page_id % 4 WHEN 0 THEN '  ' || url || ' ' || chr(10) WHEN 1 THEN 'notes' || chr(10) || url || chr(10) || chr(10) || 'more' WHEN 2 THEN 'a' || chr(10) || 'b' || chr(10) || 'c' || chr(10) || url ELSE 'see ' || url END"
    attempts = "floor(coalesce(value, 0))::BIGINT % 5"
    return {
        "q01_clean_text": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
        "q02_chunks": _doc_chunks(ChunkSettings()),
        "q03_chunks_short": _doc_chunks(SHORT),
        "q04_chunks_small": _doc_chunks(ChunkSettings(300, 200, 120, 50)),
        "q05_chunk_pages": f"WITH {_chunks('cl', ChunkSettings(300, 60, 40, 50), 'conv_id', PAGES.format(clean=_clean('text')))} SELECT conv_id, chunk_index, chunk_id, start, \"end\", page_start, page_end, char_count FROM chunk",
        "q06_chunk_guard": f"WITH cl AS (SELECT doc_id, {_clean('text')} AS t FROM documents), {_chunks('cl', SHORT)} SELECT lang, {usable} AS usable, count(*) AS n, sum(char_count)::BIGINT AS chars FROM chunk JOIN documents USING (doc_id) GROUP BY 1, 2",
        "q07_url_lines": rf"WITH x AS (SELECT page_id, list_filter(list_transform(string_split({page_lines}, chr(10)), lambda l: trim(l)), lambda l: l <> '') AS l FROM pages) SELECT page_id, CASE WHEN len(l) <= 3 THEN list_filter(l, lambda u: regexp_matches(u, '(?i)^https?://\S+$'))[1] END AS found FROM x",
        "q10_entity_id": f"SELECT p_partkey, {_id('p_type', 'p_name', chr(39) + 'brand=' + chr(39) + ' || p_brand || ' + chr(39) + '|size=' + chr(39) + ' || p_size')} AS entity_id FROM part",
        "q11_type_alias": f"WITH {ENT} SELECT doc_id, entity_type, {_id('raw_type', 'name')} AS entity_id FROM e",
        "q12_type_reclass": f"WITH {ENT} SELECT doc_id, {reclass(reclass_low, both, digit)} AS entity_type FROM ent",
        "q13_confidence_clamp": f"WITH {ENT} SELECT doc_id, CASE WHEN c_class = 1.0 AND c_desc IS NULL THEN 0.85::DOUBLE ELSE c_class END AS classification, c_desc AS description FROM ent",
        "q14_name_fix": "SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN source ELSE '' END AS name FROM documents",
        "q15_validate_1": _validate(1),
        "q16_validate_2": _validate(2),
        "q17_validate_3": _validate(3),
        "q18_score": f"WITH {SCORED} SELECT doc_id, description_depth, relationship_quality, type_confidence, uniqueness, total, verdict FROM scored",
        "q19_verdict_counts": f"WITH {SCORED} SELECT verdict, count(*) AS n FROM scored GROUP BY 1",
        "q20_canonical_gate": f"WITH {ENT} SELECT coalesce(status, '') = 'canonical' AS kept, count(*) AS n FROM ent GROUP BY 1",
        "q21_tokens": f"SELECT doc_id, array_to_string(list_sort({_TOK('text')}), ' ') AS tokens FROM documents",
        "q22_jaccard_pairs": f"WITH tok AS (SELECT doc_id, {_TOK('text')} AS t FROM documents), {PAIRS.format(key='doc_id')} SELECT * FROM pairs",
        "q23_clusters": f"WITH RECURSIVE {ENT}, tok AS (SELECT doc_id, {_TOK(chr(39).join(['name || ', ' ', ' || description']))} AS t FROM ent), {PAIRS.format(key='doc_id')}, l AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), w AS (SELECT a AS doc_id, b AS r FROM l UNION SELECT w.doc_id, l.b FROM w JOIN l ON w.r = l.a) SELECT ent.doc_id, least(ent.doc_id, coalesce(min(r), ent.doc_id)) AS cluster_id FROM ent LEFT JOIN w USING (doc_id) GROUP BY ent.doc_id",
        "q24_domain_candidates": f"WITH {CAND.replace('{domain}', _DOM)} SELECT eid, cid, sim FROM cand WHERE near",
        "q25_fallback_candidates": f"WITH {CAND.replace('{domain}', '[lower(entity_id)]')} SELECT eid, cid, sim FROM cand",
        "q26_top2": f"WITH {BEST} SELECT eid, cid, rank::INTEGER AS rank FROM best",
        "q27_enrich": f"""WITH {BEST.replace("WHERE near QUALIFY", "WHERE near OR eid NOT IN (SELECT eid FROM cand WHERE near) QUALIFY")}, new AS (SELECT eid, string_agg({EDGE_TYPE.format(s='a.raw_type', t='b.raw_type')} || ':' || cid, ';' ORDER BY rank) AS x FROM best JOIN ent a ON a.entity_id = eid JOIN ent b ON b.entity_id = cid GROUP BY eid)
SELECT doc_id, CASE WHEN len(rels) > 0 THEN array_to_string(list_transform(rels, lambda r: r.type || ':' || r.target), ';') ELSE coalesce(x, '') END AS edges, CASE WHEN len(rels) = 0 AND x IS NOT NULL THEN 0.5::DOUBLE END AS confidence FROM ent LEFT JOIN new ON eid = entity_id""",
        "q28_edge_type": f"WITH {ENT}, x AS (SELECT doc_id, entity_type AS s, {_pick(('metric', 'architecture', 'implementation_ops', 'product'), 'doc_id')} AS t FROM e) SELECT doc_id, {EDGE_TYPE.format(s='s', t='t')} AS type FROM x",
        "q30_size_batches": "WITH RECURSIVE r AS (SELECT source, doc_id, n_chars AS z, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents), f AS (SELECT source, doc_id, i, z AS used, 0 AS batch_id FROM r WHERE i = 1 UNION ALL SELECT r.source, r.doc_id, r.i, CASE WHEN used + z > 12000 THEN z ELSE used + z END, CASE WHEN used + z > 12000 THEN batch_id + 1 ELSE batch_id END FROM f JOIN r ON r.source = f.source AND r.i = f.i + 1) SELECT source, doc_id, batch_id FROM f",
        "q31_fixed_batches": "SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20)::INTEGER AS batch_id FROM documents",
        "q32_message_content": "SELECT event_id, CASE WHEN trim(event_type) <> '' THEN event_type END AS content FROM events",
        "q33_unwrap": "SELECT event_id, unnest([0, 1]) AS place, replace(props, ' ', '') AS entity FROM events",
        "q35_best_attempt": f"WITH a AS (SELECT user_id, event_id, {attempts} AS p FROM events WHERE user_id IS NOT NULL) SELECT user_id, first(event_id ORDER BY p DESC, event_id) AS event_id FROM a GROUP BY user_id",
        "q40_registry_key": f"WITH {ENT} SELECT doc_id, domain[1] || '::' || entity_type || '::' || entity_id AS rkey FROM e",
        "q41_upsert_outcome": f"WITH {WAVES} SELECT doc_id, outcome FROM f UNION ALL SELECT doc_id, refused FROM jd WHERE refused IS NOT NULL",
        "q42_merged_fields": f"WITH {WAVES} SELECT rkey, arg_max(name, i) AS name, arg_max(description, i) AS description, arg_max(status, i) AS status, array_to_string(arg_max(domain, i), ',') AS domain, len(arg_max(rels, i))::INTEGER AS n_edges, last(c_desc ORDER BY i) AS c_description FROM f GROUP BY rkey",
        "q43_conflicts": f"WITH {WAVES} SELECT doc_id, rkey, message FROM f WHERE outcome = 'conflicts'",
        "q44_numbering": f"WITH {JUDGED}, k AS (SELECT rkey, min(doc_id) AS o, any_value(entity_id) AS eid FROM jd WHERE refused IS NULL GROUP BY rkey) SELECT rkey, printf('%03d', row_number() OVER (ORDER BY o)) || '_' || eid || '.json' AS file_name FROM k",
        "q45_list_union": "SELECT doc_id, array_to_string(list_concat([lang, source], list_filter(['en', 'x'], lambda v: v <> lang AND v <> source)), ',') AS domain FROM documents",
        "q46_dangling_edges": f"WITH {ENT}, g AS (SELECT entity_id, unnest(rels).target AS target FROM ent) SELECT entity_id, target FROM g WHERE target NOT IN (SELECT entity_id FROM ent)",
        "q47_storage_errors": f"WITH {ENT} SELECT doc_id, {_JOIN.format(f'''[CASE WHEN status IS NULL THEN 'missing:status' END, CASE WHEN NOT list_contains({TYPES}, raw_type) THEN 'entity_type:' || raw_type END]''')} AS errors, {_banned('description')} AS banned FROM ent",
        "q50_pipeline_rule": f"WITH cl AS (SELECT doc_id, {_clean('text')} AS t FROM documents), {_chunks('cl', SHORT)}, x AS (SELECT *, CASE WHEN regexp_matches(chunk_text, '\\p{{Nd}}') THEN 'metric' ELSE 'product_theory' END AS k FROM chunk WHERE {usable}), y AS (SELECT {_id('k', rule_name)} AS eid, CASE WHEN k = 'metric' THEN {reclass(rl, rb, f'regexp_matches({rl}, {chr(39)}\\p{{Nd}}{chr(39)})')} ELSE k END AS entity_type FROM x) SELECT entity_type, count(*) AS n, count(DISTINCT eid) AS n_ids FROM y GROUP BY 1",
        "q60_spec_errors": _spec(),
    }
