"""Vocabularies and limits of the knowledge base."""

# The entity model's vocabularies. The order of TYPE_ALIASES counts.
ENTITY_TYPES = (
    "pattern", "ingestion", "analytics", "metric", "architecture", "code", "product_theory", "product", "implementation_ops",
    "comparison_example", "negative_boundary", "expert_heuristic", "failure_case", "evolution_record", "non_goal",
    "data_quality_exception", "field_feedback", "security_interpretation", "acceptance_criteria", "terminology", "implementation",
    "comparison",
)
RELATIONSHIP_TYPES = ("depends_on", "enables", "constrains", "contrasts_with", "causes", "fails_under", "refines", "implements")
BANNED_OPENERS = (
    "a record of", "an implementation of", "a type of", "a metric used to", "a pattern of", "a feature that", "a product theory",
    "a non-goal", "an evolution",
)
TYPE_ALIASES = (
    ("procedure", "implementation_ops"), ("process", "implementation_ops"), ("workflow", "implementation_ops"),
    ("operation", "implementation_ops"), ("steps", "implementation_ops"), ("component", "architecture"),
    ("structure", "architecture"), ("system", "architecture"), ("design", "architecture"), ("feature", "product_theory"),
    ("concept", "product_theory"), ("theory", "product_theory"), ("principle", "product_theory"), ("benchmark", "metric"),
    ("measurement", "metric"), ("kpi", "metric"), ("indicator", "metric"), ("use_case", "acceptance_criteria"),
    ("use case", "acceptance_criteria"), ("requirement", "acceptance_criteria"), ("constraint", "negative_boundary"),
    ("limitation", "negative_boundary"), ("exception", "data_quality_exception"), ("anomaly", "data_quality_exception"),
    ("observation", "field_feedback"), ("feedback", "field_feedback"), ("heuristic", "expert_heuristic"), ("rule", "expert_heuristic"),
    ("definition", "terminology"), ("term", "terminology"), ("glossary", "terminology"), ("security", "security_interpretation"),
    ("threat", "security_interpretation"), ("evolution", "evolution_record"), ("history", "evolution_record"),
    ("anti_pattern", "negative_boundary"), ("anti-pattern", "negative_boundary"), ("regulatory_status", "acceptance_criteria"),
    ("regulatory", "acceptance_criteria"), ("compliance", "acceptance_criteria"), ("certification", "acceptance_criteria"),
    ("approval", "acceptance_criteria"), ("standard", "acceptance_criteria"), ("specification", "architecture"), ("spec", "architecture"),
    ("mode", "product_theory"), ("mechanism", "product_theory"), ("behavior", "product_theory"), ("behaviour", "product_theory"),
    ("characteristic", "product_theory"), ("property", "product_theory"), ("capability", "product_theory"), ("function", "product_theory"),
    ("parameter", "metric"), ("threshold", "metric"), ("guideline", "expert_heuristic"), ("best_practice", "expert_heuristic"),
    ("best practice", "expert_heuristic"), ("risk", "failure_case"), ("issue", "failure_case"), ("defect", "failure_case"),
    ("error", "failure_case"), ("change", "evolution_record"), ("update", "evolution_record"), ("revision", "evolution_record"),
)
METRIC_KEYWORDS = (
    "latency", "throughput", "accuracy", "precision", "recall", "rate", "percentage", "ratio", "count", "duration", "time", "frequency",
    "bandwidth", "capacity", "volume", "score", "milliseconds", "seconds", "ms", "gb", "mb", "mhz", "years", "months", "%", "bpm", "ohms",
    "watts", "impedance",
)
NON_METRIC_SIGNALS = (
    "feature", "designed to", "captures", "enables", "provides", "supports", "manages", "implements", "algorithm", "protocol", "system",
    "device", "component",
)
SKIP_TAGS = ("script", "style", "noscript", "header", "footer", "nav", "aside", "form", "button", "svg", "img", "meta", "link", "head")
BLOCK_TAGS = (
    "p", "div", "section", "article", "main", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "br", "hr", "blockquote", "pre", "code",
)
TEXT_SUFFIXES = (".txt", ".md", ".rst", ".csv", ".log")
WRAPPER_KEYS = ("entities", "results", "data")
ENTITY_MARKERS = ("entity_id", "entity_type", "name")
CONFIDENCE_KEYS = ("classification", "description", "relationships")

# Limits.
CHUNK_SIZE, CHUNK_OVERLAP, CHUNK_LEAST, CHUNK_WINDOW, OVERSIZE = 4000, 400, 200, 200, 1.5
USABLE_CHARS, FETCHED_CHARS = 200, 500
DESCRIPTION_LEAST, DESCRIPTION_GOOD, SENTENCES_LEAST = 80, 120, 2
STEP2_CHARS, STEP3_SIZE, PROMPT_CHARS = 12_000, 20, 32_000
DUPLICATE_JACCARD, CANDIDATE_JACCARD = 0.5, 0.05
TRIES, DELAY_S, VALIDATION_RETRIES = 3, 2.0, 2
ACCEPT, WARN = 0.6, 0.4

#: Unicode white space as str.strip() knows it, for Java's and RE2's regular expressions.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TOKEN = "[a-z][a-z0-9_]+"
NUMBER_LINE = rf"^{SPACE}*(?:page{SPACE}+)?\p{{Nd}}+(?:{SPACE}+of{SPACE}+\p{{Nd}}+)?{SPACE}*$"
SENTENCE = rf"[.!?](?:{SPACE}|\z)"
URL_LINE = rf"^https?://[^{SPACE[1:-1]}]+\z"
