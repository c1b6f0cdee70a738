"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pathlib import Path

from . import compression, decontamination, jaccard, language_model, languages, licenses, packing, pii, rules, toxicity
from .columns import table


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file as the installed package gives it."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def queries() -> dict:
    docs = lambda s, d: table(s, d, "documents")
    return {
        "op1_language_model": lambda s, d: language_model.query(docs(s, d)),
        "op2_quality_rules": lambda s, d: rules.query(docs(s, d)),
        "op3_toxicity": lambda s, d: toxicity.query(docs(s, d), table(s, d, "labels")),
        "op4_language": lambda s, d: languages.query(docs(s, d)),
        "op5_compression_quality": lambda s, d: compression.query(docs(s, d), table(s, d, "labels")),
        "op6_jaccard_join": lambda s, d: jaccard.query(docs(s, d)),
        "op7_license_scan": lambda s, d: licenses.query(docs(s, d)),
        "op8_packing": lambda s, d: packing.query(docs(s, d), tokenizer_json()),
        "op9_pii": lambda s, d: pii.query(docs(s, d)),
        "op10_decontamination": lambda s, d: decontamination.query(docs(s, d), table(s, d, "benchmark")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_jaccard_join": jaccard.SQL, "op10_decontamination": decontamination.SQL}
