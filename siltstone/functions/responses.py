"""Model responses: JSON out of messy text, entity lists out of wrappers.

Balanced spans and HTML-like nesting are not regular, and JSON here may hold NaN and repeated keys, so that the parsers run as Arrow
functions; values travel as JSON text, which VARIANT functions read on.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import constants as K

FENCE = re.compile(r"```json\s*(.*?)\s*```", re.DOTALL)
CLOSER = {"{": "}", "[": "]"}
MARK = re.compile(r'[{}\[\]"]')
STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)


def balanced(text: str) -> str | None:
    """The first span from an opening bracket to where all brackets opened in it are closed; strings are skipped.

    A closing bracket of the wrong kind is passed over; a span that never closes swallows the rest.
    """
    open_: list[str] = []
    start, at = -1, 0
    while (m := MARK.search(text, at)) is not None:
        c, at = m.group(), m.end()
        if c in CLOSER:
            if not open_:
                start = m.start()
            open_.append(CLOSER[c])
        elif open_ and c == '"':
            end = STRING_END.match(text, at)
            if end is None:
                return None
            at = end.end()
        elif open_ and c == open_[-1]:
            open_.pop()
            if not open_:
                return text[start:at]
    return None


def _parse(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return None


def extract(text: str | None):
    """The JSON value of a response: the whole, else its first fenced block, else its first balanced span; None without."""
    if text is None:
        return None
    value = _parse(text.strip())
    if value is None and (m := FENCE.search(text)):
        value = _parse(m.group(1).strip())
    if value is None and (span := balanced(text)) is not None:
        value = _parse(span)
    return value


def entity_list(value) -> list[dict]:
    """The entities in a value: a list's or wrapper's records. Wrappers within a list are opened, one level deep."""

    def wrapped(d):
        return next((d[k] for k in K.WRAPPER_KEYS if isinstance(d.get(k), list)), None)

    def records(items):
        return [x for x in items if isinstance(x, dict)]

    def is_entity(d):
        return any(k in d for k in K.ENTITY_MARKERS)

    if isinstance(value, dict):
        inner = wrapped(value)
        return records(inner) if inner is not None else [value] if is_entity(value) else []
    out = []
    for item in records(value) if isinstance(value, list) else []:
        out += [item] if is_entity(item) else records(wrapped(item) or [])
    return out


def _column(series: pd.Series, function) -> pd.Series:
    return pd.Series([None if t is None else function(t) for t in series], dtype=object)


@F.pandas_udf(T.StringType())
def balanced_json(texts: pd.Series) -> pd.Series:
    return _column(texts, balanced)


@F.pandas_udf(T.StringType())
def extract_json(texts: pd.Series) -> pd.Series:
    """The extracted value as JSON text; null without one."""
    return _column(texts, lambda t: None if (v := extract(t)) is None else json.dumps(v))


@F.pandas_udf(T.ArrayType(T.StringType()))
def entity_json(texts: pd.Series) -> pd.Series:
    """The entities of a response, each as JSON text."""
    return _column(texts, lambda t: [json.dumps(e) for e in entity_list(extract(t))])


def unwrap(value: Column) -> Column:
    """array<variant> of the first wrapper key that holds a list, of a VARIANT object; a JVM path for well-formed JSON."""
    return F.coalesce(*[F.try_variant_get(value, f"$.{k}", "array<variant>") for k in K.WRAPPER_KEYS])


def message_content(body: Column) -> Column:
    """The text of a chat completion's first choice, from the JSON body; null if it is missing or blank."""
    content = F.try_variant_get(F.try_parse_json(body), "$.choices[0].message.content", "string")
    return F.when(F.trim(content) != "", content)
