"""Text columns: stripping, page cleaning, links, tokens, usable chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends (trim() knows only the space)."""
    return F.regexp_replace(F.regexp_replace(text, rf"^{K.SPACE}+", ""), rf"{K.SPACE}+\z", "")


def clean_page(text: Column, numbers: bool = True, spaces: bool = True) -> Column:
    """Without lines that hold only a page number; runs of spaces, tabs and empty lines shortened; stripped."""
    if numbers:
        text = F.regexp_replace(text, "(?imd)" + K.NUMBER_LINE, "")
    if spaces:
        text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return strip(text)


def only_url(text: Column) -> Column:
    """The link of a text that has one line, or at most three, that is a link; else null."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"), strip), lambda x: x != "")
    links = F.filter(lines, lambda x: x.rlike("(?i)" + K.URL_LINE))
    return F.when(F.size(lines) <= 3, F.get(links, F.lit(0)))


def tokens(text: Column) -> Column:
    """Distinct ASCII tokens of lower-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(K.TOKEN), F.lit(0)))


def sentences(text: Column) -> Column:
    return F.regexp_count(text, F.lit(K.SENTENCE))


def chunk_fault(text: Column) -> Column:
    """Why a chunk is not worth a model call: url_only, or too_short:<length>; null for usable ones."""
    length = F.length(strip(text))
    return F.when(text.rlike(rf"^{K.SPACE}*https?://[^{K.SPACE[1:-1]}]+{K.SPACE}*\z"), F.lit("url_only")).when(
        length < K.USABLE_CHARS, F.concat(F.lit("too_short:"), length.cast("string"))
    )
