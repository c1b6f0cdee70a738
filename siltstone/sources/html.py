"""HTML to text, and pages by HTTP."""

from __future__ import annotations

import re
import time
import urllib.error
import urllib.request
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K

#: Elements without an end tag: they neither open a skipped region nor leave one open.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Reader(HTMLParser):
    """Text outside of skipped elements. faithful: void skipped elements are never left again, and br breaks no line."""

    def __init__(self, faithful: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.faithful, self.depth, self.out = faithful, 0, []

    def _break(self, tag):
        if tag in K.BLOCK_TAGS and not self.depth:
            self.out.append("\n")

    def handle_starttag(self, tag, attrs):
        void = tag in VOID and not self.faithful
        if void:
            self._break(tag)
        elif tag in K.SKIP_TAGS:
            self.depth += 1

    def handle_startendtag(self, tag, attrs):
        if self.faithful:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)
        else:
            self._break(tag)

    def handle_endtag(self, tag):
        if tag in VOID and not self.faithful:
            return
        if tag in K.SKIP_TAGS:
            self.depth = max(0, self.depth - 1)
        self._break(tag)

    def handle_data(self, data):
        if not self.depth and (text := data.strip()):
            self.out.append(text + " ")


def to_text(html: str | None, faithful: bool = False) -> str | None:
    if html is None:
        return None
    reader = Reader(faithful)
    reader.feed(html)
    return re.sub(r"\n{3,}", "\n\n", re.sub(" {2,}", " ", "".join(reader.out))).strip()


@F.pandas_udf(T.StringType())
def html_text(pages: pd.Series) -> pd.Series:
    return pd.Series([to_text(p) for p in pages], dtype=object)


@F.pandas_udf(T.StringType())
def html_text_faithful(pages: pd.Series) -> pd.Series:
    return pd.Series([to_text(p, True) for p in pages], dtype=object)


def fetch(url: str, timeout: float = 30, tries: int = 3, open_url=urllib.request.urlopen) -> str:
    """The page at url; undecodable bytes are replaced, an unknown charset is taken as UTF-8."""
    request = urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0", "Accept": "text/html,*/*;q=0.8", "Accept-Language": "en"})
    for attempt in range(tries):
        try:
            with open_url(request, timeout=timeout) as answer:
                raw, charset = answer.read(), answer.headers.get_content_charset() or "utf-8"
            try:
                return raw.decode(charset, "replace")
            except LookupError:
                return raw.decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            if 400 <= e.code < 500 or attempt + 1 == tries:
                raise RuntimeError(f"{url}: {e}") from e
        except OSError as e:
            if attempt + 1 == tries:
                raise RuntimeError(f"{url}: {e}") from e
        time.sleep(2**attempt)
    raise RuntimeError(url)


def fetch_pages(urls: DataFrame, column: str = "url", get=fetch) -> DataFrame:
    """urls with html and error, by HTTP from the executors; a failed page is a row with an error."""

    def run(batches):
        for b in batches:
            pages, errors = [], []
            for url in b[column]:
                try:
                    pages.append(get(url))
                    errors.append(None)
                except RuntimeError as e:
                    pages.append(None)
                    errors.append(str(e))
            yield b.assign(html=pages, error=errors)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    return urls.mapInPandas(run, f"{schema}, html string, error string")
