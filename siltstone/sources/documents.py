"""Files to pages: text, HTML links, PDF, DOCX and PPTX, by suffix.

Files are read as bytes by Spark, so any store that Spark reads will do. PDF needs PyMuPDF on the executors; DOCX and PPTX are read
with the standard library. A file that can't be read is a row with an error, and so is an unknown suffix.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import clean_page, only_url, strip
from .html import fetch_pages, html_text

OFFICE = (".pdf", ".docx", ".pptx")
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, suffix, modified, content) of all files under path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)\z", 1))
    return files.select("path", suffix.alias("suffix"), F.col("modificationTime").alias("modified"), "content")


def decoded(content: Column) -> Column:
    """UTF-8, or Latin-1 where that fails. A byte order mark stays."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def docx_pages(raw: bytes) -> list[tuple[int, str]]:
    """One page: paragraphs with text, then rows of tables."""
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml")).find(f"{W}body")

    def text(node):
        return "".join(t.text or "" for t in node.iter(f"{W}t"))

    parts = [t for p in body.findall(f"{W}p") if (t := text(p)).strip()]
    for row in body.iter(f"{W}tr"):
        cells = [c for cell in row.findall(f"{W}tc") if (c := text(cell).strip())]
        if cells:
            parts.append("  |  ".join(cells))
    return [(0, "\n\n".join(parts))]


def pptx_pages(raw: bytes) -> list[tuple[int, str]]:
    """One page: each slide's texts under its number."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    names = sorted((int(m.group(1)), n) for n in z.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
    slides = []
    for number, name in names:
        lines = [t for p in ET.fromstring(z.read(name)).iter(f"{A}p") if (t := "".join(x.text or "" for x in p.iter(f"{A}t")).strip())]
        if lines:
            slides.append("\n".join([f"[Slide {number}]", *lines]))
    return [(0, "\n\n".join(slides))]


def pdf_pages(raw: bytes) -> list[tuple[int, str]]:
    import fitz  # PyMuPDF, where it is installed

    with fitz.open(stream=raw, filetype="pdf") as pdf:
        return [(i, page.get_text()) for i, page in enumerate(pdf)]


def office_pages(files: DataFrame) -> DataFrame:
    """(doc_id, page_num, text, error) of PDF, DOCX and PPTX files."""
    readers = {".pdf": pdf_pages, ".docx": docx_pages, ".pptx": pptx_pages}

    def run(batches):
        for b in batches:
            rows = []
            for path, suffix, content in zip(b["path"], b["suffix"], b["content"], strict=True):
                try:
                    rows += [(path, n, text, None) for n, text in readers[suffix](content)]
                except Exception as e:  # one bad file is one row
                    rows.append((path, 0, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "text", "error"])

    return files.select("path", "suffix", "content").mapInPandas(run, "doc_id string, page_num int, text string, error string")


def read_pages(files: DataFrame) -> DataFrame:
    """(doc_id, page_num, text, error): cleaned pages of all files, routed by suffix; empty pages are left out."""
    plain = files.where(F.col("suffix").isin(*K.TEXT_SUFFIXES))
    plain = plain.select(F.col("path").alias("doc_id"), F.lit(0).alias("page_num"), decoded(F.col("content")).alias("text"), F.lit(None).cast("string").alias("error"))
    office = office_pages(files.where(F.col("suffix").isin(*OFFICE)))
    unknown = files.where(~F.col("suffix").isin(*K.TEXT_SUFFIXES, *OFFICE))
    unknown = unknown.select(F.col("path").alias("doc_id"), F.lit(0).alias("page_num"), F.lit(None).cast("string").alias("text"), F.concat(F.lit("unknown suffix "), "suffix").alias("error"))
    pages = plain.unionByName(office).unionByName(unknown).withColumn("text", clean_page(F.col("text")))
    return pages.where((F.col("text") != "") | F.col("error").isNotNull())


def resolve_links(texts: DataFrame, cached: DataFrame | None = None, get=None) -> DataFrame:
    """texts (path, modified, text) whose text is a link get the linked page's text, in text; resolved tells where from.

    cached: (path, modified, text) of pages fetched before, used where they are newer. A page that fails or has fewer than
    FETCHED_CHARS characters leaves the text as it is.
    """
    texts = texts.withColumn("url", only_url(F.regexp_replace("text", "^﻿", "")))
    if cached is not None:
        c = cached.select("path", F.col("modified").alias("c_modified"), F.col("text").alias("c_text"))
        texts = texts.join(c, "path", "left").withColumn("c_text", F.when((F.col("c_modified") > F.col("modified")) & F.col("url").isNotNull(), F.col("c_text"))).drop("c_modified")
    else:
        texts = texts.withColumn("c_text", F.lit(None).cast("string"))
    wanted = texts.where(F.col("url").isNotNull() & F.col("c_text").isNull()).select("url").distinct()
    pages = fetch_pages(wanted, get=get) if get else fetch_pages(wanted)
    pages = pages.select("url", html_text("html").alias("f_text"))
    out = texts.join(pages, "url", "left").withColumn("f_text", F.when(F.length(strip(F.col("f_text"))) >= K.FETCHED_CHARS, F.col("f_text")))
    resolved = F.when(F.col("url").isNull(), "document").when(F.col("c_text").isNotNull(), "cache").when(F.col("f_text").isNotNull(), "fetched").otherwise("link")
    return out.withColumn("resolved", resolved).withColumn("text", F.coalesce("c_text", "f_text", "text")).drop("c_text", "f_text")
