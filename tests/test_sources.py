import io
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from siltstone.sources import documents as D
from siltstone.sources.html import fetch, fetch_pages, to_text


def docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    body = f"<w:document {w}><w:body>{p('One')}{p(' ')}{p('Two')}<w:tbl><w:tr><w:tc>{p('a')}</w:tc><w:tc>{p('b')}</w:tc></w:tr></w:tbl></w:body></w:document>"
    return zipped({"word/document.xml": body})


def pptx():
    a = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
    slide = lambda t: f"<s {a}><a:p><a:r><a:t>{t}</a:t></a:r></a:p></s>"
    return zipped({"ppt/slides/slide2.xml": slide("second"), "ppt/slides/slide1.xml": slide("first")})


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def test_html():
    assert to_text("<head><meta charset=x><title>t</title></head><body><nav>n</nav><p>a<br>b</p><img src=x><div>c &amp; d</div><script>var x = '<p>';</script>e</body>") == "a \nb \nc & d \ne"
    assert to_text("<meta charset=x>text", faithful=True) == "" and to_text("<p>a<br>b</p>", faithful=True) == "a b" and to_text(None) is None
    assert to_text("<header><nav>x</nav>y</header>z") == "z"


def test_files_by_suffix(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Page 1\nhello", encoding="utf-8")
    (tmp_path / "b.MD").write_bytes("caf\xe9".encode("latin-1"))
    (tmp_path / "c.docx").write_bytes(docx())
    (tmp_path / "d.pptx").write_bytes(pptx())
    (tmp_path / "e.docx").write_bytes(b"broken")
    (tmp_path / "f.zzz").write_bytes(b"?")
    rows = {r["doc_id"].rsplit("/", 1)[1]: r for r in D.read_pages(D.read_files(spark, f"file://{tmp_path}")).collect()}
    assert rows["a.txt"]["text"] == "hello" and rows["b.MD"]["text"] == "café" and rows["c.docx"]["text"].startswith("One\n\nTwo\n\na")
    assert rows["d.pptx"]["text"] == "[Slide 1]\nfirst\n\n[Slide 2]\nsecond" and rows["e.docx"]["error"] and rows["f.zzz"]["error"].startswith("unknown suffix")


def test_links_are_resolved(spark):
    long = "word " * 200

    def get(url):
        if "bad" in url:
            raise RuntimeError("down")
        return f"<p>{long if 'long' in url else 'tiny'}</p>"

    rows = [("doc", 1, "just text here"), ("long", 1, "﻿https://x/long"), ("tiny", 1, "https://x/tiny"), ("bad", 1, "https://x/bad"), ("old", 1, "https://x/long2")]
    cached = spark.createDataFrame([("old", 5, "from the cache")], "path string, modified int, text string")
    out = D.resolve_links(spark.createDataFrame(rows, "path string, modified int, text string"), cached, get)
    got = {r["path"]: (r["resolved"], r["text"]) for r in out.collect()}
    assert got["doc"][0] == "document" and got["long"] == ("fetched", long.strip()) and got["tiny"] == ("link", "https://x/tiny") and got["bad"][0] == "link" and got["old"] == ("cache", "from the cache")


def test_fetching(monkeypatch, spark):
    monkeypatch.setattr(time, "sleep", lambda s: None)
    calls = []

    class Answer:
        headers = type("H", (), {"get_content_charset": lambda self: "no-such"})()

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            return "é".encode()

    def open_url(request, timeout):
        calls.append(request.full_url)
        if len(calls) < 3:
            raise OSError("reset")
        return Answer()

    assert fetch("http://x", open_url=open_url) == "é" and len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError):
        fetch("http://x", tries=2, open_url=open_url)
    pages = fetch_pages(spark.createDataFrame([("u",)], "url string"), get=lambda u: u + "!")
    assert pages.select("html").first()[0] == "u!" and pages.where(F.col("error").isNotNull()).isEmpty()
