"""The pipeline against its operators applied one after the other, in plain Python where that is possible."""

import zlib

import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import decontamination, jaccard, pii, toxicity
from siltstone.llm.queries import tokenizer_json


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = (before, docs)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ids = lambda d: {r[0] for r in d.select("doc_id").collect()}

    before, after = kept["toxicity"]
    model = toxicity.scorer(toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True)))
    assert ids(after) == ids(before.where(model("text") < toxicity.THRESHOLD))

    before, after = kept["near duplicates"]
    least = {r["component_id"] for r in jaccard.query(before).collect()}
    assert ids(after) == least and after.count() == len(least)

    before, after = kept["decontamination"]
    bad = {r["doc_id"] for r in decontamination.query(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert ids(after) == ids(before) - bad

    before, after = kept["personal data"]
    old, new = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (before, after))
    assert set(old) == set(new) and all((not pii.base_spans(old[i])) <= (old[i] == new[i] or "<SECRET>" in new[i]) and not pii.base_spans(new[i]) for i in old)

    before, after = kept["packing"]
    tokenizer = Tokenizer.from_str(tokenizer_json())
    rows = {(r["doc_id"], r["start"]): r for r in after.collect()}
    for r in before.collect():
        ids_ = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
        at = 0
        while at < len(ids_):
            piece = rows.pop((r["doc_id"], at))
            raw = b"".join(x.to_bytes(4, "little") for x in ids_[at : at + piece["length"]])
            assert zlib.crc32(raw) == piece["ids_crc32"]
            at += piece["length"]
    assert not rows


def test_run_gives_what_the_stages_give(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
