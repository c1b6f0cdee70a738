import json

import pytest
from pyspark.sql import functions as F
from test_entities import GOOD, SCHEMA, entity

from siltstone.operators.merging import fold, list_union, merge
from siltstone.plans import knowledge, spec
from siltstone.sources.store import KnowledgeBase, numbered, read_json_records, safe
from siltstone.streaming.upserts import upsert_stream

NOW, LATER = "2026-01-01T00:00:00+00:00", "2026-01-02T00:00:00+00:00"


@pytest.fixture
def base(spark, tmp_path):
    return KnowledgeBase(spark, f"file://{tmp_path}/kb")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_waves(spark, base, tmp_path):
    first = [entity(0), entity(1, status="duplicate"), entity(2, entity_type="zzz"), entity(3, entity_id="E0", name="Name 0", description=GOOD + " Newer."), entity(4, entity_id="E0", name="Other")]
    assert base.persist(frame(spark, *first), NOW) == {"saved": 1, "merged": 1, "skipped": 1, "conflicts": 1, "invalid": 1}
    e = base.entities().first()
    assert e["description"].endswith("Newer.") and e["last_updated"] == NOW and e["confidence_scores"]["name"] == 0.0
    assert base.conflicts().first()["message"] == "name:Name 0|Other"
    second = [entity(0, domain=["d", "e"], description=GOOD, confidence_scores={"description": 0.9}), entity(7), entity(6)]
    assert base.persist(frame(spark, *second), LATER) == {"saved": 2, "merged": 1, "skipped": 0, "conflicts": 0, "invalid": 0}
    rows = {r["rkey"]: r for r in base.registry().collect()}
    assert {k: r["file_name"] for k, r in rows.items()} == {"d::product::E0": "001_E0.json", "d::product::E6": "002_E6.json", "d::product::E7": "003_E7.json"}
    assert rows["d::product::E0"]["domain"] == ["d", "e"] and rows["d::product::E0"]["last_updated"] == LATER and rows["d::product::E0"]["path"] == "product/d/001_E0.json"
    assert base.entities().count() == 3 and base.conflicts().count() == 1
    base.export_json(f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out").where("type = 'product' AND primary_domain = 'd'").count() == 3


def test_records_from_json(spark, tmp_path):
    (tmp_path / "code" / "d").mkdir(parents=True)
    (tmp_path / "code" / "d" / "001_x.json").write_text(json.dumps({"entity_id": "x", "domain": ["d"], "confidence_scores": {"a": 0.5}, "unknown": 1}, indent=2))
    row = read_json_records(spark, f"file://{tmp_path}").first()
    assert row["entity_id"] == "x" and row["confidence_scores"] == {"a": 0.5} and row["name"] is None
    assert read_json_records(spark, f"file://{tmp_path}/none").count() == 0


def test_a_broken_off_writer_is_no_hindrance(spark, base, monkeypatch):
    base.persist(frame(spark, entity(0)), NOW)

    def lost(versions):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(base.files, "swap", lost)
        with pytest.raises(OSError, match="lost"):
            base.persist(frame(spark, entity(1)), NOW)
    assert base.entities().count() == 1
    assert base.persist(frame(spark, entity(1)), LATER)["saved"] == 1
    assert base.entities().count() == 2 and sorted(r["number"] for r in base.registry().collect()) == [1, 2]


def test_edges_and_attributes_of_a_model_are_kept(spark):
    """Edges stay, so that nothing is inferred in their place; attributes tell ids apart."""
    from siltstone.plans import knowledge

    kind = "doc_id long, chunk_index int, entity_type string, name string, description string, domain array<string>, confidence_scores map<string,double>, status string, relationships array<struct<type:string,target:string,_auto_generated:boolean>>, attributes map<string,string>"
    rows = [(1, 0, "concept", "n", "some words here", ["d"], {}, "canonical", [("uses", "X", False)], {"k": "1"}), (1, 1, "concept", "n", "other words here", ["d"], {}, "canonical", None, {"k": "2"})]
    got = knowledge.stamped(knowledge.arranged(spark.createDataFrame(rows, kind))).orderBy("chunk_index").collect()
    assert [[tuple(e) for e in r["relationships"]] for r in got] == [[("uses", "X", False)], []] and got[0]["entity_id"] != got[1]["entity_id"]


def test_a_second_writer_is_refused(spark, base, monkeypatch):
    base.persist(frame(spark, entity(0)), NOW)
    seen = iter([1, 1, 1, 2])
    monkeypatch.setattr(base.files, "current", lambda: next(seen))
    with pytest.raises(RuntimeError, match="moved"):
        base.persist(frame(spark, entity(1)), NOW)


def test_merging_is_repeatable(spark):
    one = "named_struct('entity_id','a','entity_type','code','name','n','description','x','status','canonical','_quality_score',0.5D,'domain',array('d'),'relationships',array(named_struct('type','t','target','u','_auto_generated',false)),'confidence_scores',map('description',0.4D),'last_updated','t')"
    from siltstone.operators.merging import RECORD

    r = spark.sql(f"SELECT {one} AS a").select(F.col("a").cast(RECORD).alias("a"))
    once = r.select(merge(F.col("a"), F.col("a"), F.lit("t")).alias("m"))
    twice = once.select("m", merge(F.col("m"), F.col("m"), F.lit("t")).alias("mm")).first()
    assert twice["m"] == twice["mm"] and twice["m"]["domain"] == ["d"] and len(twice["m"]["relationships"]) == 1
    weak = r.select("a", F.col("a").withField("description", F.lit("y")).withField("confidence_scores", F.expr("map('description', 0.3D)")).cast(RECORD).alias("b"))
    got = weak.select(merge(F.col("a"), F.col("b"), F.lit("t")).alias("m"), merge(F.col("b"), F.col("a"), F.lit("t")).alias("n")).first()
    assert got["m"]["description"] == "x" == got["n"]["description"] and got["n"]["confidence_scores"]["description"] == 0.4
    null = weak.select(F.lit("k").alias("rkey"), F.lit(1).alias("ord"), F.col("a").withField("description", F.lit(None).cast("string")).cast(RECORD).alias("record"))
    assert fold(null, None, F.lit("t")).first()["record"]["description"] is None


def test_parts(spark):
    rows = numbered(spark.range(0, 500, 1, 7).withColumn("o", -F.col("id")), "o", 11).collect()
    assert sorted((r["o"], r["number"]) for r in rows) == [(o, 11 + i) for i, o in enumerate(range(-499, 1))]
    assert [r[0] for r in spark.createDataFrame([("..",), ("a/b",), ("",), ("ok",)], "x string").select(safe(F.col("x"))).collect()] == ["_", "a_b", "_", "ok"]
    assert spark.range(1).select(list_union(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("a"), F.lit("c")))).first()[0] == ["b", "a", "c"]


def test_plan_to_store(spark, base):
    text = "The scheme reads rows one by one and keeps them in order. It then writes them out again. " * 4
    docs = spark.createDataFrame([(1, text, "en", "s"), (2, text.replace("rows", "lines"), "en", "s"), (3, "short", "en", "s"), (4, None, "en", "s")], "doc_id long, text string, lang string, source string")
    done, result = knowledge.run(spark, docs, base, NOW)
    assert result.chunks == 3 and result.unusable == 1 and result.extracted == 2 and result.normalised == 2
    assert sum(result.stats.values()) == 2 and result.stats["saved"] == base.entities().count() >= 1
    assert done.where("status = 'canonical'").count() == result.refined


def test_plan_keeps_entities_of_one_id(spark, base):
    """Equal types and first 60 characters give one id: other texts under it are folded into the first, copies are duplicates."""
    head = "The scheme of the reader that all of these documents tell about is "
    first, second = (head + " ".join(f"{k}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)) for k in "pq")
    docs = spark.createDataFrame([(1, first, "en", "s"), (2, second, "en", "t"), (3, first, "en", "u"), (3, first, "en", "u")], "doc_id long, text string, lang string, source string")
    done, result = knowledge.run(spark, docs, base, NOW)
    rows = done.orderBy("ord").collect()
    assert result.extracted == result.normalised == 4 and len({r["entity_id"] for r in rows}) == 1
    assert [r["status"] for r in rows] == ["canonical", "canonical", "duplicate", "duplicate"] and len({r["cluster_id"] for r in rows}) == 2
    assert result.stats["saved"] == result.stats["merged"] == 1
    assert sorted(base.entities().first()["domain"]) == ["en", "s", "t"]


def test_plan_with_a_model(spark):
    from siltstone.operators.generation import RuleGenerator

    docs = spark.createDataFrame([(1, "It works well for all. " * 20, "en", "s")], "doc_id long, text string, lang string, source string")
    done, result = knowledge.run(spark, docs, extract=knowledge.model_extract(RuleGenerator(), retries=0, tries=1))
    assert result.extracted == 1 and done.first()["name"].startswith("It works well")


def test_stream(spark, base, tmp_path):
    source = f"{tmp_path}/in"
    frame(spark, entity(0), entity(1)).write.parquet(source)
    stream = spark.readStream.schema(frame(spark, entity(0)).schema).parquet(source)
    query = upsert_stream(stream, base, f"{tmp_path}/check", lambda epoch: NOW)
    query.awaitTermination(60)
    assert base.entities().count() == 2


def test_spec(spark):
    shape = "struct<entity_id:string,entity_type:string,name:string,aliases:array<string>,description:string,owner:string,relationships:array<struct<type:string,target_id:string,context:string>>,source_document:string,confidence:double,texts:map<string,string>,lists:map<string,array<string>>,alternatives:array<struct<option:string,rejection_reason:string>>,version:int>"
    a = ("kb:workflow:w", "workflow", "The Flow", ["Fl"], "short", "kb:product:p", [("uses", "kb:problem:x", "old")], "f1", 0.5, {"trigger": "t", "status": "active"}, {"steps": ["1", "2"], "x": ["A"]}, [("o", "r1")], 1)
    b = ("kb:workflow:w", "workflow", "Flow", ["fl ", "New"], "a longer one", "kb:product:q", [("uses", "kb:problem:x", "new"), ("owns", "kb:problem:y", "c")], "f2, f1", 0.9, {"trigger": "trigger"}, {"steps": ["1"], "x": ["a", "B"]}, [("o", "r2")], None)
    r = spark.createDataFrame([(a, b)], f"e {shape}, i {shape}").select(spec.merge(F.col("e"), F.col("i")).alias("m"), spec.identity(F.col("e"), F.col("i")).alias("same"), spec.conflicts(F.col("i"), F.col("e")).alias("c")).first()
    m = r["m"]
    assert (m["name"], m["aliases"], m["description"], m["owner"], m["confidence"], m["source_document"], m["version"]) == ("The Flow", ["Fl", "New"], "a longer one", "kb:product:q", 0.9, "f1, f2", 2)
    assert sorted(tuple(x) for x in m["relationships"]) == [("owns", "kb:problem:y", "c"), ("uses", "kb:problem:x", "new")] and m["lists"] == {"steps": ["1", "2"], "x": ["A", "B"]}
    assert m["texts"] == {"trigger": "trigger", "status": "active"} and [tuple(x) for x in m["alternatives"]] == [("o", "r2")]
    assert r["same"] == "merge" and [x["code"] for x in r["c"]] == ["weaker"]
    assert spark.range(1).select(spec.slug_id(F.lit("product"), F.lit(" A-b & C™ (x)/y ")), spec.slug(F.lit("z" * 90))).first()[0] == "kb:product:a_b_c_x_y"
