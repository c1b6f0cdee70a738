import pytest
from pyspark.sql import functions as F

from siltstone.functions import constants as K
from siltstone.functions.entities import clamp_confidence, correct_type, entity_id, first_name, reclass_metric, score, storage_errors, validate

SCHEMA = (
    "ord long, entity_id string, entity_type string, name string, description string, domain array<string>, "
    "relationships array<struct<type:string,target:string,_auto_generated:boolean>>, confidence_scores map<string,double>, status string"
)
GOOD = "It runs in two steps, each of which reads all rows that came before. It then writes one row for each of them, in order."


def entity(ord_=0, **changes):
    e = {"ord": ord_, "entity_id": f"E{ord_}", "entity_type": "product", "name": f"Name {ord_}", "description": GOOD, "domain": ["d"], "relationships": [("enables", "X", False), ("causes", "Y", False)], "confidence_scores": {k: 0.5 for k in K.CONFIDENCE_KEYS}, "status": "canonical"}
    return tuple((e | changes).values())


def one(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function(F.col("x"))).first()[0]


def test_every_alias(spark):
    rows = spark.createDataFrame([(a.upper(), v) for a, v in K.TYPE_ALIASES], "a string, v string").select("a", "v", correct_type(F.col("a")).alias("got")).collect()
    assert [r for r in rows if r["got"] != r["v"]] == []


@pytest.mark.parametrize(("given", "wanted"), [("NegativeBoundary", "negative_boundary"), ("", "implementation_ops"), ("workflows", "implementation_ops"), ("metric", "metric"), ("zzz", "zzz"), (None, None)])
def test_types(spark, given, wanted):
    assert one(spark, given, correct_type) == wanted


def test_metrics(spark):
    cases = {"latency of 5 ms": "metric", "an algorithm that captures x": "product_theory", "a system": "architecture", "each step supports it": "implementation_ops", "nothing here": "product_theory", "the rate": "metric", "provides 7": "product_theory"}
    rows = spark.createDataFrame([(k,) for k in cases], "d string").select("d", reclass_metric(F.lit("metric"), F.lit("n"), F.col("d")).alias("t")).collect()
    assert {r["d"]: r["t"] for r in rows} == cases
    assert one(spark, "a system", lambda c: reclass_metric(F.lit("code"), F.lit("n"), c)) == "code"


def test_ids(spark):
    same = [one(spark, n, lambda c: entity_id(F.lit("Product Theory"), c)) for n in (" Thing ", "THING")]
    assert same[0] == same[1] and same[0].startswith("PRODUCT--") and len(same[0]) == 21
    a = one(spark, {"b": "1", "a": "2", "c": None}, lambda c: entity_id(F.lit("t"), F.lit("n"), c), "map<string,string>")
    b = one(spark, {"a": "2", "b": "1"}, lambda c: entity_id(F.lit("t"), F.lit("n"), c), "map<string,string>")
    assert a == b != one(spark, None, lambda c: entity_id(F.lit("t"), F.lit("n"), c), "map<string,string>")


def test_confidence_and_names(spark):
    assert one(spark, {"a": 1.0, "b": 1.0}, clamp_confidence, "map<string,double>") == {"a": 0.85, "b": 0.85}
    assert one(spark, {"a": 1.0, "b": 0.9}, clamp_confidence, "map<string,double>") == {"a": 1.0, "b": 0.9}
    assert one(spark, {}, clamp_confidence, "map<string,double>") == {}
    assert one(spark, ["x", "y"], first_name, "array<string>") == "x" and one(spark, [], first_name, "array<string>") == ""


def checked(spark, step, *rows):
    out = validate(spark.createDataFrame(list(rows), SCHEMA), step)
    return {r["ord"]: r for r in out.collect()}


def test_extraction_checks(spark):
    got = checked(spark, 1, entity(0), entity(1, description="Too short."), entity(2, description="a type of " + "x" * 90), entity(3, name=" ", domain=[]), entity(4, entity_type="zzz"), entity(5, description=None), entity(6, entity_type="kpi", description=GOOD.replace("two", "some")))
    assert got[0]["passed"] and got[0]["errors"] == []
    assert got[1]["errors"] == ["description_length:10"]
    assert got[2]["errors"] == ["description_sentences:0", "description_opener"]
    assert got[3]["errors"] == ["name", "domain"] and got[4]["errors"] == ["entity_type:zzz"] and got[5]["errors"] == ["description_length:0"]
    assert got[6]["entity_type"] == "metric" and got[6]["auto_fixes"] == ["entity_type"]


def test_normalised_checks(spark):
    got = checked(spark, 2, entity(0, relationships=[("zz", "", False), ("causes", "E0", False)]), entity(1, relationships=[]), entity(2, entity_id=" "), entity(3, confidence_scores=None), entity(4, confidence_scores={"classification": 1.0}))
    assert got[0]["errors"] == ["relationship[0].type:zz", "relationship[0].target", "relationship[1].self"]
    assert got[1]["errors"] == ["relationships"] and got[2]["errors"] == ["entity_id"] and got[3]["warnings"] == ["confidence_scores"]
    assert got[4]["confidence_scores"] == {"classification": 0.85} and "confidence_scores" in got[4]["auto_fixes"]


def test_merged_checks(spark):
    got = checked(spark, 3, entity(0, status=None), entity(1, name="name 0 "), entity(2, status="x", relationships=[]), entity(3, relationships=[("causes", "Q", False)]))
    assert got[0]["status"] == "canonical" and got[0]["auto_fixes"] == ["status"]
    assert "name_of:E0" in got[1]["warnings"] and got[2]["errors"] == ["relationships", "status:x"] and "few_relationships:1" in got[3]["warnings"]


def test_scores(spark):
    rows = [entity(0), entity(1, description="", relationships=[], confidence_scores={}), entity(2, confidence_scores={"entity_type": 2.0}), entity(3, confidence_scores=None), entity(4, confidence_scores={"classification": -1.0})]
    got = {r["ord"]: r for r in score(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0]["verdict"] == "accept" and got[1]["verdict"] == "reject" and got[2]["type_confidence"] == 1.0 and got[3]["type_confidence"] == 0.5 and got[4]["type_confidence"] == 0.0
    depth = min(1.0, min(1.0, 2 / 3) * 0.4 + min(1.0, len(GOOD) / 200) * 0.3 + 0.3)
    assert got[0]["total"] == depth * 0.35 + min(1.0, 2 / 3) * 0.25 + 0.5 * 0.25 + 0.8 * 0.15


def test_storage_checks(spark):
    rows = [entity(0), entity(1, entity_id="a/b"), entity(2, domain=["x", " "]), entity(3, domain=[]), entity(4, status=None, entity_type=None)]
    got = {r["ord"]: r["e"] for r in spark.createDataFrame(rows, SCHEMA).select("ord", storage_errors().alias("e")).collect()}
    assert got == {0: [], 1: ["entity_id_path"], 2: ["domain[1]"], 3: ["domain"], 4: ["missing:entity_type", "missing:status"]}
