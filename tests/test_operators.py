import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import generation as G
from siltstone.operators.batching import fixed_batches, json_size, size_batches
from siltstone.operators.components import components
from siltstone.operators.similarity import clusters, domain_candidates, edge_type, enrich, jaccard_pairs

SETTINGS = {"sleep": lambda s: None}


def greedy(sizes, most):
    out, used, batch = [], 0, 0
    for k, z in enumerate(sizes):
        if k and used + z > most:
            batch, used = batch + 1, 0
        used += z
        out.append(batch)
    return out


def test_size_batches(spark):
    groups = {"a": [5, 5, 1, 100, 3, 7, 10, 10], "b": [10], "c": [11, 11, 0, 0, 10], "d": [1] * 30}
    rows = [(g, i, z) for g, zs in groups.items() for i, z in enumerate(zs)]
    got = {}
    for r in size_batches(spark.createDataFrame(rows, "g string, o long, z long"), "g", "o", "z", 10).orderBy("g", "o").collect():
        got.setdefault(r["g"], []).append(r["batch_id"])
    assert got == {g: greedy(zs, 10) for g, zs in groups.items()}


def test_fixed_batches_and_sizes(spark):
    rows = fixed_batches(spark.range(45), F.lit(0), "id").groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in rows} == {0: 20, 1: 20, 2: 5}
    value = {"a": [1, "é"], "b": None}
    assert spark.createDataFrame([(json.dumps(value, separators=(",", ":"), ensure_ascii=False),)], "j string").select(json_size("j")).first()[0] == len(json.dumps(value))


def union_find(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(int(a), int(b)) for a, b in np.random.default_rng(3).integers(0, 120, (90, 2))], [(5, 5)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(130, edges)
    assert got == {v: want[v] for e in edges if e[0] != e[1] for v in e}


def brute(texts, t):
    import re

    sets = [set(re.findall("[a-z][a-z0-9_]+", x.lower())) for x in texts]
    sim = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    return {(i, j): s for i in range(len(sets)) for j in range(i + 1, len(sets)) if (s := sim(sets[i], sets[j])) >= t}


def test_similar_pairs_and_clusters(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 8))) for _ in range(80)] + ["", "same words here"] * 3 + ["!!!", "aa bb cc dd", "aa bb cc ee", "aa bb ff gg ee"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for t in (0.5, 0.8):
        want = brute(texts, t)
        assert {(p["a"], p["b"]): p["sim"] for p in jaccard_pairs(rows, "id", F.col("t"), t).collect()} == want
        assert [c["cluster_id"] for c in clusters(rows, "id", F.col("t"), t).orderBy("id").collect()] == union_find(len(texts), want)


def entity(ord_, kind, text, domain, edges=0):
    return (ord_, f"E{ord_}", kind, "n", text, domain, [("causes", "Z", False)] * edges, {})


def test_enrichment(spark):
    schema = "ord long, entity_id string, entity_type string, name string, description string, domain array<string>, relationships array<struct<type:string,target:string,_auto_generated:boolean>>, confidence_scores map<string,double>"
    rows = [
        entity(0, "product", "alpha beta gamma", ["A", "b"]), entity(1, "metric", "alpha beta gamma", ["a", "B"], 1), entity(2, "product", "alpha beta delta", ["a"], 1), entity(3, "code", "alpha beta gamma", ["a"], 1),
        entity(4, "code", "alpha zeta", ["lonely"]), entity(5, "code", "nothing shared", ["alone"]),
    ]
    got = {r["ord"]: r for r in enrich(spark.createDataFrame(rows, schema)).collect()}
    assert [(r["type"], r["target"]) for r in got[0]["relationships"]] == [("constrains", "E1"), ("depends_on", "E3")] and got[0]["confidence_scores"] == {"relationships": 0.5}
    assert [r["target"] for r in got[4]["relationships"]] == ["E0", "E1"] and got[4]["relationships"][0]["_auto_generated"]
    assert got[5]["relationships"] == [] and got[5]["confidence_scores"] == {} and len(got[1]["relationships"]) == 1
    assert domain_candidates(spark.createDataFrame(rows, schema))[0].where("eid = 'E0' AND cid = 'E1'").count() == 1
    kinds = spark.createDataFrame([("implementation_ops", "architecture"), ("code", "code"), ("code", "metric")], "s string, t string").select(edge_type(F.col("s"), F.col("t")))
    assert [r[0] for r in kinds.collect()] == ["implements", "refines", "depends_on"]


class Script:
    """Answers in turn; an exception is raised."""

    model = "script"

    def __init__(self, *answers):
        self.answers, self.prompts = list(answers), []

    def generate(self, prompt, system=""):
        self.prompts.append(prompt)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def faults(e):
    return [] if e.get("ok") else ["bad"]


def answer(*oks):
    return json.dumps([{"name": f"n{i}", "ok": ok} for i, ok in enumerate(oks)])


def test_calls_are_tried_again():
    s = Script(OSError("x"), "no json", answer(True))
    a = G.call(s, "p", **SETTINGS)
    assert a.error is None and len(s.prompts) == 3
    assert G.call(Script(*["-"] * 3), "p", **SETTINGS).error == "no JSON in the answer"
    assert "ValueError" in G.call(Script(*[ValueError("empty")] * 3), "p", **SETTINGS).error
    with pytest.raises(G.PromptTooLarge):
        G.call(Script(), "x" * 32_001, **SETTINGS)


def test_validation_feedback():
    s = Script(answer(True, False), answer(True, True))
    a, used = G.call_validated(s, "p", "", faults, **SETTINGS)
    assert used == 2 and all(a.passes) and "- n1: bad" in s.prompts[1] and s.prompts[1].startswith("p\n")
    a, used = G.call_validated(Script(answer(True, False), answer(False, False), answer(False, True)), "p", "", faults, **SETTINGS)
    assert used == 3 and a.passes == [True, False]  # the earliest of the best
    a, _ = G.call_validated(Script(answer(False), *["-"] * 6), "p", "", faults, **SETTINGS)
    assert a.error is None and a.passes == [False]


def test_generators(spark):
    rows = spark.createDataFrame([(1, "a\n\nA text. More."), (2, "b"), (3, "x" * 40_000)], "i int, prompt string")
    key = rows.where("i = 1").select(G.prompt_key(F.col("prompt"), "sys")).first()[0]
    out = {r["i"]: r["answer"] for r in G.generate(rows, "prompt", G.ReplayGenerator({key: '{"name": "n"}'}), "sys", tries=1).collect()}
    assert out[1]["success"] and json.loads(out[1]["parsed"]) == {"name": "n"} and not out[2]["success"] and "32000" in out[3]["error"].replace(",", "")
    rule = G.generate(rows.where("i = 1"), "prompt", G.RuleGenerator(), faults_of=G.extraction_faults, **SETTINGS).first()["answer"]
    assert rule["success"] and json.loads(rule["parsed"])[0]["name"] == "A text."
    with pytest.raises(ValueError):
        G.HttpGenerator("", "m")


def test_http_generator():
    class Answer:
        def __init__(self, body):
            self.body = body

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            return json.dumps(self.body).encode()

    make = lambda body: G.HttpGenerator("http://x", "m", open_url=lambda r, timeout: Answer(body))
    assert make({"choices": [{"message": {"content": "hi"}}]}).generate("p") == "hi"
    for body in ({}, {"choices": []}, {"choices": [{"message": {"content": " "}}]}):
        with pytest.raises(ValueError):
            make(body).generate("p")


def test_prompts_and_best_attempts(spark):
    assert G.load_prompt("x") == f"{G.JSON_ONLY}\n\nx" and G.load_prompt(G.load_prompt("x")) == G.load_prompt("x")
    rows = [("a", 1, False, 2), ("a", 2, False, 3), ("a", 3, False, 3), ("b", 1, False, 9), ("b", 2, True, 4), ("b", 3, True, 5)]
    got = G.best_attempt(spark.createDataFrame(rows, "g string, o int, full boolean, n int"), "g", F.col("o"), F.col("full"), F.col("n"), F.col("o")).collect()
    assert {r["g"]: r["answer"] for r in got} == {"a": 2, "b": 2}


def test_document_clusters_take_whole_texts(spark, tmp_path):
    """Documents alike only after 400 characters are one cluster; those alike only before are two."""
    from siltstone.queries import queries

    many = lambda k, n: " ".join(f"{k}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n))
    texts = [many("a", 120) + many(" z", 600), many("b", 120) + many(" z", 600), many("c", 120) + many(" x", 600), many("c", 120) + many(" y", 600), None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["cluster_id"] for r in queries()["q29_document_clusters"](spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5}
