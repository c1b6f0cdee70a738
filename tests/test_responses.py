import json

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions.responses import balanced, entity_json, entity_list, extract, extract_json, message_content, unwrap


def walk(text):
    """Character by character: the first span whose brackets all close."""
    i = 0
    while i < len(text):
        if text[i] not in "{[":
            i += 1
            continue
        start, open_, quoted = i, ["}" if text[i] == "{" else "]"], False
        i += 1
        while i < len(text) and open_:
            c = text[i]
            if quoted:
                if c == "\\" and i + 1 < len(text):
                    i += 1
                elif c == '"':
                    quoted = False
            elif c == '"':
                quoted = True
            elif c in "{[":
                open_.append("}" if c == "{" else "]")
            elif c == open_[-1]:
                open_.pop()
            i += 1
        if not open_:
            return text[start:i]
    return None


@given(st.text(alphabet='{}[]"\\a ,', max_size=40))
def test_balanced_spans(text):
    assert balanced(text) == walk(text)


def test_extraction():
    assert extract(' {"a": 1} ') == {"a": 1} and extract('x ```json\n[1]\n``` y') == [1] and extract('say {"a": "}"} ok') == {"a": "}"}
    assert extract("null") is None and extract("nothing") is None and extract('{"a": NaN, "a": 2}') == {"a": 2} and extract(None) is None


def test_entity_lists():
    e, w = {"name": "n"}, {"results": [{"name": "m"}, 3]}
    assert entity_list({"entities": [e, 1]}) == [e] and entity_list(e) == [e] and entity_list({"x": 1}) == [] and entity_list([e, w, 2, {"y": 0}]) == [e, {"name": "m"}] and entity_list(5) == []


def test_columns(spark):
    rows = spark.createDataFrame([(1, 'a {"name": "x"} b'), (2, None), (3, "[[")], "i int, t string")
    got = {r["i"]: r for r in rows.select("i", extract_json("t").alias("v"), entity_json("t").alias("e")).collect()}
    assert json.loads(got[1]["v"]) == {"name": "x"} and [json.loads(x) for x in got[1]["e"]] == [{"name": "x"}] and got[2]["v"] is None and got[3]["v"] is None
    body = spark.createDataFrame([('{"choices":[{"message":{"content":"hi"}}]}',), ('{"choices":[]}',), ("no",)], "b string")
    assert [r[0] for r in body.select(message_content(F.col("b"))).collect()] == ["hi", None, None]
    assert spark.sql("SELECT '{\"data\": [1, 2]}' AS t").select(F.size(unwrap(F.try_parse_json("t")))).first()[0] == 2
