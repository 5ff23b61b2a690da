"""Nested shard union, and typed extraction of replies, on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialforge.operators import generation as gen
from dialforge.sources import shapes


def test_missing_reordered_and_widened(spark):
    a = spark.createDataFrame([(1, [("x", 1)], {"k": 1})], "id int, m array<struct<a:string,n:int>>, tags map<string,int>")
    b = spark.createDataFrame([([(2 ** 40, "y", (True,)), None], 2 ** 40)], "m array<struct<n:bigint,a:string,deep:struct<ok:boolean>>>, id long")
    c = spark.createDataFrame([(None, 3, {"z": 2 ** 40})], T.StructType([
        T.StructField("m", T.NullType()), T.StructField("id", T.ShortType()), T.StructField("tags", T.MapType(T.StringType(), T.LongType()))]))
    got = shapes.union_nested(a, b, c)
    assert got.schema["id"].dataType == T.LongType()
    assert got.schema["m"].dataType.simpleString() == "array<struct<a:string,n:bigint,deep:struct<ok:boolean>>>"
    rows = {r["id"]: r.asDict(recursive=True) for r in got.collect()}
    assert rows[1] == {"id": 1, "m": [{"a": "x", "n": 1, "deep": None}], "tags": {"k": 1}}
    assert rows[2 ** 40] == {"id": 2 ** 40, "m": [{"a": "y", "n": 2 ** 40, "deep": {"ok": True}}, None], "tags": None}
    assert rows[3] == {"id": 3, "m": None, "tags": {"z": 2 ** 40}}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_bag_and_nulls(spark):
    a = spark.createDataFrame([((1,),), (None,), ((None,),)], "s struct<x:int>")
    b = spark.createDataFrame([(("t",),), (None,)], "s struct<y:string>")
    got = [r["s"] if r["s"] is None else r["s"].asDict() for r in shapes.union_nested(a, b, a).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [{"x": 1, "y": None}, None, {"x": None, "y": None}] * 2 + [{"x": None, "y": "t"}, None]))


@pytest.mark.parametrize("left, right, wide", [
    ("tinyint", "bigint", "bigint"), ("float", "double", "double"), ("int", "double", "double"), ("smallint", "float", "float"),
    ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(5,3)", "decimal(8,1)", "decimal(10,3)"), ("date", "timestamp", "timestamp"), ("void", "string", "string")])
def test_numbers_widen(spark, left, right, wide):
    def kind(name):
        return T.NullType() if name == "void" else T._parse_datatype_string(name) if name.startswith(("array", "decimal")) else T._parse_datatype_string(f"x {name}")["x"].dataType
    assert shapes.unify(kind(left), kind(right)).simpleString() == wide == shapes.unify(kind(right), kind(left)).simpleString()


@pytest.mark.parametrize("left, right, path", [
    ("id int", "id string", "id"), ("m array<struct<a:int>>", "m array<struct<a:array<int>>>", "m[].a"),
    ("s struct<t:struct<u:boolean>>", "s struct<t:struct<u:int>>", "s.t.u"), ("x bigint", "x double", "x"), ("x bigint", "x float", "x"),
    ("k map<string,int>", "k map<string,string>", "k{}"), ("x decimal(38,0)", "x decimal(38,10)", "x"), ("a array<int>", "a struct<x:int>", "a")])
def test_conflicts_are_named(spark, left, right, path):
    a, b = spark.createDataFrame([], left), spark.createDataFrame([], right)
    with pytest.raises(shapes.SchemaConflict) as e:
        shapes.union_nested(a, b)
    assert str(e.value).startswith(f"{path}: ")


def test_no_shards_and_twice_named(spark):
    with pytest.raises(ValueError):
        shapes.union_nested()
    with pytest.raises(shapes.SchemaConflict, match="twice"):
        shapes.union_nested(spark.range(1).select(F.col("id"), F.col("id").alias("ID")))


CONTENT = [("text", "text", None), ("", None, gen.ERR_EMPTY), (None, None, gen.ERR_NO_CONTENT), (7, None, "content is not text: BIGINT"),
           (1.5, None, "content is not text: DECIMAL(2,1)"), (True, None, "content is not text: BOOLEAN"), ({"text": "x"}, None, "content is not text: OBJECT<text: STRING>"),
           (["a", {"type": "text", "text": "b"}], "ab", None), ([], None, gen.ERR_EMPTY), ([{"image": 1}], None, "content is not text: ARRAY<OBJECT<image: BIGINT>>"),
           ("7", "7", None), ("é\n\"q\"", "é\n\"q\"", None)]


@pytest.mark.parametrize("form", list(gen.FORMS))
def test_typed_content(spark, form):
    def body(value):
        return json.loads(gen.wrap_reply(form, "@"), object_hook=lambda o: {k: value if v == "@" else v for k, v in o.items()})

    rows = [(i, form, json.dumps(body(v)), None) for i, (v, _, _) in enumerate(CONTENT)]
    rows += [(100, form, "{bad", None), (101, form, "{}", None), (102, form, None, None), (103, "nobody", "{}", None), (104, form, "{}", "failed before"),
             (105, None, "{}", None), (106, form, "[]", None)]
    got = {r["id"]: (r["text"], r["error"]) for r in gen.extract_variant(
        spark.createDataFrame(rows, "id int, provider string, raw string, error string")).collect()}
    assert {i: got[i] for i in range(len(CONTENT))} == {i: (t, e) for i, (_, t, e) in enumerate(CONTENT)}
    assert [got[i][1] for i in range(100, 107)] == [gen.ERR_MALFORMED, gen.ERR_NO_CONTENT, gen.ERR_MALFORMED, gen.ERR_UNKNOWN_FORM, "failed before",
                                                    gen.ERR_UNKNOWN_FORM, gen.ERR_NO_CONTENT]
