"""Contracts that change: by the public schema resolution rules."""

import pytest

from rxstrata.sources import evolution as ev


def contract(*fields):
    return {"type": "record", "name": "r", "fields": [{"name": n, "type": t, **(m[0] if m else {})} for n, t, *m in fields]}


def enum(*symbols, **more):
    return {"type": "enum", "name": "e", "symbols": list(symbols), **more}


WIDENING = {
    "int": {"int", "long", "float", "double"}, "long": {"long", "float", "double"}, "float": {"float", "double"},
    "double": {"double"}, "string": {"string", "bytes"}, "bytes": {"bytes", "string"}, "boolean": {"boolean"},
}


@pytest.mark.parametrize("old", list(WIDENING))
def test_types_that_widen_and_those_that_are_refused(old):
    for new in WIDENING:
        found = ev.problems(contract(("a", old)), contract(("a", ["null", new])))
        assert (found == []) == (new in WIDENING[old]), (old, new)


def test_every_problem_is_named():
    writer = contract(("a", "double"), ("b", "string"), ("c", {"type": "array", "items": "string"}), ("r", contract(("x", "string"))))
    reader = contract(
        ("a", "int"), ("b", "string"), ("d", "string"), ("c", {"type": "array", "items": "int"}),
        ("r", contract(("x", "long"), ("y", "int", {"default": 1}))),
    )
    assert ev.problems(writer, reader) == [
        "a: double cannot be read as int", "d: not written, and without default",
        "c[]: string cannot be read as int", "r.x: string cannot be read as long",
    ]
    with pytest.raises(ev.Incompatible, match="unions of 2"):
        ev.problems(contract(("a", ["int", "string"])), contract(("a", "int")))


def test_rows_are_resolved(spark):
    writer = contract(
        ("id", "int"), ("old_name", "string"), ("level", "string"), ("mode", enum("on", "off", "auto")),
        ("tags", {"type": "array", "items": ["null", "string"]}), ("at", ["null", contract(("x", "int"))]),
    )
    reader = contract(
        ("id", "double"), ("name", "string", {"aliases": ["older", "old_name"]}),
        ("level", ["null", "string"]), ("mode", enum("on", "off", default="off")),
        ("tags", {"type": "array", "items": "string"}), ("at", ["null", contract(("x", "long"), ("y", "string", {"default": "d"}))]),
        ("size", "long", {"default": 7}), ("list", {"type": "array", "items": "int"}, {"default": [1, 2]}),
    )
    rows = spark.createDataFrame(
        [(1, "a", None, "on", ["t"], (5,), "extra"), (2, None, "l", "auto", [], None, "extra"), (3, "c", "l", "on", [None], None, "extra")],
        "id int, old_name string, level string, mode string, tags array<string>, at struct<x:int>, other string",
    )
    got = ev.resolve(rows, writer, reader)
    assert [f.dataType.simpleString() for f in got.schema.fields[:8]] == [
        f.dataType.simpleString() for f in ev.schema_of(reader).fields
    ]
    one, two, three = got.orderBy("id").collect()
    assert tuple(one)[:8] == (1.0, "a", None, "on", ["t"], (5, "d"), 7, [1, 2])
    assert one.reject_reasons == [] and one.original is None
    assert two.mode == "off" and two.at is None and two.reject_reasons == ["name: null"]
    assert three.reject_reasons == ["tags: an item cannot be read"] and '"old_name":"c"' in three.original


def test_versions_are_read_together_or_refused(spark, tmp_path):
    old, new = contract(("a", "int"), ("k", enum("x", "y"))), contract(("a", "long"), ("k", "string"), ("b", "string"))
    wanted = contract(("a", "long"), ("k", enum("x", "z")), ("b", "string", {"default": ""}))
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, k string").write.parquet(f"{tmp_path}/1")
    spark.createDataFrame([(3, "z", "b"), (None, "q", "b")], "a long, k string, b string").write.parquet(f"{tmp_path}/2")
    spark.createDataFrame([], "a long, k string, b string").write.parquet(f"{tmp_path}/3")
    parts = [(f"{tmp_path}/1", old), (f"{tmp_path}/2", new), (f"{tmp_path}/3", None)]
    good, rejects = ev.read_versions(spark, parts, wanted)
    assert sorted(map(tuple, good.collect())) == [(1, "x", ""), (3, "z", "b")]
    assert sorted((r.part[-1], r.reject_reasons) for r in rejects.collect()) == [
        ("1", ["k: unknown symbol y"]), ("2", ["a: null", "k: unknown symbol q"]),
    ]
    with pytest.raises(ev.Incompatible) as refused:
        ev.read_versions(spark, parts, contract(("a", "int"), ("z", "string")))
    assert len(refused.value.problems) == 5
    with pytest.raises(ev.Incompatible, match="not in the table"):
        ev.resolve(good, contract(("a", "long"), ("missing", "int")), contract(("a", "long")))


def test_a_contract_from_columns_reads_them_back(spark):
    df = spark.createDataFrame([(1, 2.0, ["x"], (True, b"y"))], "a int, b double, c array<string>, d struct<e:boolean,f:binary>")
    own = ev.contract_of(df.schema)
    assert ev.schema_of(own) == df.schema and ev.problems(own, own) == []
    assert ev.resolve(df, own, own).select(*df.columns).collect() == df.collect()
