"""Kinds, families, widening and strict sets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions import kinds
from tablegate.functions.widening import WideningError, can_widen, set_exact, upgrade_to

parse = T.DataType.fromDDL
pytestmark = pytest.mark.usefixtures("spark")

TYPES = {
    "BOOLEAN": "boolean", "BYTE": "tinyint", "SHORT": "smallint", "INT": "int", "LONG": "bigint",
    "FLOAT": "float", "DOUBLE": "double", "STRING": "string", "LIST": "array<int>",
    "MAP": "map<string,int>", "STRUCT": "struct<a:int>",
}
NUMBERS = ["BYTE", "SHORT", "INT", "LONG", "FLOAT", "DOUBLE"]


@pytest.mark.parametrize(("kind", "name"), TYPES.items())
def test_kind_of(kind, name):
    assert kinds.kind_of(parse(name)) == kind
    assert kinds.is_integer(parse(name)) == (kind in ("BYTE", "SHORT", "INT", "LONG"))
    assert kinds.is_floating_point(parse(name)) == (kind in ("FLOAT", "DOUBLE"))
    assert kinds.is_collection(parse(name)) == (kind in ("LIST", "MAP", "STRUCT"))
    assert kinds.is_map_like(parse(name)) == (kind in ("MAP", "STRUCT"))
    assert kinds.is_primitive(parse(name)) != kinds.is_collection(parse(name))


@pytest.mark.parametrize("name", ["decimal(10,2)", "timestamp", "date", "binary"])
def test_other_primitives_are_rejected(name):
    with pytest.raises(kinds.UnsupportedTypeError):
        kinds.kind_of(parse(name))
    with pytest.raises(kinds.UnsupportedTypeError, match="when"):
        kinds.assert_supported_types(parse(f"id bigint, when {name}"))
    kinds.assert_supported_types(parse("id bigint, tags array<string>"))


@pytest.mark.parametrize("source", TYPES)
@pytest.mark.parametrize("target", TYPES)
def test_widening_of_kinds(source, target):
    if source in NUMBERS and target in NUMBERS:
        expected = NUMBERS.index(source) <= NUMBERS.index(target)
    else:
        expected = source == target or (source, target) == ("MAP", "STRUCT")
    assert can_widen(parse(TYPES[source]), parse(TYPES[target])) == expected


def test_any_number_goes_into_double():
    assert can_widen(parse("decimal(20,3)"), parse("double"))
    assert not can_widen(parse("decimal(20,3)"), parse("float"))
    assert not can_widen(parse("timestamp"), parse("bigint"))
    assert can_widen(parse("timestamp"), parse("timestamp"))


def test_nested_types_decide_too():
    assert can_widen(parse("array<int>"), parse("array<bigint>"))
    assert not can_widen(parse("array<bigint>"), parse("array<int>"))
    assert can_widen(parse("map<string,int>"), parse("map<string,double>"))
    assert not can_widen(parse("map<int,int>"), parse("struct<a:int>"))
    assert can_widen(parse("struct<a:int>"), parse("struct<a:bigint,b:string>"))
    assert not can_widen(parse("struct<z:int>"), parse("struct<a:int>"))


def test_values_four_upward(spark):
    """The value 4 as every narrower type, and null, into every column."""
    schema = parse("t1 tinyint, s1 smallint, i1 int, l1 bigint, f1 float, d1 double")
    names = ["tinyint", "smallint", "int", "bigint", "float", "double"]
    for position, field in enumerate(schema.fields):
        for number, source in enumerate(names):
            frame = spark.range(1).select(F.lit(4).cast(source).alias(field.name))
            if number <= position:
                row = upgrade_to(frame, schema).first()
                assert row[field.name] == 4
                assert [row[i] for i in range(6) if i != position] == [None] * 5
            else:
                with pytest.raises(WideningError, match=field.name):
                    upgrade_to(frame, schema)
        empty = spark.range(1).select(F.lit(None).alias(field.name))
        assert upgrade_to(empty, schema).first()[field.name] is None
    fraction = spark.range(1).select(F.lit(4.2).cast("float").alias("d1"))
    assert upgrade_to(fraction, schema).first().d1 == pytest.approx(4.2)


def test_unknown_column_is_refused(spark):
    with pytest.raises(WideningError, match="no such column.*idd"):
        upgrade_to(spark.range(1).toDF("idd"), parse("id bigint"))


def test_collections_widen(spark):
    frame = spark.sql(
        """SELECT array(1, null) AS l, map('a', 1) AS m, map('a', 1, 'zz', 2) AS s,
                  named_struct('a', 1) AS t, map(1, 'x') AS k"""
    )
    schema = parse(
        "l array<bigint>, m map<string,double>, s struct<a:bigint,b:int>, "
        "t struct<a:bigint,b:string>, k map<bigint,string>"
    )
    row = upgrade_to(frame, schema).first()
    assert row.l == [1, None] and row.m == {"a": 1.0} and row.k == {1: "x"}
    assert tuple(row.s) == (1, None) and tuple(row.t) == (1, None)
    nulls = frame.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema.fields))
    assert set(upgrade_to(nulls, schema).first()) == {None}


def test_keys_that_meet_after_widening_keep_the_first(spark):
    big = 2**60
    frame = spark.sql(f"SELECT map({big}L, 'first', {big + 1}L, 'second') AS k")
    assert upgrade_to(frame, parse("k map<double,string>")).first().k == {float(big): "first"}


def test_strict_set_wants_the_declared_type(spark):
    schema = parse("id bigint, place map<string,int>")
    assert set_exact(spark.range(1), schema).columns == ["id", "place"]
    with pytest.raises(WideningError, match="id: int, declared bigint"):
        set_exact(spark.range(1).select(F.col("id").cast("int")), schema)


def test_widening_is_a_projection(spark):
    plan = upgrade_to(spark.range(5).select(F.col("id").cast("int")), parse("id double"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
