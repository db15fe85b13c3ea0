"""Decode rules, case by case and against a plain-Python decoder."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.decode import decode, split_pattern, undecodable
from tablegate.functions.encode import encode
from tablegate.sources.delimited import decode_lines
from tablegate.spec import TAB_SEPARATED, DelimitedFormat


def decoded(spark, texts, type_name):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    dtype = T.DataType.fromDDL(type_name)
    rows = frame.select(
        "i",
        decode(F.col("t"), dtype, TAB_SEPARATED).alias("v"),
        undecodable(F.col("t"), dtype, TAB_SEPARATED).alias("bad"),
    ).collect()
    rows = sorted(rows)
    return [r.v for r in rows], [r.bad for r in rows]


def test_boolean(spark):
    good = ["true", "TRUE", "tRuE", "false", "FALSE", "fAlSe"]
    bad = ["true ", " true", "false ", " false", "t", "f", "blah", "true\n", "fal\u017fe", "1"]
    values, flags = decoded(spark, good + bad + ["", "\\N", None], "boolean")
    assert values == [True] * 3 + [False] * 3 + [None] * (len(bad) + 3)
    assert flags == [False] * 6 + [True] * len(bad) + [False] * 3


INTEGER_TEXTS = [
    "1", "12", "123", "-1", "-12", "-123", "+1", "+12", "+123", "0", "-0", "+0", "007",
    "127", "128", "-128", "-129", "32767", "32768", "-32768", "-32769",
    "2147483647", "2147483648", "-2147483648", "-2147483649",
    "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
    "x", "-", "+", "1.5", "1e3", "1L", " 1", "1 ", "\t1", "1\x7f", "\x7f1", "1\x1f", "--1", "+-1",
    "0x10", "1,000", "\u0661", "", "\\N", None,
]


@pytest.mark.parametrize(
    ("type_name", "bits"), [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)]
)
def test_integers(spark, type_name, bits):
    def expected(text):
        if text is None or not re.fullmatch(r"[+-]?[0-9]+", text):
            return None
        value = int(text)
        return value if -(2 ** (bits - 1)) <= value < 2 ** (bits - 1) else None

    values, flags = decoded(spark, INTEGER_TEXTS, type_name)
    assert values == [expected(t) for t in INTEGER_TEXTS]
    has_text = [t not in (None, "", "\\N") for t in INTEGER_TEXTS]
    assert flags == [h and v is None for h, v in zip(has_text, values, strict=True)]


def test_double(spark):
    good = {
        "1": 1.0, "-1": -1.0, "+1": 1.0, "12.34": 12.34, "-12.34": -12.34, "+12.34": 12.34,
        "1.2e5": 1.2e5, "1.2e-5": 1.2e-5, "-1.2E5": -1.2e5, ".5": 0.5, "-.5": -0.5, "5.": 5.0,
        "Infinity": math.inf, "+Infinity": math.inf, "-Infinity": -math.inf,
        "1.7976931348623157E308": 1.7976931348623157e308, "4.9E-324": 5e-324,
        "-1.7976931348623157E308": -1.7976931348623157e308, "1e999": math.inf, " 1.5": 1.5,
    }
    bad = ["x", "-", "1e", "inf", "-inf", "nan", "NAN", "infinity", "INFINITY", "1,5", "1..2"]
    values, flags = decoded(spark, [*good, *bad, "", "\\N", None], "double")
    assert values[: len(good)] == list(good.values())
    assert values[len(good) :] == [None] * (len(bad) + 3)
    assert flags == [False] * len(good) + [True] * len(bad) + [False] * 3
    values, _ = decoded(spark, ["NaN", "-NaN"], "double")
    assert all(math.isnan(v) for v in values)


def test_float(spark):
    values, _ = decoded(spark, ["1.1", "-2.5", "x", ""], "float")
    assert values[0] == pytest.approx(1.1) and values[1:] == [-2.5, None, None]


def test_string(spark):
    values, flags = decoded(spark, ["foo", "", "\\N", " a ", "\u00fcber", None], "string")
    assert values == ["foo", "", None, " a ", "\u00fcber", None]
    assert not any(flags)


def test_list(spark):
    values, flags = decoded(
        spark, ["1,2,3", "", "\\N", "5", "1,\\N,3", "1,x", "1,,2"], "array<bigint>"
    )
    assert values == [[1, 2, 3], [], None, [5], [1, None, 3], [1, None], [1, None, 2]]
    assert flags == [False, False, False, False, False, True, False]


def test_map(spark):
    texts = ["foo:1.5,bar:2.5", "", "\\N", "a", "a:1,a:2", "a:b:c", "\\N:1,b:2"]
    values, flags = decoded(spark, texts, "map<string,double>")
    assert values == [
        {"foo": 1.5, "bar": 2.5}, {}, None, {"a": None}, {"a": 1.0}, {"a": None}, {"b": 2.0},
    ]
    assert flags == [False, False, False, False, False, True, False]


def test_map_with_typed_keys(spark):
    values, _ = decoded(spark, ["1:x,2:y", "z:x,2:y"], "map<int,string>")
    assert values == [{1: "x", 2: "y"}, {2: "y"}]


def test_struct(spark):
    values, flags = decoded(spark, ["1,foo", "1", "\\N", "x,y", ""], "struct<a:int,b:string>")
    assert [tuple(v) if v else v for v in values] == [
        (1, "foo"), (1, None), None, (None, "y"), (None, None),
    ]
    assert flags == [False, False, False, True, False]


def test_nested_collections_use_deeper_separators(spark):
    frame = spark.createDataFrame([("a\x032\x043\x02b\x03",)], "t string")
    dtype = T.DataType.fromDDL("map<string,array<int>>")
    row = frame.select(decode(F.col("t"), dtype, DelimitedFormat()).alias("v")).first()
    assert row.v == {"a": [2, 3], "b": []}
    with pytest.raises(ValueError, match="nesting level"):
        decode(F.col("t"), T.DataType.fromDDL("array<array<array<int>>>"), TAB_SEPARATED)


@pytest.mark.parametrize("separator", list(".$|()[{^?*+\\") + ["\x01", "\t", ",", "a", "]", "}"])
def test_every_separator_is_literal(spark, separator):
    frame = spark.createDataFrame([(f"1{separator}{separator}3{separator}",)], "value string")
    schema = T.DataType.fromDDL("a int, b string, c int, d string, e int")
    rows = decode_lines(frame, schema, DelimitedFormat(separators=(separator,)))
    assert tuple(rows.first()) == (1, "", 3, "", None)
    assert len(split_pattern(separator)) <= 2


def test_columns_in_a_new_order_and_short_rows(spark):
    lines = ["1\tx\t2.5", "2", "", "3\ty", "4\tz\t1.5\tsurplus"]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    schema = T.DataType.fromDDL("a int, b string, c double")
    rows = decode_lines(frame, schema, TAB_SEPARATED, ("c", "a"))
    assert rows.columns == ["c", "a"]
    assert {tuple(r) for r in rows.collect()} == {
        (2.5, 1), (None, 2), (None, None), (None, 3), (1.5, 4),
    }
    first_two = decode_lines(frame, schema, TAB_SEPARATED, ("b",))
    assert sorted(r.b or "" for r in first_two.collect()) == ["", "", "x", "y", "z"]


def test_bad_values_are_counted_in_the_same_pass(spark):
    lines = ["1\t2", "x\t3", "4\t", "\\N\ty", "6"]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    seen = Observation()
    rows = decode_lines(
        frame, T.DataType.fromDDL("a int, b int"), TAB_SEPARATED, observation=seen
    )
    assert rows.columns == ["a", "b"]
    rows.collect()
    assert seen.get == {"rows": 5, "a_nulls": 2, "a_bad": 1, "b_nulls": 3, "b_bad": 1}


def test_bad_value_can_fail_the_job(spark):
    frame = spark.createDataFrame([("1\t2",), ("x\t3",)], "value string")
    schema = T.DataType.fromDDL("a int, b int")
    with pytest.raises(Exception, match="column a: cannot decode x"):
        decode_lines(frame, schema, TAB_SEPARATED, on_bad="fail").collect()
    only_b = decode_lines(frame, schema, TAB_SEPARATED, ("b",), on_bad="fail")
    assert sorted(r.b for r in only_b.collect()) == [2, 3]


def test_unknown_modes_are_refused(spark):
    frame = spark.createDataFrame([("1",)], "value string")
    schema = T.DataType.fromDDL("a int")
    with pytest.raises(ValueError, match="parse mode"):
        decode_lines(frame, schema, TAB_SEPARATED, parse_mode="other")
    with pytest.raises(ValueError, match="on_bad"):
        decode_lines(frame, schema, TAB_SEPARATED, on_bad="other")


def test_random_lines_match_a_plain_decoder(spark):
    rng = random.Random(7)
    pieces = ["1", "-2", "+3", "x", "", "\\N", "4.5", "true", "FALSE", " 7", "300", "a,b", "NaN"]
    lines = [
        "\t".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(2000)
    ]

    def integer(text, bits):
        if text is None or not re.fullmatch(r"[+-]?[0-9]+", text):
            return None
        return int(text) if -(2 ** (bits - 1)) <= int(text) < 2 ** (bits - 1) else None

    def boolean(text):
        return {"true": True, "false": False}.get(text.lower()) if text is not None else None

    def items(text):
        if text is None or text == "\\N":
            return None
        return text.split(",") if text else []

    def plain(line):
        fields = line.split("\t") + [None] * 5
        return (
            integer(fields[0], 8), integer(fields[1], 64), boolean(fields[2]),
            None if fields[3] == "\\N" else fields[3],
            None if fields[4] is None or fields[4] == "\\N" else
            tuple(None if i == "\\N" else i for i in items(fields[4])),
        )

    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    schema = T.DataType.fromDDL("a tinyint, b bigint, c boolean, d string, e array<string>")
    rows = decode_lines(frame, schema, TAB_SEPARATED).collect()
    got = [(r.a, r.b, r.c, r.d, None if r.e is None else tuple(r.e)) for r in rows]
    assert sorted(map(repr, got)) == sorted(repr(plain(line)) for line in lines)


def test_decoding_stays_in_generated_code(spark, tmp_path):
    spark.createDataFrame([("1\tx",)], "value string").write.text(str(tmp_path / "t"))
    rows = decode_lines(
        spark.read.text(str(tmp_path / "t")),
        T.DataType.fromDDL("a int, b string"),
        TAB_SEPARATED,
    )
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and plan.startswith("*(1)")


SAME = [
    ("array<string>", [[], ["", ""], ["a"], ["", None], None]),
    ("array<int>", [[], [1], [None, None], [1, None], None]),
    ("array<array<int>>", [[], [[], []], [[1], []], None]),
    ("map<string,int>", [{}, {"": 1}, {"a": None}, None]),
    ("struct<s:string>", [("",), ("a",), None]),
    ("struct<s:string,i:int>", [(None, None), ("", 1), None]),
    ("array<struct<s:string,i:int>>", [[], [(None, None)], [("", 1)], None]),
]
OTHER = [
    ("array<string>", [""]), ("array<string>", [None]), ("array<int>", [None]), ("array<array<int>>", [[]]),
    ("array<array<int>>", [[1], [None]]), ("struct<i:int>", (None,)), ("struct<s:string>", (None,)),
    ("struct<a:array<int>>", ([None],)),
]


@pytest.mark.parametrize(("kind", "values"), SAME)
def test_guarded_collections_read_back_as_they_were(spark, kind, values):
    dtype = T.DataType.fromDDL(kind)
    frame = spark.createDataFrame([(v,) for v in values], T.StructType().add("v", dtype))
    fmt = DelimitedFormat()
    back = frame.select("v", encode(F.col("v"), dtype, fmt).alias("t")).select("v", decode(F.col("t"), dtype, fmt).alias("w"))
    for row in back.collect():
        assert row["v"] == row["w"]


@pytest.mark.parametrize(("kind", "value"), OTHER)
def test_collections_that_would_read_back_as_others_are_refused(spark, kind, value):
    dtype = T.DataType.fromDDL(kind)
    frame = spark.createDataFrame([(value,)], T.StructType().add("v", dtype))
    with pytest.raises(Exception, match="another value"):
        frame.select(encode(F.col("v"), dtype, DelimitedFormat())).collect()
    assert frame.select(encode(F.col("v"), dtype, DelimitedFormat(), guard=False)).count() == 1
