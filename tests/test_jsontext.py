import pytest
from pyspark.sql import functions as F

from relaylog.functions import jsontext as J

OBJECTS = [
    "{}",
    " {} ",
    '{"a":1}',
    '{"a":null}',
    '{"a":1,"a":2}',
    '{"a":{"b":[1,2,{"c":-1.50e3}]}}',
    '{"a":"x|"}',
    '{"a":"|5"}',
    '{"a":true , "b" : [ ]}',
    '{"a":"a\\"b\\\\"}',
    '{"1":2,"true":3}',
    '{"a":1}\n',
]
NOT_OBJECTS = [
    "", "  ", "null", "[]", "[{}]", "1", '"x"', "{", '{"a":1', '{"a":01}', '{"a":NaN}', "{'a':1}", "{a:1}", '{"a":"x\ny"}',
    '{"a":1}x', '{"a":1} 7', '{"a":1}{"x":1}', '{"a":1},{"x":1}', '{"a":1}],[', '{"a":1}},{"x":1', '{"a":1},"b":2',
    "{1:2}", "{true:1}", "{null :1}", '{"a":1,}', '{"a":.5}', '{"a":1.}', '{"a":+1}', '{"a":1e}', '{"a":--1}', '{"a":1 2}',
    '{"a" 1}', '{"a":"\\x"}', '{"a":tru}', '{"a":nullx}', '{"a":1},0],[{"b":1}', '{"a":1},{"z":0}],[{"q":1}',
    '{"a":"b""c"}', '{"a":1}/*x*/', "﻿{}", '{"a":0x10}', '{"a":Infinity}', '{"a":-Infinity}', '{"a":"abc}',
]


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def test_single_object(spark):
    got = column(spark, OBJECTS + NOT_OBJECTS, J.is_single_object)
    assert dict(zip(OBJECTS + NOT_OBJECTS, got)) == {**dict.fromkeys(OBJECTS, True), **dict.fromkeys(NOT_OBJECTS, False)}
    parsed = column(
        spark,
        OBJECTS + NOT_OBJECTS,
        lambda t: J.single_object(J.parse_single_object(J.mark_scalars(t), ["a"])).isNotNull(),
    )
    assert parsed == got


@pytest.mark.parametrize("text", ["1", '"x"', "null", "[1]", "{}", " true "])
def test_json_values(spark, text):
    assert column(spark, [text, text + " 1", text + "]"], J.is_json_value) == [True, False, False]


def test_raw_members_keep_digits_and_kinds(spark):
    text = '{"f":1.50e3,"n":-0.0,"s":"5","t":true,"z":null,"o":{"k":[1.0,"|2",null]},"f":-1.2300e-2,"e":"","p":"a|\\"b"}'
    (got,) = column(spark, [text], J.raw_members)
    assert {k: tuple(v) for k, v in got.items()} == {
        "f": ("number", "-1.2300e-2"),
        "n": ("number", "-0.0"),
        "s": ("string", "5"),
        "t": ("boolean", "true"),
        "z": ("null", "null"),
        "o": ("object", '{"k":[1.0,"|2",null]}'),
        "e": ("string", ""),
        "p": ("string", 'a|"b'),
    }
    assert column(spark, ["[1]", "{"], J.raw_members) == [None, None]


def test_long_texts(spark):
    text = '{"a":"' + "\\n" * 100_000 + '","c":"' + "y" * 500_000 + '","d":[' + ",".join(["1.0"] * 20_000) + "]}"
    (got,) = column(spark, [text], lambda t: F.length(J.raw_members(t)["d"]["text"]))
    assert got == 20_000 * 4 + 1


def test_members_agree_with_single_object(spark):
    got = column(spark, OBJECTS + NOT_OBJECTS, lambda t: J.members_of(t).isNotNull())
    assert got == [True] * len(OBJECTS) + [False] * len(NOT_OBJECTS)
