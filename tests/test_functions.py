"""Golden rows for the scalar column functions."""

import uuid

from pyspark.sql import functions as F

from tollgate.functions import text as T
from tollgate.functions import variant as V
from tollgate.functions.address import build_address
from tollgate.functions.ids import uuid5_url
from tollgate.operators.contracts import missing_fields


def one_col(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def test_nested_get(spark):
    docs = [
        '{"ship": {"crew": {"cook": "Ilse"}}}',
        '{"ship": {"crew": {"mate": "Jo"}}}',
        '{"ship": {"crew": null}}',
        '{"ship": [1]}',
        '{"ship": {"crew": {"cook": {"tools": [{"knife": "blunt"}]}}}}',
    ]
    out = one_col(spark, docs, lambda c: V.nested(V.parse_body(c), "ship", "crew", "cook", default="nobody"))
    assert out == ["Ilse", "nobody", "nobody", "nobody", '{"tools":[{"knife":"blunt"}]}']
    tool = one_col(spark, docs, lambda c: V.nested(V.parse_body(c), "ship", "crew", "cook", "tools", 0, "knife"))
    assert tool == [None, None, None, None, "blunt"]


def test_text_after_a_json_value_is_no_json(spark):
    docs = ['{"a":1}', ' {"a":1}\n', '{"a":1} junk', '{"a":1}] x', '{"a":1}} x', '{"a":1}, 2', '{"a":1},"b":2', "5", "5 5", "", None, "[1]", "[1],"]
    out = one_col(spark, docs, lambda c: V.parse_body(c).isNotNull())
    assert out == [True, True, False, False, False, False, False, True, False, False, False, True, False]


def test_py_text_of_json_values(spark):
    docs = ['{"v": 12345}', '{"v": true}', '{"v": "x"}', '{"v": null}', '{}']
    out = one_col(spark, docs, lambda c: V.py_text(V.get(V.parse_body(c), "v")))
    assert out == ["12345", "True", "x", None, None]


def test_clean_string(spark):
    vals = [None, "\t tin whistle\n", " \r\n ", "é" * 300, "　a b\x1c\n", "​keep​"]
    assert one_col(spark, vals, lambda c: T.clean_string(c)) == ["", "tin whistle", "", "é" * 300, "a b", "​keep​"]
    assert one_col(spark, vals[:2], lambda c: T.clean_string(c, "none given")) == ["none given", "tin whistle"]
    assert one_col(spark, vals[3:4], lambda c: T.clean_string(c, max_length=37)) == ["é" * 37]
    assert one_col(spark, vals[1:2], lambda c: T.clean_string(c, strip=False)) == vals[1:2]
    assert one_col(spark, vals[1:2], lambda c: T.clean_string(c, max_length=3)) == ["tin"]
    # every character Python strips is stripped, nothing else
    ws = T.PY_WHITESPACE
    s = ws + "a" + ws
    assert one_col(spark, [s], lambda c: T.clean_string(c)) == [s.strip()]


def test_clean_email_and_gender(spark):
    assert one_col(spark, ["\tIlse.V@Mail.EXAMPLE ", None], T.clean_email) == ["ilse.v@mail.example", ""]
    assert one_col(spark, ["MALE", "Female", "unknown", "other", None], T.normalize_gender) == [
        "male", "female", "other", "other", None
    ]


def test_is_email_python_dollar(spark):
    vals = ["a@b.co", "a@b.co\n", "a@b.co\r", "a@b.co ", "not-an-email", "x@y.c"]
    assert one_col(spark, vals, T.is_email) == [True, True, False, False, False, False]


def test_is_uuid(spark):
    vals = ["7b1c3f52-9d0e-4a86-8c55-2e90f1d4a6b3", "7B1C3F52-9D0E-4A86-8C55-2E90F1D4A6B3", "no-uuid-here", "x" * 36]
    assert one_col(spark, vals, T.is_uuid) == [True, True, False, False]


def test_uuid5_matches_python(spark):
    names = ["ilse.v@mail.example:2011-11-30T19:02:09.000Z", ":", "ö@ü.example:1", ""]
    out = one_col(spark, names, uuid5_url)
    assert out == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_build_address(spark):
    locs = [
        '{"street": {"number": 86, "name": "Zoutsloot"}, "city": "Harlingen", "state": "Friesland", "country": "Netherlands", "postcode": "8861 KL"}',
        '{"street": {"number": 0, "name": ""}, "city": "", "state": "Friesland", "country": "Netherlands", "postcode": "8861 KL"}',
        '{"street": {"number": 7, "name": "  Grüner Weg "}, "city": "Köln", "state": "", "country": "DE", "postcode": 50667}',
        '{"street": {"number": 1, "name": "A"}, "city": "C", "postcode": null}',
        "{}",
    ]
    out = one_col(spark, locs, lambda c: build_address(V.parse_body(c)))
    assert out == [
        "86 Zoutsloot, Harlingen 8861 KL, Friesland, Netherlands",
        "Friesland, Netherlands",
        "7   Grüner Weg, Köln 50667, DE",
        "1 A, C",
        "",
    ]


def test_missing_fields(spark):
    df = spark.createDataFrame([("x", None, "  "), ("", "y", "z")], "a string, b string, c string")
    out = [r[0] for r in df.select(missing_fields({"a": F.col("a"), "b": F.col("b"), "c": F.col("c")})).collect()]
    assert out == [["b", "c"], ["a"]]


def test_error_text(spark):
    df = spark.createDataFrame([("Server error: 500", 500, None, None), ("Bad", None, "email", "v" * 80)],
                               "m string, s int, f string, v string")
    http = [r[0] for r in df.select(T.error_text(F.col("m"), status=F.col("s"))).collect()]
    assert http == ["Server error: 500 [HTTP 500]", "Bad"]
    fv = [r[0] for r in df.select(T.error_text(F.col("m"), field=F.col("f"), value=F.col("v"), value_chars=50)).collect()]
    assert fv == ["Server error: 500", "Bad [field=email] [value=" + "v" * 50 + "]"]


def test_py_list_repr(spark):
    df = spark.createDataFrame([(["Response is not a dictionary"],), (["Missing 'results' key in response"],),
                                (["it's \"both\""],)], "a array<string>")
    out = [r[0] for r in df.select(T.py_list_repr(F.col("a"))).collect()]
    assert out == [repr(["Response is not a dictionary"]), repr(["Missing 'results' key in response"]),
                   repr(["it's \"both\""])]
