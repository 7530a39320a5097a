import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingmill.functions import exprs

GRAMMAR = [
    (None, None), ("", None), ("-", None), ("--", None), (" - ", None), ("—", None), ("n/a", None), ("100", "100"), ("1,234.50", "1234.50"), ("(1,234.50)", "-1234.50"), ("( 12 )", "12"), ("(-100)", "-100"),
    ("-7.10", "-7.10"), ("12%", "12"), ("1 234", "1"), ("- 100", "100"), (".5", "5"), ("（100）", "100"), ("１２", "12"), ("1,234,567元", "1234567"), ("(5)万", "5"), ("Note 5", "5"), ("000.0", "0.0"), ("1.2.3", "1.2"), ("9" * 40, None),
]


def test_decimal_grammar(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(GRAMMAR)], "i int, raw string")
    got = {r["i"]: r["v"] for r in df.select("i", exprs.parse_decimal("raw").alias("v")).collect()}
    for i, (raw, want) in enumerate(GRAMMAR):
        assert got[i] == (None if want is None else Decimal(want)), raw


def model(raw):
    text = raw.strip().replace(",", "")
    if text in ("", "-", "--"):
        return None
    if text.startswith("(") and text.endswith(")"):
        text = "-" + text[1:-1]
    found = re.search(r"-?\d+(?:\.\d+)?", text)
    return Decimal(found[0]) if found else None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.,()- %x　", max_size=9), min_size=30, max_size=60))
def test_decimal_grammar_equals_a_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    got = {r["i"]: r["v"] for r in df.select("i", exprs.parse_decimal("raw").alias("v")).collect()}
    for i, t in enumerate(texts):
        want = model(t)
        assert got[i] == (None if want is None else want.quantize(Decimal("0.000001"))), t


@pytest.mark.parametrize(("diff", "lhs", "want"), [("2", "0", True), ("3", "0", False), ("-3", "0", False), ("1004", "10000000", False), ("1000", "10000000", True), ("-1000", "-10000000", True), ("2.000001", "1", False)])
def test_tolerance_is_exact(spark, diff, lhs, want):
    df = spark.sql(f"select cast('{diff}' as decimal(38,6)) d, cast('{lhs}' as decimal(38,6)) l")
    assert df.select(exprs.within_tolerance("d", "l", Decimal(2), Decimal("0.0001"))).first()[0] is want


def test_text_rules(spark):
    df = spark.createDataFrame([("  A　 b\tC ",), ("",), (None,), ("　",)], "t string")
    assert [r[0] for r in df.select(exprs.normalized_text("t")).collect()] == ["A b C", None, None, None]
    assert [r[0] for r in df.select(exprs.label("t")).collect()] == ["a b c", "", None, ""]
    text = df.select(exprs.decimal_text(F.lit("100500").cast("decimal(38,6)"), F.lit(2)), exprs.decimal_text(F.lit("5.25").cast("decimal(38,6)"), F.lit(0))).first()
    assert tuple(text) == ("100500.00", "5")
    js = spark.sql("select map('b', 'é', 'a', '1') m").select(exprs.sorted_json("m")).first()[0]
    assert js == '{"a":"1","b":"é"}'


def test_first_match_in_order_and_by_length(spark):
    df = spark.createDataFrame([("单位：人民币万元",), ("none",), (None,)], "t string")
    groups = (("1", ("元",)), ("10000", ("万元",)))
    first, longest = exprs.first_match("t", groups), exprs.first_match("t", groups, True)
    got = [tuple(r) for r in df.select(*first, *longest).collect()]
    assert got == [("1", "元", "10000", "万元"), (None,) * 4, (None,) * 4]
