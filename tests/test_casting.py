"""Text parsing: the null policy equals Spark's lenient cast under either ANSI flag."""

import math

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftlayer.functions import parse_text

TYPES = ("int", "bigint", "double", "timestamp")

EDGES = [
    None, "", " ", "abc", "n/a", "1", "1.0", ".5", ".", "+.", "-", "-.5", "+1.", "-3.9", "2.7",
    " 7 ", "\t8\n", "1.5e2", "1e2", "1.2.3", "1. 0", "3000000000", "3000000000.5",
    "2147483647.9", "2147483648", "-2147483648.9", "-2147483649", "9223372036854775807.5",
    "9223372036854775808", "\xa07", "１", "0x1", "0x1p3", "1_0", "1d", "1f", "NaN", "nan",
    "Infinity", "-inf", "+Infinity", "infinit", "1.x", "+-1", "00012.00", "\x017\x01", "7\x7f",
    "2024-01-06 06:00:00", "2024-01-06T06:00:00Z", "2024-01-06", "2024-1-6 6:0:0", "2024-13-01",
    "2024-02-30", "2024-01-06 06:00:00.123456789", "2024-01-06 06:00:00 Europe/Paris",
    "2024-01-06 06:00:00+02:00", " 2024-01-06 06:00 ", "2024", "2024-01", "+2024-01-06",
    "-0001-01-01", "bad", "20240106", "01/06/2024", "2024-01-06 24:00:00", "2024-01-06 00:00:00x",
]


def _values(spark, texts, read):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    # instants as numbers: Python has no dates before the year 1
    *others, moment = (read(F.col("text"), t) for t in TYPES)
    rows = df.select(*others, F.unix_micros(moment)).collect()
    return [
        ["NaN" if isinstance(v, float) and math.isnan(v) else v for v in row] for row in rows
    ]


def _check(spark, ansi, texts):
    ansi(False)
    lenient = _values(spark, texts, lambda text, t: text.cast(t))
    for flag in (True, False):
        ansi(flag)
        ours = _values(spark, texts, parse_text)
        assert list(zip(texts, ours)) == list(zip(texts, lenient))


def test_edges_equal_the_lenient_cast(spark, ansi):
    _check(spark, ansi, EDGES)


_NUMBERISH = st.text(alphabet="0123456789.+-eEdfxinaNT:/ \t\x7f", max_size=12)
_DATEISH = st.from_regex(r"\A ?[0-9]{1,5}-[0-9]{1,2}(-[0-9]{1,2}([ T][0-9:.]{0,12}Z?)?)?\Z")


@settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.one_of(_NUMBERISH, _DATEISH, st.text(max_size=6)), min_size=200, max_size=400))
def test_any_text_equals_the_lenient_cast(spark, ansi, texts):
    # a bare time of day means today, which may change between two queries
    texts = [t for t in texts if "\ud800" > max(t, default="") and ":" not in t[:4]]
    _check(spark, ansi, texts)


@pytest.mark.parametrize("flag", [True, False])
def test_fail_policy_stops_whatever_the_session_says(spark, ansi, flag):
    ansi(flag)
    good = spark.createDataFrame([("1.0",), (None,)], "n string")
    strict = parse_text(F.col("n"), "int", "fail", "n")
    assert [r[0] for r in good.select(strict).collect()] == [1, None]
    bad = spark.createDataFrame([("one",)], "n string")
    with pytest.raises(Exception, match="n: cannot read as int: one"):
        bad.select(strict).collect()


def test_unknown_policy_and_type_are_refused(spark):
    with pytest.raises(ValueError, match="on_error"):
        parse_text(F.col("n"), "int", "ignore")
    with pytest.raises(ValueError, match="no text parser"):
        parse_text(F.col("n"), "decimal(10,2)")
    assert str(parse_text(F.col("n"), "string")) == str(F.col("n"))
