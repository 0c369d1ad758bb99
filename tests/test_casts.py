"""P5: legacy cast semantics, golden values and parity with Spark's own
non-ANSI cast (the stream job's runtime behaviour)."""

import pytest
from pyspark.sql import functions as F

from habita.functions.casts import digits_only_int, legacy_float, legacy_int

INT_GOLDEN = [("3", 3), ("3.7", 3), (" 3 ", 3), ("3.", 3), ("1e3", None), ("", None),
              ("abc", None), ("45.5", 45), ("120 m2", None), ("99999999999", None),
              ("NaN", None), (".5", 0), ("+4", 4), ("-2", -2), (None, None)]
FLOAT_GOLDEN = [("3", 3.0), ("3.7", 3.7), (" 3 ", 3.0), ("1e3", 1000.0), ("", None), ("abc", None),
                ("45.5", 45.5), ("120 m2", None), (".5", 0.5), ("+4", 4.0), ("-2", -2.0), ("1f", 1.0)]


def test_legacy_int_golden(spark):
    df = spark.createDataFrame([(v,) for v, _ in INT_GOLDEN], "x string")
    got = [r[0] for r in df.select(legacy_int("x")).collect()]
    assert got == [e for _, e in INT_GOLDEN]


def test_legacy_float_golden(spark):
    df = spark.createDataFrame([(v,) for v, _ in FLOAT_GOLDEN], "x string")
    got = [r[0] for r in df.select(legacy_float("x")).collect()]
    for g, (_, e) in zip(got, FLOAT_GOLDEN):
        assert (g is None and e is None) or g == pytest.approx(e, rel=1e-6)


def test_legacy_int_matches_non_ansi_cast(spark):
    """Brute force against Spark's own legacy cast (ANSI off) on many strings."""
    values = ["3", "3.7", " 3 ", "3.", "1e3", "", "abc", "45.5", "+4", "-2", ".5", "-.5", "+.", ".",
              "\t7\n", "007", "2147483647", "2147483648", "-2147483648", "-2147483649", "1.2.3",
              "0x10", "1_000", " - 3", "3 4", "٣", "12abc", "+", "-", "3.0000", "-0", "1,5", "\f9\r"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    ours = [r[0] for r in df.select(legacy_int("x")).collect()]
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("x").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    mism = [(v, o, l) for v, o, l in zip(values, ours, legacy) if o != l]
    assert not mism, mism


def test_legacy_float_matches_non_ansi_cast(spark):
    values = ["1e3", "NaN", "Infinity", "-Infinity", "1f", "1d", " 2.5 ", "", "x", ".5", "5.",
              "99999999999", "1e39", "0x1p3", "+7", "1,5"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    ours = [r[0] for r in df.select(legacy_float("x")).collect()]
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("x").cast("float")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    same = lambda a, b: (a is None and b is None) or (a == b) or (a != a and b != b)
    mism = [(v, o, l) for v, o, l in zip(values, ours, legacy) if not same(o, l)]
    assert not mism, mism


def test_digits_only(spark):
    df = spark.createDataFrame([("45.5",), ("3 ch",), ("abc",), (None,)], "x string")
    assert [r[0] for r in df.select(digits_only_int("x")).collect()] == [455, 3, None, None]
