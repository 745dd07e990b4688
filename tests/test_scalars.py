"""Scalar functions against plain models and the edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from thicket.functions import scalars as fn
from thicket.operators import aggregate, select, taxa


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (fn.to_int, "12.0", None), (fn.to_int, " 12 ", 12), (fn.to_int, "+5", 5), (fn.to_int, "", None), (fn.to_int, None, None), (fn.to_int, "99999999999999999999", None),
        (fn.parse_int, "12.9", 12), (fn.parse_int, "-12.9", -12), (fn.parse_int, "nan", None), (fn.parse_int, "inf", None), (fn.parse_int, " 7 ", 7), (fn.parse_int, "1e30", None),
        (fn.to_float, "1e3", 1000.0), (fn.to_float, "inf", float("inf")), (fn.to_float, "nan", None), (fn.to_float, "1.0d", None), (fn.to_float, "-2.5", -2.5), (fn.to_float, "", None),
        (fn.year_of, "20x4-01", 20), (fn.year_of, "", 0), (fn.year_of, None, None), (fn.month_of, "2021-07-01", 7), (fn.month_of, "2021", 0),
    ],
)
def test_numbers_in_text(spark, f, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0] == want


def bisect_cell(lat, lon, precision):
    """Halving of both axes, longitude first."""
    ranges, bits = [[-180.0, 180.0], [-90.0, 90.0]], 0
    for i in range(5 * precision):
        r, v = ranges[i % 2], (lon, lat)[i % 2]
        mid = (r[0] + r[1]) / 2
        bits = bits * 2 + (v >= mid)
        r[0 if v >= mid else 1] = mid
    return "".join(fn.GEOHASH_DIGITS[bits >> 5 * (precision - 1 - d) & 31] for d in range(precision))


@pytest.mark.parametrize("precision", [1, 4, 5, 8])
def test_geohash_equals_bisection(spark, precision):
    r = random.Random(precision)
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(2000)]
    points += [(k * 180 / 4096 - 90 + e, k * 360 / 8192 - 180 + e) for k in range(0, 4096, 7) for e in (0.0, -1e-13, 1e-13)]
    points += [(90.0, 180.0), (-90.0, -180.0), (91.0, 200.0), (-91.0, -200.0), (float("inf"), float("-inf")), (0.0, 0.0)]
    got = aggregate.with_cell(spark.createDataFrame(points, "lat double, lon double"), precision).collect()
    assert [g["cell"] for g in got] == [bisect_cell(*p, precision) for p in points]


def test_geohash_known_and_missing(spark):
    rows = aggregate.with_cell(spark.createDataFrame([(52.52, 13.405), (None, 1.0)], "lat double, lon double"), 5).collect()
    assert [r["cell"] for r in rows] == ["u33dc", None]


def test_month_and_last_obs(spark):
    df = spark.createDataFrame([(2020, 0), (2020, 13), (2020, 12), (None, 5)], "y int, m int")
    assert [r[0] for r in df.select(fn.valid_month(F.col("m"))).collect()] == [None, None, 12, 5]
    assert [r[0] and tuple(r[0]) for r in df.select(fn.last_obs(F.col("y"), F.col("m"))).collect()] == [(2020, None), (2020, 13), (2020, 12), None]


@pytest.mark.parametrize(("kind", "sure", "want"), [("EXACT", "80", True), ("exact", "79", False), ("HIGHERRANK", "90", True), ("HIGHERRANK", "89", False), ("FUZZY", "99", False), (None, "99", False), ("EXACT", "x", False)])
def test_acceptance(spark, kind, sure, want):
    assert spark.createDataFrame([(kind, sure)], "k string, c string").select(taxa.accepted(F.col("k"), F.col("c"))).first()[0] is want


@pytest.mark.parametrize(("state", "days", "want"), [("2026-01-01", 2, "2025-12-30"), ("2026-01-01", -3, "2026-01-01"), ("no date", 2, "2026-05-08"), (None, 0, "2026-05-10")])
def test_since(spark, state, days, want):
    df = spark.createDataFrame([(state,)], "s string")
    assert df.select(select.since(F.col("s"), days, F.to_date(F.lit("2026-05-10")))).first()[0] == want
