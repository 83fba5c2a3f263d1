import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from veilspark.functions.hashing import person_hash
from veilspark.functions.parsing import date_sql, float_sql, int_sql, render_sql, shift_sql

CELLS = {
    # text: (as Int64, as float)
    "12": (12, 12.0),
    " 12 ": (12, 12.0),
    "+7": (7, 7.0),
    "-999": (-999, -999.0),
    "12.0": (12, 12.0),
    "1e3": (1000, 1000.0),
    "12.5": (None, 12.5),
    ".5": (None, 0.5),
    "5.": (5, 5.0),
    "9007199254740993": (9007199254740993, 9007199254740992.0),
    "99999999999999999999": (None, 1e20),
    "1e300": (None, 1e300),
    "1e999": (None, None),
    "1d": (None, None),
    "1f": (None, None),
    "0x1F": (None, None),
    "1,000": (None, None),
    "inf": (None, None),
    "nan": (None, None),
    "": (None, None),
    "x": (None, None),
    None: (None, None),
}


def test_numbers(spark):
    rows = spark.createDataFrame([(text,) for text in CELLS], "cell string")
    got = rows.selectExpr("cell", int_sql("cell"), float_sql("cell")).collect()
    assert {row[0]: (row[1], row[2]) for row in got} == CELLS


@pytest.mark.parametrize(
    "text, day",
    [
        ("20210228", datetime.date(2021, 2, 28)),
        ("20210230", None),
        ("2021011", None),
        ("2021-01-01", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, day):
    row = spark.createDataFrame([(text,)], "cell string").selectExpr(date_sql("cell"))
    assert row.first()[0] == day


@pytest.mark.parametrize(
    "text, days, moved",
    [
        ("20210101", 3.7, "20210104"),
        ("20210101", -0.5, "20201231"),
        ("0", 1.0, "00000000"),
        ("20210230", 1.0, ""),
        ("", 1.0, ""),
        ("20210101", None, ""),
    ],
)
def test_shifted_dates(spark, text, days, moved):
    row = spark.createDataFrame([(text, days)], "cell string, days double")
    assert row.selectExpr(shift_sql("cell", "days")).first()[0] == moved


@pytest.mark.parametrize(
    "value, kind, text",
    [(45.0, "double", "45"), (45.5, "double", "45.5"), (float("nan"), "double", None),
     (float("inf"), "double", None), (7, "bigint", "7"), (datetime.date(2021, 3, 4), "date", "20210304")],
)
def test_rendering(spark, value, kind, text):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.selectExpr(render_sql("v", df.schema["v"].dataType)).first()[0] == text


def test_known_hash(spark):
    """The value follows from SHA-256 of the joined text alone."""
    import hashlib

    row = spark.createDataFrame([("홍길동", "8001011234567", "T1")], "n string, s string, t string")
    want = hashlib.sha256("홍길동8001011234567T1".encode()).hexdigest().upper()
    assert row.select(person_hash(F.col("n"), F.col("s"), F.col("t"))).first()[0] == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**14), 10**14), min_size=1, max_size=50))
def test_integers_survive(spark, numbers):
    df = spark.createDataFrame([(str(n),) for n in numbers], "cell string")
    parsed = df.selectExpr(f"{int_sql('cell')} AS v")
    back = parsed.selectExpr(render_sql("v", T.LongType())).collect()
    assert [row[0] for row in back] == [str(n) for n in numbers]


def test_doubles_are_plain_decimals(spark):
    import random
    from decimal import Decimal

    rng = random.Random(4)
    values = [12345678.9, 0.00012, -0.00012, 1e-7, 0.1, 100.5, -99999999.99, 1e16, 123456789012345678.0, 2.5e-19, 1e37, 5e15 + 0.5]
    values += [rng.choice((1, -1)) * rng.random() * 10 ** rng.randint(-15, 15) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double").selectExpr("v", render_sql("v", T.DoubleType()) + " AS text")
    for row in df.collect():
        assert "E" not in row.text.upper() and not (("." in row.text) and row.text.endswith("0"))
        assert Decimal(row.text) == Decimal(repr(row.v)), (row.v, row.text)
