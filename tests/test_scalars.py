import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from paylake.functions.scalars import month_of, safe_cast_numeric, safe_parse_date

D = dt.date
DATES = [
    ("01/05/2023", D(2023, 1, 5)),
    ("1/5/2023", D(2023, 1, 5)),
    (" 01/05/2023 ", D(2023, 1, 5)),
    ("\t01/05/2023\n", D(2023, 1, 5)),
    ("02/29/2024", D(2024, 2, 29)),
    ("12/31/9999", D(9999, 12, 31)),
    ("02/29/2023", None),
    ("02/30/2023", None),
    ("13/01/2023", None),
    ("00/10/2023", None),
    ("04/31/2023", None),
    ("2023-01-05", None),
    ("01/05/23", D(23, 1, 5)),
    ("1/5/999", D(999, 1, 5)),
    ("01/05/", None),
    ("01/05/12023", None),
    ("001/05/2023", None),
    ("01/05/2023x", None),
    ("01 /05/2023", None),
    ("-1/05/2023", None),
    ("", None),
    ("   ", None),
    (None, None),
]
NUMBERS = [
    (12.5, "12.500000000"),
    (1.005, "1.005000000"),
    (-3.25, "-3.250000000"),
    (0.0, "0"),
    (1.0000000015, "1.000000002"),
    (9.9e28, "99000000000000000000000000000"),
    (1e30, None),
    (-1e30, None),
    (float("nan"), None),
    (float("inf"), None),
    (float("-inf"), None),
    (None, None),
]


def test_parse_date(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", safe_parse_date(F.col("t")).alias("d")).collect()}
    assert {DATES[i][0]: d for i, d in got.items()} == dict(DATES)


def test_parse_date_agrees_with_the_calendar(spark):
    rng = random.Random(3)
    texts = [
        f"{rng.randint(0, 14):0{rng.randint(1, 2)}}/{rng.randint(0, 33):0{rng.randint(1, 2)}}"
        f"/{rng.randint(1, 2999):04}"
        for _ in range(3000)
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got in df.select("t", safe_parse_date(F.col("t"))).collect():
        month, day, year = map(int, t.split("/"))
        try:
            want = D(year, month, day)
        except ValueError:
            want = None
        assert got == want, t


def test_cast_numeric(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(NUMBERS)], "i int, x double")
    rows = df.select("i", safe_cast_numeric(F.col("x")).alias("n"))
    assert rows.schema["n"].dataType.simpleString() == "decimal(38,9)"
    for r in rows.collect():
        want = NUMBERS[r.i][1]
        assert r.n == (None if want is None else Decimal(want))


def test_cast_numeric_rounds_the_shortest_text(spark):
    rng = random.Random(4)
    xs = [rng.uniform(-1e6, 1e6) * 10 ** rng.randint(-9, 3) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, got in df.select("x", safe_cast_numeric(F.col("x"))).collect():
        assert got == Decimal(repr(x)).quantize(Decimal("1e-9"), ROUND_HALF_UP)


@pytest.mark.parametrize("text,want", [("12.5", "12.5"), ("$1", None), ("", None), ("1e3", "1000")])
def test_cast_numeric_from_text(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(safe_cast_numeric(F.col("t"))).first()
    assert row[0] == (None if want is None else Decimal(want))


def test_month_is_a_date(spark):
    df = spark.createDataFrame([(D(2024, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(month_of(F.col("d"))).collect()] == [D(2024, 2, 1), None]
