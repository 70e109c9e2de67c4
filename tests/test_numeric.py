from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from vouch.functions.numeric import number_text, pct


def half_even(n: int, d: int, digits: int) -> float:
    if d == 0:
        return 0.0
    exact = Decimal(n) * 100 / Decimal(d)
    return float(exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_EVEN)) + 0.0


@pytest.mark.parametrize("digits,d", [(2, 800), (2, 4000), (1, 16), (1, 33), (2, 7)])
def test_pct_rounds_half_even(spark, digits, d):
    rows = spark.range(-d, d + 1).select("id", pct(F.col("id"), F.lit(d), digits).alias("p")).collect()
    assert {r.id: r.p for r in rows} == {n: half_even(n, d, digits) for n in range(-d, d + 1)}


def test_pct_known_values(spark):
    got = spark.range(1).select(
        pct(F.lit(5), F.lit(800), 2).alias("tie"),
        pct(F.lit(7), F.lit(0), 2).alias("nothing"),
        pct(F.lit(9 * 10**14), F.lit(9 * 10**14), 2).alias("large"),
        pct(F.lit(-1), F.lit(10**9), 2).alias("tiny"),
    ).first()
    assert (got.tie, got.nothing, got.large) == (0.62, 0.0, 100.0)
    assert str(got.tiny) == "0.0"


def test_number_text_is_plain_up_to_1e16(spark):
    numbers = [0.0, -0.0, 1.0, -999.0, 0.1, 0.0005, 0.00012, 1e7, 12345678.9, -98765432.125, 9007199254740991.0]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double").select("n", number_text(F.col("n")).alias("t"))
    assert [r.t for r in rows.collect()] == [str(n + 0.0) for n in numbers]


def test_number_text_survives_huge_numbers(spark):
    row = spark.sql("SELECT 1e300D AS n").select(number_text(F.col("n")).alias("t")).first()
    assert float(row.t) == 1e300
