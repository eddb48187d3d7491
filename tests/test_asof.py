import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.asof import join_nearest, rank_nearest

HISTORY = [
    ("EUR", date(2024, 6, 1), Decimal("1.077000")),
    ("EUR", date(2024, 9, 15), Decimal("1.105900")),
    ("GBP", date(2024, 6, 1), Decimal("1.264100")),
]
TYPES = "currency string, rate_date date, rate decimal(18,6)"


def nearest(history, currency, day):
    """Latest on or before, else earliest later."""
    dated = sorted((d, v) for c, d, v in history if c == currency)
    past = [v for d, v in dated if d <= day] if day else []
    return past[-1] if past else (dated[0][1] if dated and day else None)


def joined(spark, lines, history):
    left = spark.createDataFrame(lines, "id long, currency string, day date")
    right = spark.createDataFrame(history, TYPES)
    out = join_nearest(left, right, "currency", F.col("day"), "rate_date", "rate", ["id"])
    return {r.id: r.rate for r in out.collect()}


@pytest.mark.parametrize(
    "currency, day, expected",
    [
        ("EUR", date(2024, 9, 14), "1.077000"),  # the nearer rate is later: the past one wins
        ("EUR", date(2024, 9, 15), "1.105900"),  # on the rate's own day
        ("EUR", date(2024, 7, 24), "1.077000"),  # same distance to both
        ("EUR", date(2023, 1, 1), "1.077000"),  # before all rates
        ("EUR", date(2030, 1, 1), "1.105900"),
        ("GBP", date(2024, 12, 31), "1.264100"),  # this currency's history ends earlier
        ("XYZ", date(2024, 7, 1), None),
        (None, date(2024, 7, 1), None),
        ("EUR", None, None),
    ],
)
def test_single_days(spark, currency, day, expected):
    found = joined(spark, [(1, currency, day)], HISTORY)
    assert found == {1: expected and Decimal(expected)}


def test_two_values_for_one_day_take_the_smaller(spark):
    twice = [*HISTORY, ("EUR", date(2024, 6, 1), Decimal("0.500000"))]
    assert joined(spark, [(1, "EUR", date(2024, 6, 2))], twice) == {1: Decimal("0.500000")}


def test_no_history(spark):
    assert joined(spark, [(1, "EUR", date(2024, 6, 2))], []) == {1: None}


def random_case(seed):
    rng = random.Random(seed)
    start = date(2024, 1, 1)
    history = {
        (rng.choice("ABC"), start + timedelta(rng.randrange(300))): Decimal(rng.randrange(10**6))
        for _ in range(40)
    }
    history = [(c, d, v / 1000) for (c, d), v in history.items()]
    # one currency owns most of the lines
    lines = [
        (i, rng.choice("AAAAAABCD"), start + timedelta(rng.randrange(-100, 400)))
        for i in range(2000)
    ]
    return lines, history


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_search(spark, seed):
    lines, history = random_case(seed)
    assert joined(spark, lines, history) == {i: nearest(history, c, d) for i, c, d in lines}


def test_same_as_search_without_broadcast(spark, force_shuffle):
    lines, history = random_case(3)
    assert joined(spark, lines, history) == {i: nearest(history, c, d) for i, c, d in lines}


def test_ranked_form_agrees(spark):
    lines, history = random_case(4)
    days = spark.createDataFrame([(c, d) for _, c, d in lines], "currency string, day date")
    rates = spark.createDataFrame(history, TYPES)
    ranked = rank_nearest(days, rates, "currency", "day", "rate_date", "rate").collect()
    assert len(ranked) == len({(c, d) for _, c, d in lines if c != "D"})
    by_day = {(c, d): (d2, v) for c, d2, v in history for d in [d2]}
    for r in ranked:
        assert r.rate == nearest(history, r.currency, r.day)
        past = [d for c, d in by_day if c == r.currency and d <= r.day]
        assert r.is_future == (0 if past else 1)
