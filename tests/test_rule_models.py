"""Scalar rules against plain-Python models over exhaustive / random inputs."""

import calendar
import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wellmart.functions.semantics import add_months_ts, month_boundaries
from wellmart.plans.well_test import rate_fill


def model_rates(state, duration, oil, gas, water, t_oil, t_gas, t_water):
    s = (state or "").rstrip().upper()
    la = s == "LOUISIANA"
    mt_tx = s in ("MONTANA", "TEXAS") and duration is not None and duration.upper().startswith("24")
    if la and oil is None:
        o = t_oil
    elif mt_tx and oil is None:
        o = t_oil
    elif oil is None and gas is not None:
        o = 0.0
    else:
        o = oil
    if la and gas is None:
        g = t_gas
    elif mt_tx and gas is None:
        g = t_gas
    elif oil is not None and gas is None:
        g = 0.0
    else:
        g = gas
    if la and water is None:
        w = t_water
    elif mt_tx and water is None:
        w = t_water
    elif water is None and oil is not None and gas is not None:
        w = 0.0
    else:
        w = water
    return o, g, w


def test_rate_fill_all_combinations(spark):
    states = ["Louisiana", "LOUISIANA ", "montana", "Texas", "Oklahoma", None]
    durations = ["24 HRS", "24", "12 HRS", None]
    vals = [None, 5.0]
    rows = [(s, d, o, g, w, 1.0, 2.0, 3.0)
            for s, d, o, g, w in itertools.product(states, durations, vals, [None, 6.0], [None, 7.0])]
    df = spark.createDataFrame(rows, "s string, d string, o double, g double, w double, to double, tg double, tw double")
    c = F.col
    oil, gas, water = rate_fill(c("s"), c("d"), c("o"), c("g"), c("w"), c("to"), c("tg"), c("tw"))
    got = df.select(oil.cast("double"), gas.cast("double"), water.cast("double")).collect()
    assert [tuple(r) for r in got] == [model_rates(*r) for r in rows]


def model_add_months(d: dt.datetime, n: int) -> dt.datetime:
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return d.replace(year=y, month=m, day=min(d.day, calendar.monthrange(y, m)[1]))


DATES = st.datetimes(min_value=dt.datetime(1950, 1, 1), max_value=dt.datetime(2030, 12, 31))


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(DATES, DATES), min_size=1, max_size=20))
def test_month_arithmetic_matches_model(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(month_boundaries("a", "b"), add_months_ts("a", 1), add_months_ts("a", -1)).collect()
    for (a, b), r in zip(pairs, got):
        assert r[0] == (b.year - a.year) * 12 + b.month - a.month
        assert r[1] == model_add_months(a, 1) and r[2] == model_add_months(a, -1)
