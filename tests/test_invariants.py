"""Invariants and agreement with plain loops on random small panels (hypothesis)."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lapstats.operators import panel
from lapstats.operators.ordering import row_index
from lapstats.plans import race as R

COMPOUNDS = ["SOFT", "MEDIUM", "HARD", None]

lap_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(1, 40), st.sampled_from(COMPOUNDS),
              st.one_of(st.none(), st.integers(1, 30)), st.one_of(st.none(), st.floats(60, 180))),
    min_size=1, max_size=60)

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    data = [(2023, "monza", d, lap, c, life, t, i) for i, (d, lap, c, life, t) in enumerate(rows)]
    return spark.createDataFrame(data, "year int, circuit string, driver string, lap_number int, compound string, "
                                       "tyre_life int, lap_time double, lap_id bigint")


def _rows(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


@settings(**SETTINGS)
@given(lap_rows)
def test_sequence_operators_match_a_plain_loop(spark, rows):
    df = _frame(spark, rows)
    by = {}
    for i, (d, lap, c, life, t) in enumerate(rows):
        by.setdefault(d, []).append((lap, i, c, life, t))
    pits, means, index, since = [], [], [], []
    for d, seq in by.items():
        seq.sort()
        stops = [b[0] for a, b in zip(seq, seq[1:]) if a[2] != b[2] or (a[3] is not None and b[3] is not None and b[3] < a[3])]
        pits += [(d, s) for s in stops]
        for k, (lap, i, *_, t) in enumerate(seq):
            vals = [x[4] for x in seq[max(0, k - 2):k + 1] if x[4] is not None]
            means.append((i, round(sum(vals) / len(vals), 6) if vals else None))
            index.append((i, k))
            since.append((i, lap - max([s for s in stops if s <= lap], default=lap)))
    found = panel.detect_pit_stops(df)
    assert _rows(found, ["driver", "pit_lap"]) == sorted(pits)
    got = {r.lap_id: r.r for r in panel.rolling_mean(df, 3, out="r").collect()}
    assert {k: v if v is None else round(v, 6) for k, v in got.items()} == dict(means)
    assert _rows(row_index(df, ["driver"], ["lap_number", "lap_id"]), ["lap_id", "_rn"]) == sorted(index)
    assert _rows(panel.laps_since_pit(df, found), ["lap_id", "laps_since_pit"]) == sorted(since)


def test_rolling_one_is_the_value(spark):
    df = _frame(spark, [("A", i, "SOFT", i, 80.0 + i, ) for i in range(1, 8)])
    r = panel.rolling_mean(df, 1, out="r").collect()
    assert all(x.r == x.lap_time for x in r)


def test_split_partitions_input(spark):
    df = _frame(spark, [("A", i, "SOFT", 1, 80.0) for i in range(1, 23)])
    out = panel.chronological_split(df).collect()
    test = [r for r in out if r.is_test]
    assert len(out) == 22 and len(test) == int(22 * 0.2)
    assert max(r.lap_number for r in out if not r.is_test) <= min(r.lap_number for r in test)


def test_label_codes_dense(spark):
    df = _frame(spark, [(d, i, c, 1, 80.0) for i, (d, c) in enumerate([("B", "HARD"), ("A", "SOFT"), ("C", "SOFT")])])
    m = panel.fit_label_mappings(df, ["driver", "compound"]).collect()
    codes = {}
    for r in m:
        codes.setdefault(r.column_name, {})[r.value] = r.code
    assert codes["driver"] == {"A": 0, "B": 1, "C": 2} and codes["compound"] == {"HARD": 0, "SOFT": 1}


@pytest.mark.parametrize("t", [30, 50, 70])
def test_plan_laps_cover_race(spark, t):
    races = spark.createDataFrame([(2023, "monza", t, 90.0)], "year int, circuit string, total_laps int, base_lap_time double")
    laps = R.expand_plan_laps(R.plan_grid(races))
    per = laps.groupBy("plan_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("lap_number").alias("d")).collect()
    assert per and all(r.n == t and r.d == t for r in per)
    grid = R.plan_grid(races).collect()
    assert all(len(g.compounds) == len(g.pit_laps) + 1 for g in grid)
