"""Physical-plan properties of the headline queries, on the plan that every size gets."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
CHECK = ["validate_laps", "engineer_features", "detect_pit_stops", "laps_since_pit", "pit_windows_for_state",
         "recommend_plans", "optimize_plans", "chronological_split", "percentile_stats_lineitem"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECK)
def test_stays_in_the_jvm(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups"):
        assert node not in p


@pytest.mark.parametrize("name", CHECK)
def test_no_window_of_facts_over_one_partition(spark, name):
    """A window in a single partition stands only on the block summary: one row per block."""
    lines = _plan(E.queries()[name](spark, SF)).splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            below = lines[i + 1:]
            k = next(n for n, x in enumerate(below) if "Exchange" in x)
            if "SinglePartition" in below[k]:
                under = next(x for x in below[k + 1:] if re.search(r"Aggregate|Scan|Join|Window", x))
                assert "Aggregate" in under and "_block" in under, under[:300]


def test_scan_prunes_columns(spark):
    p = _plan(E.queries()["percentile_stats_lineitem"](spark, SF))
    assert "l_shipdate" not in p.split("ReadSchema")[1].split("\n")[0]


def test_global_prefix_is_the_rank(spark):
    from pyspark.sql import functions as F
    from lapstats.operators.ordering import global_prefix
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    got = global_prefix(df, ["k"], out="pos").collect()
    assert all(r.pos == r.k for r in got) and len(got) == 5000


def test_checkpoint_folder_is_required_and_never_replaced(spark):
    from lapstats import session

    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    before = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().get() == before

    class None_:
        def isDefined(self):
            return False

    class Fake:     # a session without any folder
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                @staticmethod
                def sc():
                    class S:
                        @staticmethod
                        def getCheckpointDir():
                            return None_()
                    return S()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Fake)
    with pytest.raises(ValueError):
        session.local_scratch(Fake)
