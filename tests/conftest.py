import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from lapstats.session import local_scratch
    s = (SparkSession.builder.master("local[*]").appName("lapstats-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    local_scratch(s)
    yield s
    s.stop()


@pytest.fixture()
def sample(spark):
    """Nine laps of three drivers: one far outlier, one lap under another track status."""
    rows = [
        (91.4, "HARD", 4, 1, "NOR", "1", 5, 2022, "spa", 11),
        (92.0, "HARD", 5, 1, "NOR", "1", 6, 2022, "spa", 12),
        (90.7, "SOFT", 1, 2, "NOR", "1", 7, 2022, "spa", 13),
        (168.0, "SOFT", 2, 2, "NOR", "1", 8, 2022, "spa", 14),
        (93.1, "MEDIUM", 9, 1, "ALO", "1", 5, 2022, "spa", 15),
        (93.6, "MEDIUM", 10, 1, "ALO", "1", 6, 2022, "spa", 16),
        (92.8, "MEDIUM", 11, 1, "ALO", "4", 7, 2022, "spa", 17),
        (91.9, "SOFT", 3, 1, "GAS", "1", 5, 2022, "spa", 18),
        (92.2, "SOFT", 4, 1, "GAS", "1", 6, 2022, "spa", 19),
    ]
    return spark.createDataFrame(rows, "lap_time double, compound string, tyre_life int, stint int, driver string, "
                                       "track_status string, lap_number int, year int, circuit string, lap_id bigint")
