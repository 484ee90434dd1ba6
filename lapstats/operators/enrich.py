"""J2 enrich_dims: constant dimension lookups with defaults, as broadcast joins.

The dimension tables have a fixed handful of rows (see ``dims``), so broadcasting
them is safe at any fact-table size and the fact side is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims


def enrich_dims(df: DataFrame, circuit: str = "circuit", compound: str = "tire_compound",
                driver: str | None = "driver") -> DataFrame:
    """Adds degradation_rate (null if unknown), overtaking_difficulty and tire_wear
    (default 3), baseline_lap_time (default 88), safety_car_base (default 0.2),
    circuit_name, and driver_name (full name of the upper-cased code, else the input)."""
    spark = df.sparkSession
    comp = dims.compound_dim(spark).select(F.col("compound").alias("_cmp"), "degradation_rate")
    circ = dims.circuit_dim(spark).select(F.col("circuit").alias("_cir"), "overtaking_difficulty", "tire_wear",
                                          "baseline_lap_time", "safety_car_base",
                                          F.col("display_name").alias("circuit_name"))
    d = float(dims.DEFAULT_CHARACTERISTIC)
    out = (df.join(F.broadcast(comp), F.col(compound) == F.col("_cmp"), "left")
             .join(F.broadcast(circ), F.col(circuit) == F.col("_cir"), "left")
             .withColumns({
                 "overtaking_difficulty": F.coalesce("overtaking_difficulty", F.lit(d)),
                 "tire_wear": F.coalesce("tire_wear", F.lit(d)),
                 "baseline_lap_time": F.coalesce("baseline_lap_time", F.lit(dims.DEFAULT_BASELINE_LAP)),
                 "safety_car_base": F.coalesce("safety_car_base", F.lit(dims.DEFAULT_SAFETY_CAR)),
             }).drop("_cmp", "_cir"))
    if driver:
        drv = dims.driver_dim(spark).select(F.col("code").alias("_code"), "full_name")
        out = (out.join(F.broadcast(drv), F.upper(F.col(driver)) == F.col("_code"), "left")
                  .withColumn("driver_name", F.coalesce("full_name", F.col(driver))).drop("_code", "full_name"))
    return out
