"""Constant dimension tables.

Every table here has a fixed, small size (at most a few dozen rows), so joining it
with ``broadcast`` is safe at any data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for matching results)
# ---------------------------------------------------------------------------
ANALYSIS_YEARS = [2021, 2022, 2023, 2024]
CIRCUITS = {
    "monaco": "Monaco Grand Prix",
    "silverstone": "British Grand Prix",
    "monza": "Italian Grand Prix",
    "spa": "Belgian Grand Prix",
    "suzuka": "Japanese Grand Prix",
}
COMPOUNDS = ["SOFT", "MEDIUM", "HARD"]
DEGRADATION_RATES = {"SOFT": 0.35, "MEDIUM": 0.25, "HARD": 0.15}
PIT_STOP_PENALTY = 25.0
MIN_LAP_TIME = 60.0
MAX_LAP_TIME = 180.0
MAX_STINT_LENGTH = 50
# circuit -> (overtaking_difficulty, tire_wear); default (3, 3)
CIRCUIT_CHARACTERISTICS = {
    "monaco": (5, 2),
    "silverstone": (2, 4),
    "monza": (1, 3),
    "spa": (2, 3),
    "suzuka": (3, 4),
}
DEFAULT_CHARACTERISTIC = 3
# circuit -> baseline lap time (s); default 88.0
CIRCUIT_BASELINE_LAP = {
    "silverstone": 88.0,
    "monaco": 72.0,
    "spa": 105.0,
    "monza": 81.0,
    "suzuka": 90.0,
    "interlagos": 70.0,
    "barcelona": 78.0,
}
DEFAULT_BASELINE_LAP = 88.0
# compound -> (base modifier s, degradation s/lap) of the lap-time fallback; default MEDIUM
COMPOUND_MODIFIERS = {"SOFT": (-0.8, 0.025), "MEDIUM": (0.0, 0.018), "HARD": (0.6, 0.010)}
# circuit -> safety-car base probability; default 0.2
SAFETY_CAR_BASE = {"monaco": 0.4, "silverstone": 0.2, "monza": 0.15, "spa": 0.25, "suzuka": 0.2}
DEFAULT_SAFETY_CAR = 0.2
# driver code -> full name
DRIVER_NAMES = {
    "MAX": "Max Verstappen", "PER": "Sergio Perez",
    "HAM": "Lewis Hamilton", "RUS": "George Russell",
    "LEC": "Charles Leclerc", "SAI": "Carlos Sainz",
    "NOR": "Lando Norris", "PIA": "Oscar Piastri",
    "ALO": "Fernando Alonso", "STR": "Lance Stroll",
}
# name-ending abbreviations restored to upper case by clean_driver_name, in check order
NAME_ABBREVIATIONS = ["Ver", "Ham", "Rus", "Lec", "Sai", "Nor", "Pia", "Alo", "Str", "Per"]
DEFAULT_RATE_UNKNOWN = 0.25   # tire advantage: unknown compound rate
DEFAULT_RATE_PLAN = 0.02      # plan costing: unknown compound rate
# ---------------------------------------------------------------------------


def compound_dim(spark: SparkSession) -> DataFrame:
    """compound, degradation_rate, compound_code (lexicographic), base_modifier, fallback_rate."""
    codes = {c: i for i, c in enumerate(sorted(COMPOUNDS))}
    rows = [(c, DEGRADATION_RATES[c], codes[c], COMPOUND_MODIFIERS[c][0], COMPOUND_MODIFIERS[c][1])
            for c in COMPOUNDS]
    return spark.createDataFrame(
        rows, "compound string, degradation_rate double, compound_code int, "
              "base_modifier double, fallback_rate double")


def circuit_dim(spark: SparkSession) -> DataFrame:
    """Every circuit any table knows, with its attributes (null where a table lacks it)."""
    names = sorted(set(CIRCUITS) | set(CIRCUIT_BASELINE_LAP) | set(SAFETY_CAR_BASE))
    rows = []
    for c in names:
        ch = CIRCUIT_CHARACTERISTICS.get(c)
        rows.append((c, CIRCUITS.get(c), float(ch[0]) if ch else None, float(ch[1]) if ch else None,
                     CIRCUIT_BASELINE_LAP.get(c), SAFETY_CAR_BASE.get(c)))
    return spark.createDataFrame(
        rows, "circuit string, display_name string, overtaking_difficulty double, "
              "tire_wear double, baseline_lap_time double, safety_car_base double")


def driver_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(DRIVER_NAMES.items()), "code string, full_name string")


def rate_expr(col, default=None):
    """Degradation rate of a compound column as a literal map lookup (no join)."""
    m = F.create_map(*[x for c in COMPOUNDS for x in (F.lit(c), F.lit(DEGRADATION_RATES[c]))])
    v = F.try_element_at(m, col)
    return v if default is None else F.coalesce(v, F.lit(float(default)))
