"""Scalar operators (F1-F23) as native Column expressions.

Every function takes and returns ``Column``s, so it runs inside whole-stage codegen
(array higher-order functions are interpreted but still JVM-side); no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def _lookup(table: dict, key: Column, default=None) -> Column:
    m = F.create_map(*[v for k, val in table.items() for v in (F.lit(k), F.lit(val))])
    v = F.try_element_at(m, key)
    return v if default is None else F.coalesce(v, F.lit(default))


def fixed(x, decimals: int, int_digits: int = 1) -> Column:
    """``%.{decimals}f``-style text rounded on the exact binary value, as Python and C
    format it (``format_string`` rounds the shortest decimal form half-up instead, D6)."""
    pattern = "0" * int_digits + ("." + "0" * decimals if decimals else "")
    return F.call_function("format_number", _c(x), F.lit(pattern))


# F1 -------------------------------------------------------------------------
def parse_lap_time(text) -> Column:
    """``m:ss.sss`` -> m*60+s; no colon -> number; anything else (incl. 3+ parts, D7) -> null."""
    t = _c(text)
    parts = F.split(t, ":")
    mins = parts.getItem(0).try_cast("double")
    secs = parts.getItem(1).try_cast("double")
    return F.when(t.contains(":"), F.when(F.size(parts) == 2, mins * 60 + secs)) \
            .otherwise(F.trim(t).try_cast("double"))


# F2 -------------------------------------------------------------------------
def format_lap_time(seconds) -> Column:
    """``M:SS.mmm`` (minutes unpadded, seconds zero-padded to 6 chars)."""
    s = _c(seconds)
    return F.when(s.isNotNull(), F.concat(F.floor(s / 60).cast("int").cast("string"), F.lit(":"),
                                          fixed(s % 60, 3, 2)))


# F3 -------------------------------------------------------------------------
def format_time_delta(seconds) -> Column:
    s = _c(seconds)
    return (F.when(s.isNull(), F.lit(None).cast("string")).when(s == 0, F.lit("0.00s"))
             .when(s < 60, F.concat(fixed(s, 2), F.lit("s")))
             .when(s < 3600, F.concat(F.floor(s / 60).cast("int").cast("string"), F.lit("m "),
                                      fixed(s % 60, 2), F.lit("s")))
             .otherwise(F.concat(F.floor(s / 3600).cast("int").cast("string"), F.lit("h "),
                                 F.floor((s % 3600) / 60).cast("int").cast("string"), F.lit("m "),
                                 fixed(s % 60, 2), F.lit("s"))))


# F4 -------------------------------------------------------------------------
def title_case(text) -> Column:
    """Python ``str.title``: upper-case a letter after a non-letter, lower-case the rest."""
    chars = F.split(_c(text), "")
    is_letter = lambda ch: ch.rlike("^\\p{L}$")
    out = F.transform(chars, lambda ch, i: F.when(
        (i == 0) | ~is_letter(F.get(chars, i - 1)), F.upper(ch)).otherwise(F.lower(ch)))
    return F.array_join(out, "")


def clean_driver_name(name) -> Column:
    """Empty/null -> 'Unknown'; strip whitespace; title case; if the name ends with a
    known abbreviation, upper-case every occurrence of it (first match wins)."""
    n = _c(name)
    stripped = F.regexp_replace(n, "^\\s+|\\s+$", "")
    t = title_case(stripped)
    res = None
    for ab in dims.NAME_ABBREVIATIONS:
        cond = t.endswith(ab)
        val = F.replace(t, F.lit(ab), F.lit(ab.upper()))
        res = F.when(cond, val) if res is None else res.when(cond, val)
    res = res.otherwise(t)
    return F.when(n.isNull() | (n == ""), F.lit("Unknown")).otherwise(res)


# F5 / F9 / J2 lookups --------------------------------------------------------
def driver_full_name(code) -> Column:
    """Full name of an upper-cased driver code; unknown codes return the input."""
    c = _c(code)
    return F.coalesce(_lookup(dims.DRIVER_NAMES, F.upper(c)), c)


def overtaking_difficulty(circuit) -> Column:
    return _lookup({k: float(v[0]) for k, v in dims.CIRCUIT_CHARACTERISTICS.items()}, _c(circuit),
                   float(dims.DEFAULT_CHARACTERISTIC))


def circuit_baseline(circuit) -> Column:
    return _lookup(dims.CIRCUIT_BASELINE_LAP, _c(circuit), dims.DEFAULT_BASELINE_LAP)


def degradation_rate(compound, default=None) -> Column:
    return _lookup(dims.DEGRADATION_RATES, _c(compound), default)


# F6-F8 ----------------------------------------------------------------------
def time_gap(t1, t2, n=1) -> Column:
    return (_c(t1) - _c(t2)) * _c(n)


def fuel_adjusted_lap_time(base, fuel_kg) -> Column:
    return _c(base) + _c(fuel_kg) * 0.03


def track_position_value(position, total_cars=20) -> Column:
    n = _c(total_cars)
    return F.greatest(F.lit(0.0), (n - _c(position) + 1) / n)


# F10 ------------------------------------------------------------------------
def safety_car_probability(lap, total_laps, circuit) -> Column:
    """Circuit base probability x1.5 past 80% distance, x0.7 before 20%; at most 1.
    A zero race length gives null (the reference raises)."""
    base = _lookup(dims.SAFETY_CAR_BASE, _c(circuit), dims.DEFAULT_SAFETY_CAR)
    prog = F.try_divide(_c(lap).cast("double"), _c(total_laps).cast("double"))
    p = F.when(prog > 0.8, base * 1.5).when(prog < 0.2, base * 0.7).otherwise(base)
    return F.when(prog.isNotNull(), F.least(F.lit(1.0), p))


# F11 ------------------------------------------------------------------------
def championship_impact(positions_gained) -> Column:
    """Truncated ``positions x 2.0``."""
    return (_c(positions_gained) * 2.0).cast("int")


# F12 ------------------------------------------------------------------------
def tire_advantage(current_compound, new_compound, remaining_laps) -> Column:
    half = _c(remaining_laps) / 2
    return half * degradation_rate(current_compound, dims.DEFAULT_RATE_UNKNOWN) - \
        half * degradation_rate(new_compound, dims.DEFAULT_RATE_UNKNOWN)


# F13 ------------------------------------------------------------------------
def stint_band(rate) -> Column:
    r = _c(rate)
    return F.when(r <= 0.2, "25-30 laps").when(r <= 0.3, "15-25 laps").otherwise("10-15 laps")


def performance_at(rate, laps) -> Column:
    """Text ``90 + laps x rate`` with one decimal, e.g. ``93.5s``."""
    return F.concat(fixed(F.lit(90.0) + _c(laps) * _c(rate), 1), F.lit("s"))


# F14 ------------------------------------------------------------------------
def window_confidence(compound, current_lap, total_laps, position) -> Column:
    rem = _c(total_laps) - _c(current_lap)
    c = F.lit(0.8) + F.when(_c(compound) == "MEDIUM", 0.1) \
        .when((_c(compound) == "SOFT") & (rem < 15), 0.1).otherwise(0.0)
    c = c - F.when(_c(position) <= 5, 0.1).otherwise(0.0) - F.when(rem < 10, 0.2).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


# F15 ------------------------------------------------------------------------
def static_position_loss() -> Column:
    """``int(pit penalty / 1.0 s per place)``: 25 for every state."""
    return F.lit(int(dims.PIT_STOP_PENALTY / 1.0))


# F16 ------------------------------------------------------------------------
def plan_confidence(pit_laps, total_laps) -> Column:
    p, t = _c(pit_laps), _c(total_laps)
    n = F.size(p)
    base = F.lit(0.7) + F.when(n == 1, 0.2).when(n > 2, -0.2).otherwise(0.0)
    adj = lambda lap: F.when(t - lap < 5, -0.3).when(t - lap > t * 0.8, -0.1).otherwise(0.0)
    # plans of one or two stops (the common case) in plain expressions; longer ones fold
    short = F.when(n == 1, F.lit(0.0) + adj(F.get(p, 0))) \
             .otherwise(F.lit(0.0) + adj(F.get(p, 0)) + adj(F.get(p, 1)))
    per = F.when(n <= 2, short).otherwise(F.aggregate(p, F.lit(0.0), lambda acc, lap: acc + adj(lap)))
    return F.when(n == 0, F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), base + per)))


# F17 ------------------------------------------------------------------------
def plan_risk(pit_laps, compounds_in, total_laps) -> Column:
    """LOW / MEDIUM / HIGH from: SOFT fitted with > 20 laps left, each stop with < 5
    laps left, more than two stops."""
    p, c, t = _c(pit_laps), _c(compounds_in), _c(total_laps)
    n = F.size(p)
    one = lambda i: (F.when((F.get(c, i) == "SOFT") & (t - F.get(p, i) > 20), 1).otherwise(0)
                     + F.when(t - F.get(p, i) < 5, 1).otherwise(0))
    z = F.arrays_zip(p.alias("lap"), c.alias("cin"))
    soft = F.size(F.filter(z, lambda s: (s["cin"] == "SOFT") & (t - s["lap"] > 20)))
    late = F.size(F.filter(p, lambda lap: t - lap < 5))
    # one or two stops in plain expressions; longer plans use the array filters
    k = F.when(n == 0, F.lit(0)).when(n == 1, one(0)).when(n == 2, one(0) + one(1)) \
         .otherwise(soft + late + 1)
    return F.when(k == 0, "LOW").when(k <= 2, "MEDIUM").otherwise("HIGH")


# F18 ------------------------------------------------------------------------
def incident_benefit(pit_laps, sc_lap) -> Column:
    p, sc = _c(pit_laps), _c(sc_lap)
    s = F.aggregate(p, F.lit(0.0), lambda acc, lap: acc + F.when(F.abs(lap - sc) <= 3, 1.0)
                    .when(F.abs(lap - sc) <= 6, 0.5).otherwise(0.0))
    return F.when(F.size(p) == 0, F.lit(0.0)).otherwise(s / F.size(p))


# F19 ------------------------------------------------------------------------
# The advice texts are output values.
RECOMMENDATIONS = {
    "none": "Consider pitting during safety car period",
    "near": "Strategy well-positioned for safety car",
    "advance": "Consider advancing pit stop to safety car period",
    "delay": "Consider delaying pit stop if safety car extends",
}


def incident_recommendation(pit_laps, sc_lap) -> Column:
    p, sc = _c(pit_laps), _c(sc_lap)
    idx = F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1)))
    nearest = F.array_min(F.transform(F.arrays_zip(p.alias("lap"), F.slice(idx, 1, F.size(p)).alias("i")),
                                      lambda s: F.struct(F.abs(s["lap"] - sc).alias("d"), s["i"].alias("i"),
                                                         s["lap"].alias("lap"))))
    return (F.when(F.size(p) == 0, F.lit(RECOMMENDATIONS["none"]))
             .when(nearest["d"] <= 2, F.lit(RECOMMENDATIONS["near"]))
             .when(nearest["lap"] > sc + 5, F.lit(RECOMMENDATIONS["advance"]))
             .otherwise(F.lit(RECOMMENDATIONS["delay"])))


# F20 ------------------------------------------------------------------------
def evaluation_confidence(safety_car_risk, track_position_risk, n_history) -> Column:
    c = F.lit(0.7) - _c(safety_car_risk) * 0.2 - _c(track_position_risk) * 0.15 + \
        F.least(F.lit(0.1), _c(n_history) / 1000)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


# F21 ------------------------------------------------------------------------
def plan_score(total_time) -> Column:
    return F.lit(1000.0) - _c(total_time) / 60


def plan_description(plan_type, n_stops) -> Column:
    words = title_case(F.regexp_replace(_c(plan_type), "_", " "))
    return F.concat(words, F.lit(" strategy with "), _c(n_stops).cast("string"), F.lit(" pit stop(s)"))


# F22 ------------------------------------------------------------------------
def pit_traffic_loss(pit_time, position) -> Column:
    """Deterministic part of the places lost in a stop (the random 0/1 term is omitted)."""
    base = F.greatest(F.lit(1), (_c(pit_time) / 8).cast("int"))
    pos = _c(position)
    adj = F.when(pos <= 5, base + 1).when(pos >= 15, F.greatest(F.lit(1), base - 1)).otherwise(base)
    return F.least(F.lit(5), adj)


# F23 ------------------------------------------------------------------------
def baseline_lap_time(circuit, compound, tire_age) -> Column:
    """Circuit base + compound modifier + age x compound rate (MEDIUM for unknown);
    the random variation of the fallback is omitted."""
    mod = _lookup({k: v[0] for k, v in dims.COMPOUND_MODIFIERS.items()}, _c(compound),
                  dims.COMPOUND_MODIFIERS["MEDIUM"][0])
    rate = _lookup({k: v[1] for k, v in dims.COMPOUND_MODIFIERS.items()}, _c(compound),
                   dims.COMPOUND_MODIFIERS["MEDIUM"][1])
    return circuit_baseline(circuit) + mod + _c(tire_age) * rate
