"""Panel (session x entity x sequence) operators: W1-W9, J1, P10-P13.

Sequence operators work on (group, block) partitions (``ordering.Ordered``): a panel group
with more than a partition's share of the rows is cut into blocks along its order, ordinary
windows run inside a block, and what a window would see before the block is carried in from a
small summary table. Anything keyed by a session, a circuit or a compound is an aggregate
joined back, its most frequent keys apart (``ordering.with_heavy``). Keys match null-safely
throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..staging import stage
from .ordering import Ordered, global_prefix, key_at, row_index, split_join
from .quantiles import exact_quantiles

PANEL = ("year", "circuit", "driver")
SESSION = ("year", "circuit")
FEATURES = [
    "tire_age", "tire_compound_encoded", "circuit_encoded", "driver_encoded",
    "lap_number", "position", "gap_to_leader", "tire_degradation_rate",
    "stint_length", "laps_since_pit", "rolling_avg_lap_time_3", "rolling_avg_lap_time_5",
    "position_change", "relative_performance",
]
TARGET = "lap_time"


def _order(df: DataFrame, seq: str, tie: str | None) -> list[str]:
    return [seq] + ([tie] if tie and tie in df.columns else [])


# W1 -------------------------------------------------------------------------
def detect_pit_stops(laps: DataFrame, keys: Sequence[str] = PANEL, seq: str = "lap_number",
                     compound: str = "compound", life: str = "tyre_life",
                     tie: str | None = "lap_id") -> DataFrame:
    """A lap (not an entity's first) is a stop when the compound changes or the tyre
    life drops. Null-safe (D1): null->null is no change, null<->value is one.
    Output: keys, pit_lap, pit_time (25.0), tire_compound_out, tire_compound_in."""
    order, cols = _order(laps, seq, tie), [compound, life, seq]
    need = list(dict.fromkeys([*keys, *cols, *order]))
    src = Ordered(laps.select(*need), keys, order).carry(tail=cols)
    x = src.rows.select(*keys, F.col(seq).alias("pit_lap"), F.col(compound).alias("tire_compound_in"),
                        F.col(life).alias("_t"), src.previous(*cols).alias("_p"))
    x = x.withColumn("tire_compound_out", F.col("_p")[compound])
    stop = F.col("_p")[seq].isNotNull() & (
        ~F.col("tire_compound_in").eqNullSafe(F.col("tire_compound_out"))
        | F.coalesce(F.col("_t") < F.col("_p")[life], F.lit(False)))
    return x.where(stop).select(*keys, F.col("pit_lap").cast("int").alias("pit_lap"),
                                F.lit(dims.PIT_STOP_PENALTY).alias("pit_time"),
                                "tire_compound_out", "tire_compound_in")


# P10 + W2 -------------------------------------------------------------------
def default_position_gap(df: DataFrame, median: float | None = None) -> DataFrame:
    """position: absent -> 10, null -> 20. gap_to_leader: absent -> position*0.5,
    null -> exact median of the column over the whole input (one-row broadcast), or
    ``median`` where one was fitted elsewhere."""
    if "position" not in df.columns:
        df = df.withColumn("position", F.lit(10.0))
    df = df.withColumn("position", F.coalesce(F.col("position").cast("double"), F.lit(20.0)))
    if "gap_to_leader" not in df.columns:
        return df.withColumn("gap_to_leader", F.col("position") * 0.5)
    if median is not None:
        return df.withColumn("gap_to_leader", F.coalesce(F.col("gap_to_leader"), F.lit(median)))
    med = exact_quantiles(df, "gap_to_leader", [0.5], ["_gap_median"])
    return (df.crossJoin(F.broadcast(med))
              .withColumn("gap_to_leader", F.coalesce(F.col("gap_to_leader"), F.col("_gap_median")))
              .drop("_gap_median"))


def position_change(df: DataFrame, keys: Sequence[str] = PANEL, seq: str = "lap_number",
                    tie: str | None = "lap_id") -> DataFrame:
    """position - previous position within the entity's session; first lap -> 0."""
    x = Ordered(df, keys, _order(df, seq, tie)).carry(tail=["position"])
    x.rows = x.rows.withColumn("position_change", _position_change(x))
    return x.done()


def _position_change(x: Ordered) -> Column:
    return F.coalesce(F.col("position") - x.previous("position")["position"], F.lit(0.0))


# W3 -------------------------------------------------------------------------
def rolling_mean(df: DataFrame, n: int, col: str = "lap_time", out: str | None = None,
                 keys: Sequence[str] = PANEL, seq: str = "lap_number", tie: str | None = "lap_id",
                 include_current: bool = True) -> DataFrame:
    """Mean of the last ``n`` rows (shorter at the start). ``include_current=False``
    uses the ``n`` rows before the current one (no target leakage, D11)."""
    x = Ordered(df, keys, _order(df, seq, tie)).carry(tail=[col], tail_rows=n)
    x.rows = x.rows.withColumn(out or f"rolling_avg_{col}_{n}", x.mean_of_last(col, n, include_current))
    return x.done()


# W4 -------------------------------------------------------------------------
def stint_ages(df: DataFrame, keys: Sequence[str] = PANEL, compound: str = "tire_compound",
               age: str = "tire_age") -> DataFrame:
    """Per (entity, session, compound): maximum tyre age and number of laps (``_laps``)."""
    return df.groupBy(*keys, compound).agg(F.max(age).alias("stint_length"), F.count(F.lit(1)).alias("_laps"))


def stint_length(df: DataFrame, keys: Sequence[str] = PANEL, compound: str = "tire_compound",
                 age: str = "tire_age") -> DataFrame:
    """Max tyre age per (entity, session, compound): two stints on one compound merge."""
    return split_join(df, stint_ages(df, keys, compound, age), [*keys, compound], rows="_laps")


# W5 -------------------------------------------------------------------------
def session_lap_means(df: DataFrame, by: Sequence[str] = (*SESSION, "lap_number"),
                      col: str = "lap_time") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(col).alias("_session_avg"), F.count(F.lit(1)).alias("_laps"))


def relative_performance(df: DataFrame, by: Sequence[str] = (*SESSION, "lap_number"),
                         col: str = "lap_time", means: DataFrame | None = None) -> DataFrame:
    """value / mean(value) of the same session lap; the mean table is an aggregate
    joined back (one row per session lap) rather than a window over the session.
    ``means`` may be computed earlier from the same rows (``session_lap_means``)."""
    m = means if means is not None else session_lap_means(df, by, col)
    return (split_join(df, m, list(by), rows="_laps")
              .withColumn("relative_performance", F.col(col) / F.col("_session_avg"))
              .drop("_session_avg"))


# J1 -------------------------------------------------------------------------
def with_pits(laps: DataFrame, pits: DataFrame, keys: Sequence[str], seq: str, pit_seq: str) -> DataFrame:
    """Laps (``_kind`` 1) and stops (``_kind`` 0, their lap in ``_pit``) in one frame."""
    l = laps.withColumn("_kind", F.lit(1)).withColumn("_pit", F.lit(None).cast("int"))
    p = pits.select(*keys, F.col(pit_seq).cast(laps.schema[seq].dataType).alias(seq),
                    F.lit(0).alias("_kind"), F.col(pit_seq).cast("int").alias("_pit"))
    return l.unionByName(p, allowMissingColumns=True)


def _since_pit(x: Ordered, seq: str) -> Column:
    last = x.running_max("_pit", "_last_pit")
    return F.coalesce(F.col(seq) - last, F.lit(0)).cast("int")


def laps_since_pit(laps: DataFrame, pits: DataFrame | None, keys: Sequence[str] = PANEL,
                   seq: str = "lap_number", pit_seq: str = "pit_lap",
                   tie: str | None = "lap_id") -> DataFrame:
    """As-of join: ``seq - max(pit_seq <= seq)`` within the entity's session, 0 if none.

    Pits and laps are unioned and a running maximum carries the last pit lap forward (pits
    sort before laps on the same lap), so there is no range join (D2: largest earlier pit
    wins, not table order). The laps alone tell where heavy groups are cut; ties of a lap
    number are cut by ``tie``."""
    if pits is None:
        return laps.withColumn("laps_since_pit", F.lit(0))
    order = [seq, "_kind", *_order(laps, seq, tie)[1:]]
    x = Ordered(with_pits(laps, pits, keys, seq, pit_seq), keys, order, like=laps.withColumn("_kind", F.lit(1)))
    x.carry(maxima={"_last_pit": F.col("_pit")})
    x.rows = x.rows.withColumn("laps_since_pit", _since_pit(x, seq)).where(F.col("_kind") == 1)
    return x.done("_kind", "_pit", "_last_pit")


# P11 ------------------------------------------------------------------------
def predicted_degradation(df: DataFrame, compound: str = "tire_compound",
                          age: str = "tire_age") -> DataFrame:
    """Rate of the compound (null if unknown) and age x rate."""
    rate = dims.rate_expr(F.col(compound))
    return (df.withColumn("tire_degradation_rate", rate)
              .withColumn("predicted_degradation", F.col(age) * F.col("tire_degradation_rate")))


# J2 (circuit part) ----------------------------------------------------------
def circuit_features(df: DataFrame) -> DataFrame:
    """overtaking_difficulty and tire_wear per circuit, default 3 (literal map lookup)."""
    od = F.create_map(*[x for c, v in dims.CIRCUIT_CHARACTERISTICS.items()
                        for x in (F.lit(c), F.lit(float(v[0])))])
    tw = F.create_map(*[x for c, v in dims.CIRCUIT_CHARACTERISTICS.items()
                        for x in (F.lit(c), F.lit(float(v[1])))])
    d = float(dims.DEFAULT_CHARACTERISTIC)
    return (df.withColumn("overtaking_difficulty", F.coalesce(F.try_element_at(od, F.col("circuit")), F.lit(d)))
              .withColumn("tire_wear", F.coalesce(F.try_element_at(tw, F.col("circuit")), F.lit(d))))


# W6 -------------------------------------------------------------------------
def fit_label_mappings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, code): per column, lexicographic codes 0..k-1 over the
    distinct non-null values.

    A code is the value's position in its column (``row_index``), which cuts a column with more
    than a partition's share of the values, so a high-cardinality column never lands in one task."""
    # one pass over the input: every (column, value) pair, then distinct, kept in the shared
    # folder: the order of the values is sampled and summed over their table, not the input
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                for c in cols])).alias("_p")
    d = stage(df.select(pairs).select("_p.*").where(F.col("value").isNotNull()).distinct(), "values")
    return row_index(d, ["column_name"], ["value"], "code").select("column_name", "value", F.col("code").cast("int"))


def fit_label_mapping(df: DataFrame, col: str) -> DataFrame:
    """(value, code) for one column; see ``fit_label_mappings``."""
    return fit_label_mappings(df, [col]).select("value", "code")


def extend_label_mapping(mapping: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """Append unseen values after the existing codes, in sorted order (D3)."""
    new = (df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
             .join(mapping.select("value"), "value", "left_anti"))
    top = mapping.agg(F.coalesce(F.max("code") + 1, F.lit(0)).alias("_base"))
    ranked = global_prefix(new, ["value"], out="_r")
    added = ranked.crossJoin(F.broadcast(top)).select(
        "value", (F.col("_base") + F.col("_r")).cast("int").alias("code"))
    return mapping.select("value", "code").unionByName(added)


def apply_label_mapping(df: DataFrame, mapping: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Join the codes on; the most frequent values are apart (``ordering.with_heavy``)."""
    m = mapping.select(F.col("value").alias("_lk"), F.col("code").alias(out or f"{col}_encoded"))
    return split_join(df.withColumn("_lk", F.col(col).cast("string")), m, ["_lk"]).drop("_lk")


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return apply_label_mapping(df, fit_label_mapping(df, col), col, out)


# P13 ------------------------------------------------------------------------
def one_hot_compound(df: DataFrame, col: str = "tire_compound") -> DataFrame:
    return df.withColumns({f"compound_{c}": (F.col(col) == F.lit(c)).cast("int") for c in dims.COMPOUNDS})


# P12 ------------------------------------------------------------------------
def select_features(df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Available features + target, rows with any null among them dropped."""
    have = [c for c in features if c in df.columns]
    cols = list(dict.fromkeys([*keep, *have, target]))
    return df.select(*cols).dropna(subset=[*have, target])


# W9 -------------------------------------------------------------------------
def engineer_features(laps: DataFrame, pits: DataFrame | None = None,
                      keys: Sequence[str] = PANEL, seq: str = "lap_number",
                      tie: str | None = "lap_id", include_current: bool = True,
                      mappings: dict[str, DataFrame] | None = None, gap_median: float | None = None) -> DataFrame:
    """P11+W4 -> P10+W2 -> W3+W5 -> J1 -> J2 -> W6+P13 -> drop rows with null features.

    ``mappings`` (column -> fitted label mapping) and ``gap_median`` reuse what was fitted
    elsewhere (``model.FeatureStage``); otherwise codes are fitted on this input. Input needs tire_compound/tire_age
    (``normalise_columns``).

    W2, both W3 means and J1 run on one ordered frame (stops are rows of kind 0 in it). W4 and
    W6 share one table: the codes are joined to the (entity, session, compound) rows of W4,
    which are as few as stints, and come to the laps with the stint length."""
    mappings, enc = mappings or {}, {"circuit": "circuit_encoded", "driver": "driver_encoded",
                                     "tire_compound": "tire_compound_encoded"}
    # aggregates come from the input rows (the feature steps keep every row), so they do not
    # run the window chain again
    ages = stint_ages(laps, keys)
    codes = stage(fit_label_mappings(laps, [c for c in enc if c not in mappings]), "codes") \
        if len(mappings) < len(enc) else None
    for col, out in enc.items():
        m = extend_label_mapping(mappings[col], laps, col) if col in mappings else \
            codes.where(F.col("column_name") == col)
        m = m.select(F.col("value").alias("_lk"), F.col("code").alias(out))
        ages = ages.join(m, F.col(col).cast("string") == F.col("_lk"), "left").drop("_lk")
    df, order, tail = default_position_gap(laps, gap_median), _order(laps, seq, tie), ["lap_time", "position"]
    if pits is None:
        x = Ordered(df, keys, order, like=laps).carry(tail=tail, tail_rows=5)
    else:
        x = Ordered(with_pits(df, pits, keys, seq, "pit_lap"), keys, [seq, "_kind", *order[1:]],
                    like=laps.withColumn("_kind", F.lit(1)), kind="_kind")
        x.carry(tail=tail, tail_rows=5, maxima={"_last_pit": F.col("_pit")})
    x.rows = x.rows.withColumns({
        "position_change": _position_change(x),
        "rolling_avg_lap_time_3": x.mean_of_last("lap_time", 3, include_current),
        "rolling_avg_lap_time_5": x.mean_of_last("lap_time", 5, include_current),
        "laps_since_pit": F.lit(0) if pits is None else _since_pit(x, seq)})
    df = (x.rows if pits is None else x.rows.where(F.col("_kind") == 1))
    df = x.done() if pits is None else df.select(*x.done("_kind", "_pit", "_last_pit").columns)
    df = split_join(predicted_degradation(df), ages, [*keys, "tire_compound"], rows="_laps")
    df = relative_performance(df, means=session_lap_means(laps))
    return one_hot_compound(circuit_features(df)).dropna(subset=[*FEATURES, TARGET])


# W7 -------------------------------------------------------------------------
def chronological_split(df: DataFrame, order: Sequence[str] = (*SESSION, "lap_number"),
                        tie: Sequence[str] = ("driver", "lap_id"), test_fraction: float = 0.2,
                        rank: bool = True) -> DataFrame:
    """Flag the last ``int(fraction·n)`` rows (at least 1) of the global order as test.

    The first test row's key is found by selection (``ordering.key_at``), so the flag is a
    filter on the key and the facts are not exchanged for it. Rows equal in the whole key stay
    on one side, the test side. The selection reads ``df`` a few times: a frame that is costly
    to compute is better staged (``staging.stage``) first. ``rank`` adds ``split_rank``, the
    row's position in the global order, which does need an exchange (blocks along the order,
    so no window spans the table and a hot session or lap does not concentrate)."""
    keys = [*order, *[c for c in tie if c in df.columns]]
    wanted = lambda n: None if not n else n - max(1, int(n * test_fraction))
    first = key_at(df, keys, wanted)
    out = row_index(df, [], keys, "split_rank") if rank else df
    if first is None:
        return out.withColumn("is_test", F.lit(False))
    key = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(keys, first)])
    return out.withColumn("is_test", F.struct(*keys) >= key)
