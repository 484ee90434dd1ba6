"""Exact centroid clustering with ns-bounds (operator 13).

Every vector keeps, for each centroid, a lower bound of its distance and the round in which
that distance was last computed, and for its own centroid the distance itself. The history of
all centroids is kept (rounds x clusters vectors, the only thing the driver holds). In a later
round a bound is loosened by the norm of the centroid's total displacement since the round in
which it was computed -- the length of one vector, not the sum of the lengths of the steps
between, so a centroid that went and came back loosens nothing. Where the own centroid's
distance stays below every other loosened bound, the assignment stands; the centroids whose
bounds fail are rescanned in exact integer arithmetic, and ties go to the smaller number.

Bounds are rounded outward (``SLACK``), so a rounding error can cost a rescan, never a wrong
answer. Each round is one map over the vectors with their bounds, written to the shared
folder; new centroids come from sums per cluster, which the tasks add up before the shuffle.
Sums are exact integers of any size, kept in limbs of ``LIMB`` bits.

Defined cases: vectors that are null, of another length, or hold null or non-finite components
(or doubles of 2**140 and more) take no part; rows that repeat an id are clustered each; a row with a null id is clustered but
starts no centroid; fewer vectors than clusters give fewer centroids; an empty table gives no
rows. Squared distances beyond 64 bits are given as the largest 64-bit integer.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, extend, map_arrow, scratch_path

LIMB, LIMBS = 40, 5
SLACK = 1e-9            # relative; float64 square roots are exact to about 1e-16
SAFE = 1 << 24          # components below this keep every squared distance within int64
LARGEST = 2.0 ** 140    # above any 32-bit float; sums of larger components would not fit the limbs
MOST = (1 << 63) - 1


# --- integer vectors ------------------------------------------------------------------
def integers(column, scale: float) -> np.ndarray:
    """floor(scale * x) of an Arrow list column as a matrix: int64 where squares fit, otherwise
    Python integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * scale).reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    if not x.size or np.abs(x).max() < SAFE:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x.tolist()], object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows of ``x`` to rows of ``c`` (pairwise by position)."""
    d = x - c
    return (d * d).sum(axis=1)


def roots(sq: np.ndarray) -> np.ndarray:
    return np.sqrt(sq.astype(np.float64))


def displacements(history: list[list[list[int]]]) -> np.ndarray:
    """[t, k]: the norm of centroid k's way from round t to the last round."""
    now = history[-1]
    return np.array([[float(sum((a - b) ** 2 for a, b in zip(c, d))) ** 0.5 for c, d in zip(then, now)]
                     for then in history])


def assign(x: np.ndarray, history: list[list[list[int]]], own: np.ndarray, low: np.ndarray, when: np.ndarray):
    """One round: (cluster, squared distance to it, bounds, rounds of the bounds, distances
    computed). ``own`` is -1 for vectors without bounds."""
    n, clusters, now = len(x), len(history[-1]), len(history) - 1
    big = x.dtype == object or any(abs(v) >= SAFE for c in history[-1] for v in c)
    c = np.array(history[-1], object if big else np.int64)
    x = x.astype(object) if big else x
    move = displacements(history)
    low, when = low.copy(), when.copy()
    best, dist = own.copy(), np.zeros(n, object if big else np.int64)
    have = own >= 0
    # the own centroid's distance is needed exactly, for the result and as the upper bound
    rows = np.flatnonzero(have)
    dist[rows] = squared(x[rows], c[own[rows]])
    bound = np.where(have[:, None], low - move[when, np.arange(clusters)], -1.0)
    computed = len(rows)
    upper = np.where(have, roots(dist) * (1 + SLACK), np.inf)
    low[rows, own[rows]], when[rows, own[rows]] = roots(dist[rows]) * (1 - SLACK), now
    for k in range(clusters):       # rescan the bounds that fail, exactly
        rows = np.flatnonzero((bound[:, k] * (1 - SLACK) - SLACK <= upper) & (own != k))
        if not len(rows):
            continue
        d = squared(x[rows], c[np.full(len(rows), k)])
        computed += len(rows)
        low[rows, k], when[rows, k] = roots(d) * (1 - SLACK), now
        better = (best[rows] < 0) | (d < dist[rows]) | ((d == dist[rows]) & (k < best[rows]))
        take = rows[better]
        best[take], dist[take] = k, d[better]
        upper[take] = roots(d[better]) * (1 + SLACK)
    return best, dist, low, when, computed


# --- sums and inertia in limbs ----------------------------------------------------------
def limbs(values: list[int]) -> list[int]:
    """Each integer as LIMBS digits of LIMB bits, lowest first; the last one has the sign."""
    mask = (1 << LIMB) - 1
    return [v >> (LIMB * i) & mask if i < LIMBS - 1 else v >> (LIMB * i) for v in values for i in range(LIMBS)]


def joined(digits: list[int]) -> list[int]:
    return [sum(d << (LIMB * i) for i, d in enumerate(digits[a:a + LIMBS])) for a in range(0, len(digits), LIMBS)]


def sums(state: DataFrame, dims: int, scale: float, vector: str, cluster: str) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, componentwise sums): one row per task and cluster is shuffled, one
    number per cluster and component comes to the driver."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            x = integers(batch.column(0), scale)
            k = batch.column(1).to_numpy(zero_copy_only=False)
            for c in np.unique(k).tolist():
                part = x[k == c]
                total = [int(v) for v in part.sum(axis=0)]
                n, old = held.get(c, (0, [0] * dims))
                held[c] = (n + len(part), [a + b for a, b in zip(old, total)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([limbs([n, *v]) for n, v in held.values()], pa.list_(pa.int64()))],
            names=["k", "digits"])

    parts = map_arrow(state.select(vector, cluster), run, "k int, digits array<long>")
    rows = (parts.select("k", F.posexplode("digits").alias("at", "digit")).groupBy("k", "at").agg(F.sum("digit").alias("s"))
            .groupBy("k").agg(F.sort_array(F.collect_list(F.struct("at", "s"))).alias("digits")).collect())
    out = {}
    for r in rows:
        n, *total = joined([d["s"] for d in r["digits"]])
        out[r["k"]] = (n, total)
    return out


# --- clustering -------------------------------------------------------------------------
def kept(df: DataFrame, dims: int, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    good = (F.size(v) == dims) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    return df.where(F.col(vector).isNotNull() & good)


def first_centroids(rows: DataFrame, clusters: int, seed: int, scale: float, id_col: str, vector: str) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = (rows.where(F.col(id_col).isNotNull())
             .select(key.alias("key"), F.col(vector).cast("array<double>").alias("v"))
             .orderBy("key", "v").limit(clusters).collect())
    return [[int(np.floor(x * scale)) for x in r["v"]] for r in first]


def cluster(df: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, seed: int = 1,
            id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = df.sparkSession
    rows = kept(df, dims, vector).select(id_col, vector)
    history = [first_centroids(rows, clusters, seed, scale, id_col, vector)]
    k = len(history[0])
    schema = extend(rows.schema, "_own int, _sq string, _low binary, _when binary")
    names, state, old = schema.names, rows, None

    def turn(history, fresh):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x = integers(batch.column(1), scale)
                if fresh:
                    own, low, when = np.full(n, -1), np.zeros((n, k)), np.zeros((n, k), np.int64)
                else:
                    own = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                    low = np.frombuffer(b"".join(batch.column(4).to_pylist()), "<f4").reshape(n, k).astype(np.float64)
                    when = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(n, k).astype(np.int64)
                best, dist, low, when, _ = assign(x, history, own, low, when)
                single = low.astype(np.float32)         # rounded down, never above the bound
                single = np.where(single > low, np.nextafter(single, np.float32(-np.inf)), single).astype("<f4")
                age = when.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(best, pa.int32()), pa.array([str(d) for d in dist.tolist()]),
                     pa.array([r.tobytes() for r in single], pa.binary()), pa.array([r.tobytes() for r in age], pa.binary())],
                    names=names)
        return run

    if not k:       # nothing to cluster around
        return rows.where("false").select(
            id_col, F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"))
    for t in range(rounds + 1):
        path = scratch_path(spark, f"ns-round-{t}")
        map_arrow(state.select(*(names if t else names[:2])), turn(list(history), not t), schema) \
            .write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if old:
            drop_path(spark, old)
        old = path
        if t < rounds:
            found = sums(state, dims, scale, vector, "_own")
            history.append([[v // found[c][0] for v in found[c][1]] if c in found else history[-1][c] for c in range(k)])
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1]]
    most = F.lit(MOST)
    # inertia per cluster: decimal sums are exact and merge before the shuffle
    sq = F.col("_sq").try_cast("decimal(38,0)")
    capped = lambda c: F.least(c, most.cast("decimal(38,0)")).cast("long")
    per = {r["_own"]: int(r["s"]) for r in state.groupBy("_own").agg(F.sum(F.coalesce(sq, most)).alias("s")).collect()}
    total = min(sum(per.values()), MOST)
    by = lambda values, kind: F.array(*[F.lit(v).cast(kind) for v in values])[F.col("_own")]
    return state.select(
        id_col, F.col("_own").alias("cluster"), F.coalesce(capped(sq), most).alias("distance"),
        by([min(per.get(c, 0), MOST) for c in range(k)], "long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), by(sha, "string").alias("centroid_sha256"))


def op13_ns_bounds(spark, sf_dir) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(clusters: int = 16, rounds: int = 3) -> str:
    """The same clustering as unrolled SQL over (vector, component) rows."""
    steps = ["""WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
 WHERE embedding IS NOT NULL AND len(embedding) = 64
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, vec_id, i, floor(64 * embedding[i]::DOUBLE)::BIGINT AS x FROM e, range(1, 65) t(i)),
f AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1 AS k FROM e WHERE vec_id IS NOT NULL),
c0 AS MATERIALIZED (SELECT k, i, x AS c FROM v JOIN f USING (r) WHERE k < """ + str(clusters) + ")"]
    for t in range(rounds + 1):
        steps.append(f"""d{t} AS (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM v JOIN c{t} USING (i) GROUP BY r, k),
a{t} AS MATERIALIZED (SELECT r, k, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if t < rounds:
            steps.append(f"""s{t} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM v JOIN a{t} USING (r) GROUP BY k, i),
c{t + 1} AS MATERIALIZED (SELECT o.k, o.i, CASE WHEN s.n IS NULL THEN o.c
  ELSE ((s.s - (((s.s % s.n) + s.n) % s.n)) // s.n)::BIGINT END AS c FROM c{t} o LEFT JOIN s{t} s ON o.k = s.k AND o.i = s.i)""")
    return ",\n".join(steps) + f""",
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT e.vec_id, a.k::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
 (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN e USING (r) JOIN h ON h.k = a.k"""


SQL = _sql()
