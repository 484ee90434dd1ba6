"""Helpers shared by the corpus operators: shared folder, byte buffers, components."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 20   # texts handled at once inside a task
LINKS_PER_TASK = 200_000


# --- shared folder ------------------------------------------------------------------
def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = found.get() if found.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_MADE: ContextVar[list | None] = ContextVar("made", default=None)      # tables of the stage that runs


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    if _MADE.get() is not None:
        _MADE.get().append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialise`` once nothing reads it any more, and the shuffle files of
    finished queries."""
    drop_path(df.sparkSession, df._scratch)
    forget(df.sparkSession)


def forget(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries, which it does once the JVM has
    collected their plans."""
    gc.collect()
    spark._jvm.System.gc()


def staged(spark: SparkSession, name: str, make) -> DataFrame:
    """The frame that ``make()`` gives, materialised; the tables that ``make`` wrote on the way are
    deleted, as nothing reads them any more."""
    made: list = []
    token = _MADE.set(made)
    try:
        df = make()
        _MADE.reset(token)
        token = None
        return materialise(df, name)
    finally:
        if token is not None:
            _MADE.reset(token)
        for path in made:
            drop_path(spark, path)
        forget(spark)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path made by ``scratch_path`` once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors: where PYTHONPATH does not name it, its
    sources go along as a Spark Python file."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_lapstats_sent", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="lapstats-"), "lapstats_llm.zip")
    with zipfile.ZipFile(archive, "w") as z:
        z.write(os.path.join(root, "lapstats", "__init__.py"), "lapstats/__init__.py")
        here = os.path.dirname(os.path.abspath(__file__))
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"lapstats/llm/{name}")
    sc.addPyFile(archive)
    sc._lapstats_sent = True


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def extend(schema: StructType, ddl: str) -> StructType:
    """A new schema: the fields of ``schema`` followed by those of ``ddl``."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def arrow_uri(path: str) -> str:
    """The path with the scheme that pyarrow knows for Hadoop's names of S3."""
    scheme, sep, rest = path.partition("://")
    return f"s3://{rest}" if sep and scheme in ("s3a", "s3n") else path


def open_fs(path: str):
    """(pyarrow file system, path in it) of a URI or plain path; used inside tasks."""
    from pyarrow import fs
    path = arrow_uri(path)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# --- texts of a batch as one byte buffer --------------------------------------------
def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges (a, b) whose texts together stay near ``limit`` bytes; one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection with good diffusion) on a uint64 array."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# --- polynomial prefix hashes ---------------------------------------------------------
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
# a fixed random value per byte: equal strings have equal hashes, and the low entropy of
# plain byte values does not show in them
BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, np.uint64)
        out[0] = 1
        filled = 1
        while filled < size:     # doubling: out[f:2f] = out[:f] * base**f
            step = np.uint64(pow(base, filled, 1 << 64))
            k = min(filled, size - filled)
            out[filled:filled + k] = out[:k] * step
            filled += k
        _POW[base] = have = out
    return have


def prefix_hash(raw: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """P[i] = sum of value(byte j) * BASE**j for j < i, modulo 2**64."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values[raw] * powers(BASE, len(raw))[:len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes [start, end): independent of where they stand."""
    inv = powers(BASE_INV, len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start])


# --- short strings as numbers ---------------------------------------------------------
PACKED = 32             # bytes of a string that four 64-bit numbers hold
KEEP = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)      # the first i bytes of a number


def packed(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first PACKED bytes of each string as a column of four 64-bit numbers, zero beyond its
    end: strings up to that length are equal if and only if their lengths and columns are."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    window = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    out = np.zeros((PACKED // 8, len(start)), np.uint64)
    out[0] = window[start] & KEEP[np.minimum(length, 8)]
    rows = np.flatnonzero(length > 8)
    for i in range(1, PACKED // 8):
        if not len(rows):
            break
        out[i, rows] = window[start[rows] + 8 * i] & KEEP[np.minimum(length[rows] - 8 * i, 8)]
        rows = rows[length[rows] > 8 * i + 8]
    return out


def packed_hash(key: np.ndarray, length: np.ndarray, tag: np.ndarray | None = None) -> np.ndarray:
    """A hash of each string by its numbers, its length and a tag of its own."""
    h = mix(key[0] + (length if tag is None else tag).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rows = np.flatnonzero(length > 8)
    for i in range(1, len(key)):
        if not len(rows):
            break
        h[rows] = mix(h[rows] ^ key[i, rows] + np.uint64(i))
        rows = rows[length[rows] > 8 * i + 8]
    return h


# --- words ------------------------------------------------------------------------------
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE):
    """Start, end and row of each maximal run of non-space bytes; none crosses a text's end.
    ``space`` may name other bytes (a table of 256) as those between words."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~space[raw]
    first = np.zeros(n + 1, bool)
    first[offsets[offsets <= n]] = True
    starts = np.flatnonzero(solid & (first[:n] | np.concatenate(([True], ~solid[:-1]))))
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~solid[1:] | first[1:n]
    ends = np.flatnonzero(solid & last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


# --- connected components -----------------------------------------------------------------
def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (columns a, b; null-free).

    Alternating large-star / small-star contraction: each round links every vertex to the
    smallest vertex of its neighbourhood; rounds grow with the logarithm of the longest
    chain. Only grouped minima are shuffled, so a vertex with very many links is reduced
    before the shuffle. Each round is written to the shared folder. Vertices without an edge
    do not appear.
    """
    spark = edges.sparkSession
    links = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), name)
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = state
        # few links need few tasks: about LINKS_PER_TASK each
        tasks = min(-(-state[0] // LINKS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
        # large star: every neighbour above a vertex moves to the vertex's smallest neighbour
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .coalesce(tasks).distinct())
        # small star: a vertex and its smaller neighbours move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a", "left").select("a", "b", "m").coalesce(tasks)
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct("a", F.col("m").alias("b")))).alias("l"))
                 .select("l.a", "l.b").where("a <> b").distinct().coalesce(tasks))
        links = materialise(small, name)
