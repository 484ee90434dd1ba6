"""Substring deduplication by line or paragraph hashing (operator 2).

A unit is a line (or a paragraph: text between blank lines). It is normalised (lower case,
white space runs as one space, ends stripped) and digested to 128 bits. Units are grouped
over the whole corpus by digest; the occurrence with the smallest (document id, unit number)
stays and every other one is removed. The original character offsets of all removed units
are kept. ``op2_line_dedup`` takes every unit that has a word; callers of ``dedup`` can set a
floor in words (``MIN_WORDS`` unless they say otherwise), under which units stay.

Digests are reduced before they are shuffled, and only digests that come more than once meet
the units again, in a join whose hot keys Spark can split; per document only its own units
are ever collected.

Defined cases: null text stays null and has no units; null ids rank last, and each row with
one is a document of its own; rows that share an id are one document only if their texts are
equal too (then all of them lose the same units), else they rank by unit number, then by a
hash pair of the text; blank units
and those under the floor are never removed. Extra columns are kept.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extend, map_arrow, materialise

MIN_WORDS = 5
SEED = 7       # makes the second hash of a text independent of the first
SEPARATOR = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*")}
DOC = ["_doc", "_t1", "_t2", "_copy"]      # what names a document: id, hash pair of its text, row if the id is null
UNITS = "_doc long, _t1 long, _t2 long, _copy long, _unit int, _start int, _end int, _d1 long, _d2 long"


def spans(text: str, unit: str):
    """(start, end) of each unit of a text, without the separators."""
    at = 0
    for m in SEPARATOR[unit].finditer(text):
        yield at, m.start()
        at = m.end()
    yield at, len(text)


def named(df: DataFrame, id_col: str, text: str, names: list[str]) -> DataFrame:
    """``df`` with the columns of ``DOC`` under ``names``; rows with a null id are written to
    the shared folder, so that their row numbers stay the same."""
    doc, t1, t2, copy = names
    null = F.col(id_col).cast("long").isNull()
    lone = materialise(df.where(null).withColumn(copy, F.monotonically_increasing_id()), "rows-without-id")
    rows = df.where(~null).withColumn(copy, F.lit(-1).cast("long")).unionByName(lone)
    return (rows.withColumn(doc, F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)))
            .withColumn(t1, F.xxhash64(text)).withColumn(t2, F.xxhash64(F.lit(SEED), text)))


def units(rows: DataFrame, unit: str, min_words: int, names: list[str], text: str) -> DataFrame:
    def run(batches):
        kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.int64()] * 2
        for batch in batches:
            cols = [[] for _ in kinds]
            for *doc, t in zip(*(c.to_pylist() for c in batch.columns)):
                for k, (a, b) in enumerate(spans(t, unit) if t else ()):
                    words = t[a:b].lower().split()
                    if len(words) >= min_words:
                        d = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
                        row = (*doc, k, a, b, int.from_bytes(d[:8], "little", signed=True),
                               int.from_bytes(d[8:], "little", signed=True))
                        for c, v in zip(cols, row):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[*DOC, "_unit", "_start", "_end", "_d1", "_d2"])

    return map_arrow(rows.select(*names, text), run, UNITS)


def dedup(df: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``df`` with its text without repeated units, n_units_removed and removed: the original
    (unit, start, end) of each removed unit, in order."""
    src = df.drop("removed", "n_units_removed")
    keys = [f"_line_dedup_2{c}" for c in DOC]
    rows = named(src, id_col, text, keys)
    found = materialise(units(rows, unit, min_words, keys, text), "units")
    rank = F.struct("_doc", "_unit", "_t1", "_t2", "_copy")
    first = (found.groupBy("_d1", "_d2").agg(F.min(rank).alias("_first"), F.max(rank).alias("_last"))
             .where("_first <> _last").drop("_last"))
    gone = (found.join(first, ["_d1", "_d2"]).where(rank != F.col("_first"))
            .groupBy(*DOC).agg(F.array_sort(F.collect_set(F.struct(
                F.col("_unit").alias("unit"), F.col("_start").alias("start"), F.col("_end").alias("end")))).alias("removed")))
    joined = rows.join(gone.withColumnsRenamed(dict(zip(DOC, keys))), keys, "left").drop(*keys)
    schema = extend(src.schema, "n_units_removed int, removed array<struct<unit:int,start:int,end:int>>")
    names = schema.names

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(text).to_pylist(), batch.column("removed").to_pylist()
            out = [t if not r or not t else cut(t, unit, {x["unit"] for x in r}) for t, r in zip(texts, lists)]
            cols = {n: batch.column(n) for n in names if n != "n_units_removed"}
            cols[text] = pa.array(out, pa.string())
            cols["removed"] = pa.array([r or [] for r in lists], batch.column("removed").type)
            cols["n_units_removed"] = pa.array([len(r or ()) for r in lists], pa.int32())
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return map_arrow(joined, run, schema)


def cut(text: str, unit: str, gone: set[int]) -> str:
    """The text without some units, each with the separator that follows it."""
    out, places = [], list(spans(text, unit))
    for k, (a, _) in enumerate(places):
        if k not in gone:
            out.append(text[a:places[k + 1][0] if k + 1 < len(places) else len(text)])
    return "".join(out)


def op2_line_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup(docs, min_words=1)
