"""Token-id files (operator 10): frequency-ranked ids in byte-aligned variable-length
coding with separate control bytes.

A file is a run of blocks. A block holds whole documents (or a piece of one very long
document) in ascending ``doc_id`` order and has its own frequency table, so it can be
written and read alone and a task keeps one block in memory:

    magic "TIB1", then seven little-endian u32: number of documents, ids, distinct ids,
    bytes of the document index, of the table, of the controls and of the data; then the
    document index (doc_id i64, null flag u8, number of ids u32, continuation flag u8 per
    document), the table (ids by falling frequency, u32), the controls and the data.

The most frequent id of a block has rank 0. Four ranks share a control byte, two bits each
(number of bytes less one); the data bytes are little-endian. Decoding looks each control
byte up in tables of lengths and offsets and gathers the bytes with numpy.

Writing: documents are range-partitioned by ``doc_id`` and every task writes one file under
a name of its own attempt. Only the files named by tasks that succeeded go into the
manifest (one row a file), so lost executors and repeated attempts leave at most an
unused file. Defined cases: null text has only the end id; null ``doc_id`` sorts first;
equal ``doc_id`` sort by text; an empty table makes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise, open_fs, scratch_path
from .tokens import default_tokenizer, encode_batches

MAGIC = b"TIB1"
BLOCK_IDS = 2_000_000
HEAD = struct.Struct("<4s7I")
INDEX = np.dtype([("doc", "<i8"), ("null", "u1"), ("n", "<u4"), ("goes_on", "u1")])
# control byte -> byte lengths of its four values, and their sum
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)
TOTAL = LENGTHS.sum(axis=1)
STARTS = np.cumsum(LENGTHS, axis=1) - LENGTHS
MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(controls, data) of unsigned 32-bit values."""
    v = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    v[:len(ranks)] = ranks
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = (size - 1).reshape(-1, 4).astype(np.uint8)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    used = np.arange(4) < size[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first n values; inverse of ``pack_ranks``."""
    c = np.frombuffer(control, np.uint8)
    group = np.cumsum(TOTAL[c]) - TOTAL[c]
    at = (group[:, None] + STARTS[c]).ravel()[:n]
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    word = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        word |= raw[at + k].astype(np.uint32) << np.uint32(8 * k)
    return word & MASK[LENGTHS[c].ravel()[:n]]


def pack_block(docs: list[tuple[int | None, bytes, int]]) -> bytes:
    """One block of (doc_id, id bytes, whether the document goes on in the next block)."""
    ids = np.frombuffer(b"".join(d[1] for d in docs), "<u4")
    found, place, count = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((found, -count))
    rank = np.empty(len(found), np.uint32)
    rank[order] = np.arange(len(found), dtype=np.uint32)
    control, data = pack_ranks(rank[place])
    index = np.array([(d or 0, d is None, len(raw) // 4, more) for d, raw, more in docs], INDEX).tobytes()
    table = found[order].astype("<u4").tobytes()
    return HEAD.pack(MAGIC, len(docs), len(ids), len(found), len(index), len(table), len(control), len(data)) \
        + index + table + control + data


def read_blocks(stream):
    """(index array, ids) of each block of an open file, one block in memory at a time."""
    while head := stream.read(HEAD.size):
        magic, _, n, _, *sizes = HEAD.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        index, table, control, data = (stream.read(s) for s in sizes)
        ranks = unpack_ranks(control, data, n)
        yield np.frombuffer(index, INDEX), np.frombuffer(table, "<u4")[ranks]


MANIFEST = "part int, file string, first_doc long, n_docs long, n_ids long"


def write(df: DataFrame, folder: str, tokenizer: str, end_id: int | None = 2,
          id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts and write them to files in ``folder`` in ascending ``id_col`` order.

    Returns the manifest: one row a file, with the files' order in ``part``."""
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    spark = df.sparkSession
    fs, base = open_fs(folder)
    fs.create_dir(base, recursive=True)
    src = (df.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
           .repartitionByRange("doc").sortWithinPartitions("doc", "text")
           .withColumn("part", F.spark_partition_id()))

    def run(batches):
        out = name = part = first = None
        docs, held, n_docs, n_ids = [], 0, 0, 0
        for batch in batches:
            ids = batch.column("doc").to_pylist()
            for a, coded in encode_batches(batch.column("text"), tokenizer):
                if out is None:
                    store, root = open_fs(folder)
                    part, first = batch.column("part")[0].as_py(), ids[0]
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.tib"
                    out = store.open_output_stream(f"{root}/{name}")
                for doc, raw in zip(ids[a:a + len(coded)], coded):
                    raw += end
                    n_docs, n_ids = n_docs + 1, n_ids + len(raw) // 4
                    while held + len(raw) // 4 > BLOCK_IDS:
                        cut = (BLOCK_IDS - held) * 4
                        docs.append((doc, raw[:cut], 1))
                        out.write(pack_block(docs))
                        docs, held, raw = [], 0, raw[cut:]
                    docs.append((doc, raw, 0))
                    held += len(raw) // 4
        if out is not None:
            out.write(pack_block(docs))
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": name, "first_doc": first, "n_docs": n_docs, "n_ids": n_ids}],
                schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("first_doc", pa.int64()),
                                  ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return materialise(map_arrow(src, run, MANIFEST), "token-manifest").withColumn("folder", F.lit(folder))


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids_in_file_from) per document, from the files.

    ``start`` counts the ids of all documents before it: files before it (a running sum over
    the manifest, one row a file) plus documents before it in its file. Each task reads one
    file at a time, block by block."""
    from pyspark.sql import Window
    n = manifest.count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = (manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))
             .select("folder", "file", "base").repartition(max(1, n)))

    def run(batches):
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for f in batch.to_pylist():
                store, root = open_fs(f["folder"])
                with store.open_input_stream(f"{root}/{f['file']}") as stream:
                    start, crc, length = f["base"], 0, 0
                    for index, ids in read_blocks(stream):
                        raw, at, rows = memoryview(ids.astype("<u4").tobytes()), 0, []
                        for doc, null, count, goes_on in index.tolist():
                            crc = zlib.crc32(raw[at * 4:(at + count) * 4], crc)
                            at, length = at + count, length + count
                            if not goes_on:
                                rows.append((None if null else doc, start, length, crc))
                                start, crc, length = start + length, 0, 0
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([],) * 4)], names=names)

    return map_arrow(files, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_files(spark, sf_dir) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return read(write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, default_tokenizer()))
