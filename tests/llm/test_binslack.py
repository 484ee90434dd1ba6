"""Minimum bin slack: exact placement, no padding, and the subset-sum step against brute force."""

import itertools
import random
import zlib

import numpy as np
import pytest

from lapstats.llm import binslack
from lapstats.llm.tokens import default_tokenizer

PATH = default_tokenizer()


def test_closest_is_the_best_multiset():
    rg = random.Random(3)
    for _ in range(200):
        left = {rg.randint(1, 12): rg.randint(0, 3) for _ in range(rg.randint(1, 5))}
        room = rg.randint(0, 30)
        got = binslack.closest(left, room)
        assert all(0 < n <= left[k] for k, n in got.items())
        best = max(s for c in itertools.product(*[range(n + 1) for n in left.values()])
                   if (s := sum(k * n for k, n in zip(left, c))) <= room)
        assert sum(k * n for k, n in got.items()) == best


@pytest.mark.parametrize("histogram", [{}, {5: 1}, {700: 1000}, {1024: 7, 1: 3}, {1023: 10**9}, {600: 3, 500: 2, 400: 1},
                                       {k: 10**7 + k for k in range(1, 1025)}, {k: k % 7 for k in range(1, 1025) if k % 7}])
def test_plan_places_each_id_once_without_padding(histogram):
    runs = binslack.plan(histogram)
    # ids by length, counted in the runs; every sequence whole up to the last few
    ids = {}
    for orig, rank, count, start, length, first, offset in runs:
        ids[orig] = ids.get(orig, 0) + count * length
    assert ids == {k: k * n for k, n in histogram.items()}
    # a sequence's runs: sums over cells of equal sequences
    edges = sorted({s for r in runs for s in (r[5], r[5] + r[2])})
    fill, at = np.zeros(max(len(edges), 1), np.int64), {e: i for i, e in enumerate(edges)}
    for *_, count, start, length, first, offset in runs:
        fill[at[first]:at[first + count]] += length
    short = fill[:-1][fill[:-1] != 1024] if edges else []
    assert all(x & (x - 1) == 0 for x in short) and len(short) <= 10
    assert len(runs) < 40_000


def check(rows, docs, library):
    """Every document's ids once, sequences gapless, no padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for items in by_seq.values():
        at = 0
        for r in sorted(items, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024
    want = {}
    for i, t in docs:
        ids = (library.encode(t, add_special_tokens=False).ids if t else []) + [0]
        want.setdefault((i, len(ids)), []).append(ids)
    assert {k: len(v) * k[1] for k, v in want.items()} == {k: sum(r.length for r in v) for k, v in by_doc.items()}
    for key, texts in want.items():
        if all(t == texts[0] for t in texts):
            raw = np.array(texts[0], "<u4").tobytes()
            for r in by_doc[key]:
                assert r.ids_crc32 == zlib.crc32(raw[r.start * 4:(r.start + r.length) * 4])


def test_pack_on_awkward_rows(spark, awkward, nothing):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    check(binslack.pack(awkward, PATH).collect(), [(r.doc_id, r.text) for r in awkward.collect()], library)
    assert binslack.pack(nothing, PATH).collect() == []


def test_query_on_the_table(spark):
    from tokenizers import Tokenizer
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = binslack.op12_min_bin_slack(spark, sf).collect()
    check(rows, docs, Tokenizer.from_file(PATH))
    # longer documents are cut, of the others those at the end, where few lengths are left
    cut = sum(1 for r in rows if r.length < r.doc_tokens <= 1024)
    assert cut <= len(docs) // 2 and len({r.sequence_id for r in rows}) <= -(-sum(r.length for r in rows) // 1024) + 10
