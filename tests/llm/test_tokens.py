"""Encoding, packing and token files against the tokenizers library and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lapstats.llm import bpe, packing, tokenfile, tokens
from lapstats.llm.common import scratch_path

PATH = tokens.default_tokenizer()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids if text else []


def raw(values):
    return np.array(values, "<u4").tobytes()


@pytest.mark.parametrize("kind", [tokens.Encoder, bpe.BpeEncoder])
def test_encoding_equals_the_library_on_odd_texts(library, kind):
    rg = random.Random(5)
    parts = [" ", " ", "  ", "\n", "\t", "a", "The", "é", "12", "'s", "!", ".", ",", "　", "\x1c", "\x85", "\xa0",
             tokens.SPECIAL, "ж", "​", "́", "\U0001F600", "²", "Ġ", "’"]
    texts = ["".join(rg.choice(parts) for _ in range(rg.randint(0, 14))) for _ in range(4000)]
    texts += [None, "", "the." * 4000, "a" * 3000, "é" * 500 + " word"]
    for k in range(0, len(texts), 300):
        for a, coded in tokens.encode_batches(pa.array(texts[k:k + 300], pa.string()), PATH, kind):
            for t, c in zip(texts[k + a:], coded):
                assert c == raw(ids(library, t)), repr(t)


def colliding():
    """Two words whose polynomial hashes modulo 2**64 are equal for every base."""
    flip, w = {"a": "b", "b": "a"}, "a"
    while len(w) < 1024:
        w += "".join(flip[c] for c in w)
    return w, "".join(flip[c] for c in w)


@pytest.mark.parametrize("kind", [tokens.Encoder, bpe.BpeEncoder])
def test_words_are_compared_not_hashed(library, monkeypatch, kind):
    w, other = colliding()
    texts = [w, other, f"x {w} {other} y", f"{other}\n{w}", "a b c d", "e f g h a"]
    for weak in (False, True):      # also where every word has one hash
        if weak:
            monkeypatch.setattr(tokens, "packed_hash", lambda key, size, tag: np.full(len(size), 7, np.uint64))
        enc = kind(PATH)
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        got = enc.encode_buffer(raw, np.cumsum([0] + [len(t) for t in texts]))
        assert got == [globals()["raw"](ids(library, t)) for t in texts]


def test_word_index_forgets_and_grows(library):
    enc = tokens.Encoder(PATH)
    enc.index.BITS = 4
    enc.index.reset(0)
    texts = [" ".join(f"w{i * j}" for i in range(40)) for j in range(1, 30)]
    for t in texts * 2:
        assert enc.encode_buffer(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] == raw(ids(library, t))


def test_decode_equals_the_library(library):
    model = bpe.Model(PATH)
    rg = random.Random(2)
    for _ in range(200):
        some = [rg.randrange(50257) for _ in range(9)]
        assert model.decode(np.array(some)).decode() == library.decode(some, skip_special_tokens=False)
    assert model.decode(np.array([70_000, 464])) == b"The"


def test_bpe_query_and_columns(spark, awkward, nothing, library):
    got = bpe.round_trip(awkward, PATH).collect()
    want = sorted((r.doc_id or 0, len(i := ids(library, r.text)), hashlib.sha256(raw(i)).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in awkward.collect())
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    both = bpe.decode(bpe.encode(awkward, PATH, out="key"), PATH, ids="key")
    assert all(r.decoded == (r.text or "") and r.lang == "de" for r in both.collect())
    assert bpe.round_trip(nothing, PATH).count() == 0 and bpe.encode(nothing, PATH).count() == 0


def packed(rows):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    return seqs


def test_packing_places_every_piece_once(awkward, nothing, library):
    rows = packing.pack(packing.pieces(awkward, PATH)).collect()
    packed(rows)
    want = []
    for r in awkward.collect():
        i = ids(library, r.text) + [0]
        cuts = [0, *range(len(i) % 2048 or 2048, len(i) + 1, 2048)]
        want += [(r.doc_id or 0, k, a, b - a, zlib.crc32(raw(i[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert packing.pack(packing.pieces(nothing, PATH)).count() == 0


def test_packing_is_near_the_bound_and_its_plan_does_not_grow():
    sizes = []
    for n in (2_000, 200_000):
        rg = random.Random(1)
        h = {}
        for _ in range(n):
            k = min(2048, max(1, int(rg.lognormvariate(6.3, 1))))
            h[k] = h.get(k, 0) + 1
        runs = packing.plan(h)
        used = {}
        for _, times, items in runs:
            assert sum(k for k, _ in items) <= 2048
            for k, _ in items:
                used[k] = used.get(k, 0) + times
        assert used == h
        assert sum(r[1] for r in runs) <= 1.02 * sum(k * v for k, v in h.items()) / 2048 + 1
        sizes.append(len(runs))
    assert sizes[1] < 3 * sizes[0] + 2000
    assert packing.plan({}) == [] and packing.plan({7: 1}) == [(0, 1, [(7, 0)])]


def test_one_length_for_all_documents(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "'same text here' as text")
    rows = packing.pack(packing.pieces(df, PATH)).collect()
    per = 2048 // rows[0].length
    assert len(rows) == 5000 and len(packed(rows)) == -(-5000 // per)


def test_rank_coding_round_trip():
    rg = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        v = rg.integers(0, [3, 300, 70_000, 2**32][n % 4], n).astype(np.uint32)
        assert (tokenfile.unpack_ranks(*tokenfile.pack_ranks(v), n) == v).all()


@pytest.mark.parametrize("block", [50, 2_000_000])
def test_token_files(spark, awkward, nothing, library, monkeypatch, block):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", block)
    got = tokenfile.read(tokenfile.write(awkward, scratch_path(spark, "t"), PATH)).collect()
    at, want = 0, []
    for r in sorted(awkward.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        i = ids(library, r.text) + [2]
        want.append((r.doc_id, at, len(i), zlib.crc32(raw(i))))
        at += len(i)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    assert tokenfile.read(tokenfile.write(nothing, scratch_path(spark, "t"), PATH)).count() == 0
