"""Byte-level BPE encoding and decoding (operator 9).

Each pre-token is merged on contiguous arrays: one row holds the ids of its parts, a
second the ranks of adjacent pairs. A pass finds the smallest rank (the leftmost on ties),
deletes that boundary and refreshes the two neighbouring ranks, until no rank is left.
Pre-tokens of equal length are handled together, so a pass is a few numpy calls for
thousands of rows. Words longer than ``SHORT`` bytes, for which scanning would be
quadratic, take the same merges from a heap of (rank, place).

Defined cases: null or empty text has no tokens; special tokens written in a text become
their ids, as in the library; an id outside the vocabulary decodes to nothing; bytes that
are not UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extend, map_arrow
from .tokens import NEWLINE, PieceTable, default_tokenizer, encode_batches, encoder

SHORT = 48
NO_RANK = np.int64(1) << np.int64(40)


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other
    bytes for characters from U+0100 on, in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """Open-addressing table of (left id, right id) -> (rank, merged id), probed by numpy."""

    BITS = 19

    def __init__(self, pairs: list[tuple[int, int, int]], size: int):
        self.size = np.int64(size)
        n = 1 << self.BITS
        self.keys = np.full(n + 64, -1, np.int64)
        self.rank = np.full(n + 64, NO_RANK, np.int64)
        self.merged = np.zeros(n + 64, np.int64)
        self.exact = {}
        self.probes = 1
        for r, (a, b, c) in enumerate(pairs):
            k = a * size + b
            self.exact[k] = (r, c)
            at = int(self._slot(np.array([k], np.int64))[0])
            step = 0
            while self.keys[at + step] != -1:
                step += 1
            self.keys[at + step], self.rank[at + step], self.merged[at + step] = k, r, c
            self.probes = max(self.probes, step + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair in ``rank`` and ``merged``; the last slot has no rank."""
        key = left * self.size + right
        at = self._slot(key)
        hit = self.keys[at] == key
        out = np.where(hit, at, len(self.keys) - 1)
        todo = np.flatnonzero(~hit & (self.keys[at] != -1))
        for step in range(1, self.probes):
            if not len(todo):
                break
            near = at[todo] + step
            found = self.keys[near] == key[todo]
            out[todo[found]] = near[found]
            todo = todo[~found & (self.keys[near] != -1)]
        return out


class Model:
    """Vocabulary and merges of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = [b""] * size
        for token, i in (vocab | self.special).items():
            self.text[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.first = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.first[b] = vocab[c]
        self.pairs = PairTable([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], size)

    def merge_rows(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge words of one length; returns (row numbers, their final ids) groups."""
        rows, done, pairs = np.arange(len(ids)), [], self.pairs
        if ids.shape[1] > 1:
            slots = pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel())
            ranks = pairs.rank[slots].reshape(len(ids), -1)
        while ids.shape[1] > 1 and len(rows):
            at = ranks.argmin(axis=1)
            live = ranks[np.arange(len(rows)), at] < NO_RANK
            if not live.all():
                done.append((rows[~live], ids[~live]))
                rows, ids, ranks, at = rows[live], ids[live], ranks[live], at[live]
                if not len(rows):
                    break
            n, width = ids.shape
            line = np.arange(n)
            ids[line, at] = pairs.merged[pairs.find(ids[line, at], ids[line, at + 1])]
            keep = np.ones((n, width), bool)      # delete the boundary after the pair's left part
            keep[line, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = keep[:, 1:]                    # and the rank that stood on it
            ranks = ranks[keep].reshape(n, width - 2)
            for place in (at - 1, at):            # refresh the ranks beside the new part
                ok = np.flatnonzero((place >= 0) & (place < width - 2))
                p = place[ok]
                ranks[ok, p] = pairs.rank[pairs.find(ids[ok, p], ids[ok, p + 1])]
        if len(rows):
            done.append((rows, ids))
        return done

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for one long word, from a heap over linked parts."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n, find, size = len(ids), self.pairs.exact.get, int(self.pairs.size)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i):
            j = after[i]
            if j < n and (hit := find(ids[i] * size + ids[j])):
                heapq.heappush(heap, (hit[0], i, ids[i], ids[j], hit[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = c, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit integers."""
        out, by_length = [b""] * len(words), {}
        for i, w in enumerate(words):
            if len(w) > SHORT:
                out[i] = self.merge_long(w)
            elif w:
                by_length.setdefault(len(w), []).append(i)
        for length, members in by_length.items():
            flat = np.frombuffer(b"".join([words[i] for i in members]), np.uint8)
            for rows, ids in self.merge_rows(self.first[flat].reshape(-1, length)):
                raw, step = ids.astype("<u4").tobytes(), ids.shape[1] * 4
                for k, r in enumerate(rows.tolist()):
                    out[members[r]] = raw[k * step:(k + 1) * step]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the decoded text."""
        text, n = self.text, len(self.text)
        raw = b"".join([text[i] for i in ids.tolist() if i < n])
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()


class BpeEncoder(PieceTable):
    """The piece table filled by the merges above instead of the library."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        super().__init__()
        self.model = Model(path)
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.model.special)) + ")").split

    def whole(self, text: str) -> bytes:
        out = []
        for k, part in enumerate(self.split(text)):
            if k % 2:
                out.append(np.array([self.model.special[part]], "<u4").tobytes())
            else:
                out += self.model.encode_words([w.encode() for w in self.words(part)])
        return b"".join(out)

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        plan, number = {}, {}
        for p in pieces:
            if p.isalpha():
                found = [" " + p]
            elif p[-1:] in (",", ".") and p[:-1].isalpha():
                found = [" " + p[:-1], p[-1]]
            else:
                found = self.words(p if p[:1] == NEWLINE else " " + p)
            plan[p] = [number.setdefault(w, len(number)) for w in found]
        ids = self.model.encode_words([w.encode() for w in number])
        return {p: ids[w[0]] if len(w) == 1 else b"".join([ids[k] for k in w]) for p, w in plan.items()}


def encode(df: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the ids of each whole text as array<int>. A column of that name is
    replaced; other columns stay."""
    schema = extend(df.drop(out).schema, f"`{out}` array<int>")

    def run(batches):
        for batch in batches:
            rest = batch.drop_columns([out]) if out in batch.schema.names else batch
            for a, coded in encode_batches(batch.column(text), tokenizer, BpeEncoder):
                part = rest.slice(a, len(coded))
                col = pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in coded], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, col], names=[*part.schema.names, out])

    return map_arrow(df, run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of each array of ids (null: empty)."""
    schema = extend(df.drop(out).schema, f"`{out}` string")

    def run(batches):
        model = encoder(tokenizer, BpeEncoder).model
        for batch in batches:
            rest = batch.drop_columns([out]) if out in batch.schema.names else batch
            texts = [model.decode(np.array([i for i in (x or []) if i is not None], np.int64)).decode()
                     for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(texts, pa.string())],
                                             names=[*rest.schema.names, out])

    return map_arrow(df, run, schema)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 and decoded_sha256 after encoding and decoding the
    whole text; ids stay inside the task, so nothing but digests leaves it."""
    src = df.select(id_col, text)
    schema = extend(src.select(id_col).schema, "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches):
        model = encoder(tokenizer, BpeEncoder).model
        for batch in batches:
            for a, coded in encode_batches(batch.column(text), tokenizer, BpeEncoder):
                yield pa.RecordBatch.from_arrays([
                    batch.column(id_col).slice(a, len(coded)),
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                    pa.array([hashlib.sha256(model.decode(np.frombuffer(c, "<u4"))).hexdigest() for c in coded]),
                ], names=schema.names)

    return map_arrow(src, run, schema)


def op9_bpe(spark, sf_dir) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
