"""Token ids of whole texts with the tokenizers library, one table lookup per word.

Byte-level BPE never merges across a pre-token, and a single space between two
non-space characters always starts one. A text is therefore cut at such spaces, and the
ids of each piece are looked up in a bounded per-worker table. Pieces not seen before are
joined and go to the library together; their ids are told apart by the tokens that begin
with a space. Words are looked up by a hash and compared whole: up to 32 bytes as numbers, longer
ones as strings. The result equals ``Tokenizer.encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import re

import numpy as np

from .common import PACKED, chunks, packed, packed_hash, text_buffer

SPECIAL = "<|endoftext|>"
TABLE_LIMIT = 200_000       # pieces remembered per worker, then forgotten
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")
NEWLINE = "\n"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def odd(text: str) -> bool:
    """Whether white space other than single inner spaces and newlines may be in the text."""
    return ("  " in text or " \n" in text or "\n " in text or "\n\n" in text
            or text[0] in " \n" or text[-1] in " \n"
            or not text.replace(NEWLINE, "").isprintable())


def odd_texts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text of a buffer: whether white space other than single inner spaces and newlines,
    or a special token, may be in it."""
    n = len(offsets) - 1
    gap = (raw == 32) | (raw == 10)
    bad = ((raw < 32) & (raw != 10)) | (raw == 127)
    bad[1:] |= gap[1:] & gap[:-1]
    for lead, is_space in ((0xC2, lambda b, c: (b == 0x85) | (b == 0xA0)),
                           (0xE1, lambda b, c: (b == 0x9A) & (c == 0x80)),
                           (0xE2, lambda b, c: ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
                            | ((b == 0x81) & (c == 0x9F))),
                           (0xE3, lambda b, c: (b == 0x80) & (c == 0x80))):
        at = np.flatnonzero(raw == lead)
        if len(at):
            last = len(raw) - 1
            bad[at[is_space(raw[np.minimum(at + 1, last)], raw[np.minimum(at + 2, last)])]] = True
    out = np.zeros(n, bool)
    out[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = True
    some = np.flatnonzero(offsets[1:] > offsets[:-1])
    out[some[gap[offsets[some]] | gap[offsets[some + 1] - 1]]] = True
    text, at = raw.tobytes(), -1
    while (at := text.find(SPECIAL.encode(), at + 1)) >= 0:
        out[np.searchsorted(offsets, at, side="right") - 1] = True
    return out


def cut(text: str) -> tuple[int, str, list[str]]:
    """(ids to drop in front, head, pieces): the encodings of the head and the pieces joined,
    without the first ids, are the text's encoding. Pieces have lost the space before them,
    unless they start with the newline that stands there instead (a lone newline between
    non-space characters is a pre-token of its own)."""
    if odd(text):
        head, *pieces = _CUT.split(text)
        return 0, head, pieces
    return 1, "", (NEWLINE + text).replace(NEWLINE, " \n").split(" ")[1:]


class WordIndex:
    """Open-addressing numpy table: a word of at most PACKED bytes -> its ids in a pool. Slots
    are found by a hash; the words themselves are kept and compared."""

    BITS = 21

    def __init__(self):
        self.reset(0)

    def reset(self, words: int) -> None:
        """Empty the table; it is made larger for more words than a quarter of its slots."""
        self.bits = max(self.BITS, (4 * words).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.entry = np.zeros(1 << self.bits, np.int32)
        self.word = np.zeros((PACKED // 8, 1 << 12), np.uint64)
        self.tag, self.where, self.length = (np.zeros(1 << 12, np.int64) for _ in range(3))
        self.pool = np.zeros(1 << 20, np.uint32)
        self.used = self.held = 0

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, or the empty slot where it would stand."""
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.flatnonzero((self.keys[at] != h) & (self.keys[at] != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            k = self.keys[at[todo]]
            todo = todo[(k != h[todo]) & (k != 0)]
        return at

    def full(self, words: int) -> bool:
        """Whether so many more words would fill more than half of the slots."""
        return self.held + words > 1 << (self.bits - 1)

    def find(self, h: np.ndarray, word: np.ndarray, tag: np.ndarray) -> np.ndarray:
        """The entry of each word, or -1: compared whole, not by hash."""
        at = self.slots(h)
        e = self.entry[at]
        same = (self.keys[at] == h) & (self.tag[e] == tag) & (self.word[0][e] == word[0])
        more = np.flatnonzero(tag > 17)         # longer than eight bytes
        if len(more):
            same[more] &= (self.word[1:, e[more]] == word[1:, more]).all(axis=0)
        return np.where(same, e, -1)

    def add(self, h: np.ndarray, word: np.ndarray, tag: np.ndarray, ids: list[bytes]) -> None:
        """Words with distinct new hashes and their ids."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), np.uint32)))
        while self.held + len(h) > len(self.tag):
            self.word, self.tag, self.where, self.length = (
                np.concatenate((x, np.zeros_like(x)), axis=-1) for x in (self.word, self.tag, self.where, self.length))
        self.pool[self.used:self.used + len(flat)] = flat
        n = np.array([len(i) // 4 for i in ids], np.int64)
        new = self.held + np.arange(len(h))
        self.word[:, new], self.tag[new], self.length[new] = word, tag, n
        self.where[new] = self.used + np.cumsum(n) - n
        self.used += len(flat)
        self.held += len(h)
        todo = np.arange(len(h))
        while len(todo):        # of several words for one empty slot the first takes it
            at = self.slots(h[todo])
            _, first = np.unique(at, return_index=True)
            mine = todo[first]
            self.keys[at[first]], self.entry[at[first]] = h[mine], new[mine]
            todo = np.delete(todo, first)


class PieceTable:
    """Tables from pieces to ids; subclasses say how pieces are encoded.

    Ordinary texts go through ``encode_buffer``: words are found, hashed and looked up with
    numpy. Texts with other white space or special tokens go through ``encode``, piece by
    piece."""

    def __init__(self):
        self.table: dict[str, bytes] = {}
        self.index = WordIndex()

    def whole(self, text: str) -> bytes:
        """Ids of any text, without the table."""
        raise NotImplementedError

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of unseen pieces, each read as if a space stood before it unless it starts
        with a newline."""
        raise NotImplementedError

    def encode_buffer(self, raw: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of each text of a buffer of UTF-8 bytes cut at ``offsets``."""
        n, size = len(offsets) - 1, len(raw)
        bounds = np.zeros(n + 1, np.int64)
        ids = np.zeros(0, np.uint32)
        strange = odd_texts(raw, offsets)
        mark = (raw == 32) | (raw == 10)
        mark[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        start = np.flatnonzero(mark)
        if len(start):
            row = np.searchsorted(offsets, start, side="right") - 1
            head = start == offsets[row]
            keep = ~strange[row]
            end = np.append(start[1:], size)[keep]
            start, row, head = start[keep], row[keep], head[keep]
            space = (raw[start] == 32) & ~head
            begin = np.where(head, start, start + 1)
            size = end - begin
            tag = size * 2 + space
            word = packed(raw, begin, size)
            h = packed_hash(word, size, tag)
            h[h == 0] = 1
            ix, text = self.index, None
            long = size > PACKED
            short = np.flatnonzero(~long)
            known = lambda: np.where(long, -1, ix.find(h, word, tag))
            entry = known()
            named = lambda at: [("" if s else NEWLINE) + text[a:b].decode() for s, a, b in zip(
                space[at].tolist(), begin[at].tolist(), end[at].tolist())]
            new = np.flatnonzero((entry < 0) & ~long)
            new = new[ix.keys[ix.slots(h[new])] == 0]
            if len(new) and ix.full(len(np.unique(h[new]))):    # forget, then learn all of these
                ix.reset(len(np.unique(h[short])))
                new = short
            if len(new):
                _, first = np.unique(h[new], return_index=True)
                first = new[first]
                text = raw.tobytes()
                names = named(first)
                found = self.learn(set(names))
                ix.add(h[first], word[:, first], tag[first], [found[p] for p in names])
                entry[new] = ix.find(h[new], word[:, new], tag[new])
            where, length, pool = ix.where[entry], ix.length[entry].astype(np.int64), ix.pool
            rare = np.flatnonzero(entry < 0)        # long words, and any whose hash another word has
            if len(rare):
                text = text or raw.tobytes()
                coded = self.pieces(named(rare))
                many = np.array([len(c) // 4 for c in coded], np.int64)
                where[rare], length[rare] = ix.used + np.cumsum(many) - many, many
                pool = np.concatenate((pool[:ix.used], np.frombuffer(b"".join(coded), "<u4")))
            where, length = where + head, length - head
            total = np.cumsum(length)
            ids = pool[np.repeat(where - total + length, length) + np.arange(total[-1] if len(total) else 0)]
            bounds[1:] = np.cumsum(np.bincount(row, weights=length, minlength=n).astype(np.int64))
        coded = ids.astype("<u4").tobytes()
        out = [coded[a:b] for a, b in zip((bounds[:-1] * 4).tolist(), (bounds[1:] * 4).tolist())]
        if strange.any():
            rows = np.flatnonzero(strange).tolist()
            texts = [raw[offsets[r]:offsets[r + 1]].tobytes().decode() for r in rows]
            for r, c in zip(rows, self.encode(texts)):
                out[r] = c
        return out

    def pieces(self, names: list[str]) -> list[bytes]:
        """Ids of pieces by the table of strings."""
        ids = list(map(self.table.get, names))
        unseen = {p for p, x in zip(names, ids) if x is None}
        if unseen:
            new = self.learn(unseen)
            if len(self.table) + len(new) > TABLE_LIMIT:
                self.table.clear()
            self.table.update(new)
            ids = [new[p] if x is None else x for p, x in zip(names, ids)]
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers; null is empty."""
        table = self.table
        heads, rest, got, unseen = [], [], [], set()
        for t in texts:
            if not t or SPECIAL in t:   # special tokens are found before words are split
                heads.append((0, self.whole(t) if t else b""))
                pieces = []
            else:
                drop, head, pieces = cut(t)
                heads.append((drop * 4, self.whole(head) if head else b""))
            ids = list(map(table.get, pieces))
            if None in ids:
                unseen.update(p for p, x in zip(pieces, ids) if x is None)
            rest.append(pieces)
            got.append(ids)
        new = self.learn(unseen) if unseen else {}
        if len(table) + len(new) > TABLE_LIMIT:
            table.clear()
        table.update(new)
        out = []
        for (drop, head), pieces, ids in zip(heads, rest, got):
            if None in ids:
                ids = [new[p] if x is None else x for p, x in zip(pieces, ids)]
            coded = head + b"".join(ids)
            out.append(coded[drop:] if drop else coded)
        return out


class Encoder(PieceTable):
    """The tokenizers library: unseen pieces go to it joined, in one call."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.spaced[i] = token.startswith("Ġ")   # the byte alphabet's sign for a space
        self.newline = np.zeros(len(self.spaced), bool)
        self.newline[vocab["Ċ"]] = True              # and for a newline
        self.stops = {s: self.whole(s) for s in ",."}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        found, table, ended, todo = {}, self.table, [], set()
        for p in pieces:    # a stop after a letter is a pre-token of its own
            if p[-1:] in (",", ".") and p[-2:-1].isalpha():
                ended.append(p)
                if p[:-1] not in table:
                    todo.add(p[:-1])
            else:
                todo.add(p)
        plain = [p for p in todo if p.isprintable() and p and " " not in p]
        lines = [p for p in todo if p[:1] == NEWLINE and p[1:].isprintable() and p[1:] and " " not in p]
        for group, text, marks in ((plain, " " + " ".join(plain), self.spaced),
                                   (lines, "".join(lines), self.newline)):
            if not group:
                continue
            ids = self._ids(text)
            at = np.flatnonzero(marks[ids])
            if len(at) != len(group):   # a mark inside a piece: left to the loop below
                continue
            raw, starts = ids.tobytes(), (at * 4).tolist()
            for p, i, j in zip(group, starts, starts[1:] + [len(raw)]):
                found[p] = raw[i:j]
        for p in todo:
            if p not in found:
                found[p] = self._ids(p if p[:1] == NEWLINE else " " + p).tobytes()
        for p in ended:
            stem = p[:-1]
            found[p] = (found[stem] if stem in found else table[stem]) + self.stops[p[-1]]
        return found

_ENCODERS: dict[tuple, PieceTable] = {}


def encoder(path: str, kind: type = Encoder) -> PieceTable:
    """The worker's encoder of one kind for one tokenizer file."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = kind(path)
    return _ENCODERS[path, kind]


def encode_batches(column, path: str, kind: type = Encoder, limit: int = 1 << 20):
    """(first row, list of id bytes) over an Arrow string column, near ``limit`` bytes at a time."""
    raw, offsets = text_buffer(column)
    enc = encoder(path, kind)
    for a, b in chunks(offsets, limit):
        yield a, enc.encode_buffer(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
