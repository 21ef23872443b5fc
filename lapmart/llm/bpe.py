"""Token ids of whole texts with the ``tokenizers`` library, encoded once per distinct piece.

Texts are cut before each space and line feed, and before a sign behind a
letter.  The public vocabularies used here split a text into pre-tokens by a
pattern that never joins the end of a word with the white space or the sign
after it, so a text's ids are the ids of its pieces one after another.  The exception are longer runs of white space, which the
pattern takes apart by its own rule; a text with such a run is encoded as a
whole.  A piece's 64-bit hash stands for it in a worker's table of ids, so a
text whose pieces are known costs a few vectorised steps per batch.
"""

from __future__ import annotations

import os
import re
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa

from lapmart.llm.common import byte_groups, span_hashes

# Distinct pieces remembered per Python worker (about 60 bytes each); then a new table is begun.
CACHE_PIECES = 900_000
# A text with a longer piece is encoded as a whole.
CACHE_PIECE_BYTES = 96
# White space in which a cut before a space or line feed isn't one of the pattern's.
RUN = re.compile(r"\s[ \n]\s|\s[ \n]\Z")

# Signs that stand behind a word and never belong to its pre-token; after an ASCII letter they begin a piece.
SIGNS = frozenset(",.;:!?")




def _byte_mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


CUT_BEFORE = _byte_mask(" \n")
SIGN_BYTE = _byte_mask("".join(SIGNS))
LETTER_BYTE = _byte_mask("".join(chr(c) + chr(c + 32) for c in range(65, 91)))


def _byte_chars() -> dict[int, int]:
    """The characters that byte-level vocabularies write for bytes: printable Latin-1 for itself,
    the others from U+0100 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [b for b in range(256) if b not in plain]
    return {b: 0x100 + i for i, b in enumerate(other)}


BYTE_CHARS = _byte_chars()


class PieceTable:
    """Open-addressing table from 64-bit piece hashes to ids, read and filled vectorised."""

    def __init__(self):
        self.bits = int(2 * CACHE_PIECES + 200_000).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rows = np.zeros(1 << self.bits, np.int32)
        self.n, self.used = 0, 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.blank, self.flat = np.zeros(1 << 16, bool), np.zeros(1 << 18, np.uint32)

    def _slot(self, h: np.ndarray, step: int) -> np.ndarray:
        return ((h >> (63 - self.bits)) + step) & ((1 << self.bits) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        left, step = np.arange(len(h)), 0
        while len(left):
            slot = self._slot(h[left], step)
            at = self.keys[slot]
            hit = at == h[left]
            out[left[hit]] = self.rows[slot[hit]]
            left, step = left[~hit & (at != -1)], step + 1
        return out

    def add(self, h: np.ndarray, ids: list[bytes], blank: np.ndarray) -> None:
        """Adds distinct hashes that it doesn't have."""
        n, flat = self.n + len(h), np.frombuffer(b"".join(ids), "<u4")
        if n > len(self.start):
            self.start, self.length, self.blank = (
                np.concatenate([x, np.zeros(max(n, len(x)), x.dtype)]) for x in (self.start, self.length, self.blank))
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(flat), len(self.flat)), np.uint32)])
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        rows = np.arange(self.n, n)
        self.length[rows], self.blank[rows] = length, blank
        self.start[rows] = self.used + np.cumsum(length) - length
        self.flat[self.used:self.used + len(flat)] = flat
        self.n, self.used = n, self.used + len(flat)
        left, step = np.arange(len(h)), 0
        while len(left):
            slot = self._slot(h[left], step)
            free = self.keys[slot] == -1
            self.keys[slot[free]] = h[left[free]]
            won = self.keys[slot] == h[left]
            self.rows[slot[won]] = rows[left[won]]
            left, step = left[~won], step + 1


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        # a control character between pieces marks where a piece's ids end
        self.mark = np.asarray(self.tok.encode(" \x01", add_special_tokens=False).ids, "<u4")
        # the model alone for pieces that are one run of letters, perhaps with a sign at the end
        self.model = self.tok.model
        self.model._resize_cache(0)
        self.word_ends = bool(self.model.end_of_word_suffix)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        self.signs = {c: self._ids([c])[0] for c in SIGNS}
        self.table = PieceTable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, encoded in one go."""
        ids = np.frombuffer(self._ids([" \x01".join(pieces)])[0], "<u4")
        ends = np.flatnonzero(ids == self.mark[-1]) + 1
        if len(ends) != len(pieces) - 1:  # a piece has the mark
            return self._ids(pieces)
        starts = np.r_[0, ends]
        stops = np.r_[ends - len(self.mark), len(ids)]
        data = ids.tobytes()
        return [data[4 * a:4 * b] for a, b in zip(starts.tolist(), stops.tolist())]

    def _run(self, word: str) -> bytes | None:
        """Ids of a run of letters behind a space, or None if it may not be one pre-token."""
        if not word.isalpha():
            return None
        plain = word.isascii()
        if self.word_ends:
            if not plain and (not is_normalized("NFC", word) or "\u03a3" in word):
                return None
            letters = word.lower()
            if not plain and not letters.isalpha():
                return None
        else:
            letters = "\u0120" + word
        if not plain:
            letters = letters.lstrip("\u0120").encode().decode("latin1").translate(BYTE_CHARS)
            if not self.word_ends:
                letters = "\u0120" + letters
        ids = self.id_bytes
        return b"".join([ids[t.id] for t in self.model.tokenize(letters)])

    def _learn(self, pieces: list[str]) -> list[bytes]:
        out, rest = [], []
        for i, p in enumerate(pieces):
            ids = None
            if p[0] == " ":
                sign = self.signs.get(p[-1])
                ids = self._run(p[1:] if sign is None else p[1:-1])
                if sign is not None and ids is not None:
                    ids += sign
            if ids is None:
                rest.append(i)
            out.append(ids)
        plain = [i for i in rest if pieces[i][0] == " " and not pieces[i][-1].isspace()]
        for lo in range(0, len(plain), 5_000):
            part = plain[lo:lo + 5_000]
            for i, ids in zip(part, self._ids_of_pieces([pieces[i] for i in part])):
                out[i] = ids
        other = [i for i in rest if out[i] is None]
        for i, ids in zip(other, self._ids([pieces[i] for i in other])):
            out[i] = ids
        return out

    def _segment(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(table rows, blank, too long) of the pieces of a byte array; a piece also begins at each of ``starts``."""
        cut = CUT_BEFORE[data]
        cut[1:] |= SIGN_BYTE[data[1:]] & LETTER_BYTE[data[:-1]]
        cut[starts[starts < len(data)]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(data))
        h = span_hashes(data, begin, end)
        table = self.table
        if table.n > CACHE_PIECES:
            self.table = table = PieceTable()
        row = table.find(h)
        lost = np.flatnonzero(row < 0)
        if len(lost):
            new, first = np.unique(h[lost], return_index=True)
            at = lost[first]
            long = end[at] - begin[at] > CACHE_PIECE_BYTES
            new, at = new[~long], at[~long]
            raw = data.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist())]
            blank = np.array([p[:2].isspace() for p in pieces], bool)
            table.add(new, self._learn(pieces), blank)
            row[lost] = table.find(h[lost])
        return begin, row, (row >= 0) & table.blank[row]

    def groups(self, texts: pa.Array, end_id: int | None = None):
        """Yields (first row, last row + 1, ids, ids of each row) over a string array; nulls count as empty.

        ``end_id`` is added to each row.  Long texts are worked off in segments.
        """
        for lo, hi, data, offsets in byte_groups(texts):
            n = hi - lo
            parts = []
            for a, b in _segments(data) if n == 1 else [(0, len(data))]:
                if a < b:
                    inside = offsets[(offsets >= a) & (offsets < b)] - a
                    begin, row, blank = self._segment(data[a:b], np.union1d(inside, [0]))
                    # rows whose white space isn't parted where the pattern parts it, and those with long pieces
                    owner = np.searchsorted(offsets, begin + a, "right") - 1
                    odd = set(owner[row < 0].tolist())
                    for r in [] if self.word_ends else np.unique(owner[blank]).tolist():
                        if RUN.search(data[offsets[r]:offsets[r + 1]].tobytes().decode()):
                            odd.add(r)
                    length = np.where(row >= 0, self.table.length[row], 0)
                    before = np.cumsum(length) - length
                    take = np.repeat(self.table.start[row] - before, length) + np.arange(int(length.sum()))
                    parts.append((self.table.flat[take], np.bincount(owner, length, n).astype(np.int64), odd))
            ids = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint32)
            counts = sum((p[1] for p in parts), np.zeros(n, np.int64))
            odd = set().union(*(p[2] for p in parts))
            if odd:
                rows = np.split(ids, np.cumsum(counts)[:-1])
                for r in odd:
                    text = data[offsets[r]:offsets[r + 1]].tobytes().decode()
                    rows[r] = np.frombuffer(self._ids([text])[0], "<u4")
                counts = np.array([len(x) for x in rows])
                ids = np.concatenate(rows)
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            yield lo, hi, ids, counts

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes."""
        out = []
        for _, _, ids, counts in self.groups(pa.array(texts, pa.string())):
            out += [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])]
        return out


def _segments(data: np.ndarray, most: int = 1 << 19):
    """Cuts a long text before spaces and line feeds into segments of about ``most`` bytes."""
    at = 0
    while at < len(data):
        to = at + most
        while to < len(data):
            gap = np.flatnonzero(np.isin(data[to:to + most], (0x20, 0x0A)))
            if len(gap):
                to += int(gap[0])
                break
            to += most
        yield at, min(to, len(data))
        at = to


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Lets go of a worker's encoders, in steps that encode nothing: the worker lives on."""
    _ENCODERS.clear()
