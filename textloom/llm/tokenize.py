"""Token ids of whole texts through a tokenizer file, shared by the writers and packers."""

from __future__ import annotations

import os

import numpy as np

from textloom.llm.common import RunHasher, slabs

# Distinct pieces whose ids one Python worker keeps before it starts anew; those of one slab are kept whatever their number.
MAX_PIECES = 500_000
# Pieces given to the tokenizer at once; it holds offsets and strings of each until they are copied.
PIECES_AT_ONCE = 4096
END_ID = 2

# Byte classes of the public splitting rule of byte-level vocabularies. Letters hold both bytes of the
# Latin-1 letters. 0: a text with this byte is given to the tokenizer as a whole.
LETTER, DIGIT, MARK, BLANK, LINE = 1, 2, 3, 4, 5
CLASSES = np.zeros(256, np.uint8)
CLASSES[33:127] = MARK
CLASSES[65:91] = CLASSES[97:123] = LETTER
CLASSES[48:58] = DIGIT
CLASSES[32], CLASSES[10] = BLANK, LINE
CLASSES[ord("'")] = 0
CLASSES[0x80:0xC0] = LETTER
CLASSES[0xC3] = LETTER


def differing(
    a: np.ndarray, a_first: np.ndarray, a_last: np.ndarray, b: np.ndarray, b_first: np.ndarray, b_last: np.ndarray
) -> np.ndarray:
    """For each pair of byte runs, whether they differ."""
    size = a_last - a_first
    out = size != b_last - b_first
    size = np.where(out, 0, size)
    before = np.cumsum(size) - size
    step = np.arange(size.sum())
    unlike = a[step + np.repeat(a_first - before, size)] != b[step + np.repeat(b_first - before, size)]
    if unlike.any():
        out[np.unique(np.searchsorted(before + size, np.flatnonzero(unlike), "right"))] = True
    return out


class Encoder:
    """Encode texts as the tokenizer does, each distinct piece once.

    The tokenizer merges inside pieces of its splitting rule only: a run of letters, digits or other
    marks with the blank before it, or a line end. So the ids of a text are those of its pieces in
    order. Pieces are cut and looked up by 64-bit hash in numpy and compared byte by byte; new ones go through the tokenizer. A text
    that holds anything else (apostrophes, letters outside Latin-1, neighbouring white space, the
    string of a special token) goes through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        # A task has one core; threads of the tokenizer would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        # The pieces themselves, to be compared with those of equal hash.
        self.bytes = np.zeros(0, np.uint8)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        parts, count = [self.ids], np.zeros(len(pieces), np.int64)
        for a in range(0, len(pieces), PIECES_AT_ONCE):
            some = [piece.decode() for piece in pieces[a : a + PIECES_AT_ONCE]]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            count[a : a + len(some)] = [len(ids) for ids in encoded]
            parts.append(np.array([i for ids in encoded for i in ids], np.uint32))
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate(parts)
        size = np.array([len(piece) for piece in pieces], np.int64)
        begin = len(self.bytes) + np.cumsum(size) - size
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), np.uint8)])
        order = np.argsort(both := np.concatenate([self.hashes, hashes]), kind="stable")
        self.hashes = both[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _unusual(self, raw: np.ndarray, cls: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text, whether it has to go through the tokenizer as a whole."""
        bad = cls == 0
        after = raw[:-1] == 0xC3
        tail = (raw >= 0x80) & (raw < 0xC0)
        bad[1:] |= tail[1:] & ~after
        bad[1:] |= after & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        space = cls >= BLANK
        bad[1:] |= space[1:] & space[:-1]
        bad[1:] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
        # A pair across two texts may mark the second one; that only sends it the longer way.
        total = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(bad, out=total[1:])
        return total[bounds[1:]] > total[bounds[:-1]]

    def _slab(self, raw: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        cls = CLASSES[raw]
        unusual = self._unusual(raw, cls, bounds)
        space = cls >= BLANK
        starts = space.copy()
        starts[0] = True
        starts[1:] |= (cls[1:] != cls[:-1]) & (cls[:-1] != BLANK)
        starts[bounds[:-1][bounds[:-1] < len(raw)]] = True
        if unusual.any():
            inside = np.repeat(unusual, np.diff(bounds))
            starts &= ~inside
        first = np.flatnonzero(starts)
        # A piece ends where the next one starts, or with its text.
        text_of = np.searchsorted(bounds, first, "right") - 1
        last = np.minimum(np.append(first[1:], len(raw)), bounds[text_of + 1])
        distinct, where, back = np.unique(RunHasher(raw)(first, last), return_index=True, return_inverse=True)
        # Pieces of one hash have to be one piece; a text with another one goes the longer way.
        same = where[back]
        other = differing(raw, first, last, raw, first[same], last[same])
        new = (at := self._find(distinct)) < 0
        if new.any():
            if len(self.hashes) + int(new.sum()) > MAX_PIECES:
                self._clear()
                new[:] = True
            pick = where[new]
            self._learn(distinct[new], [raw[a:b].tobytes() for a, b in zip(first[pick].tolist(), last[pick].tolist())])
            at = self._find(distinct)
            assert (at >= 0).all()
        begin = self.begin[at]
        other |= differing(raw, first[where], last[where], self.bytes, begin, begin + self.size[at])[back]
        unusual[text_of[other]] = True
        counts, begins = self.count[at][back], self.first[at][back]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(begins - (ends - counts), counts) + np.arange(total)]
        pieces_before = np.searchsorted(first, bounds, "left")
        cuts = np.concatenate([[0], ends])[pieces_before]
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for i in np.flatnonzero(unusual).tolist():
            text = raw[bounds[i] : bounds[i + 1]].tobytes().decode()
            out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return out

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, -1 for a new one."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of each text of an Arrow string column, as unsigned 32-bit arrays, in order."""
        for a, b in slabs(offsets):
            lo, hi = int(offsets[a]), int(offsets[b])
            if lo == hi:
                yield from [np.zeros(0, np.uint32)] * (b - a)
            else:
                yield from self._slab(data[lo:hi], offsets[a : b + 1] - lo)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
