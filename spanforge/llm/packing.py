"""Packing documents into token windows by the sum-of-squares rule.

A document's tokens are cut into whole windows and a rest.  Rests are placed online: a level array counts the partially filled windows at each
fill level, and a rest goes to the level whose choice makes the sum of squared counts least (a new window is level zero); ties
go to the fullest window.  Each task packs what it reads, so no text leaves its task.  The rests in windows that are still open at a task's end are
packed once more by the same rule, those of many tasks together (GATHER rests a task).  What is open after that is laid end to end and cut at
window borders, and the last of it at powers of two, which need no padding.  At most OPEN windows are open at a time; beyond that they are laid
end to end at once.

Texts are split at white space, and a word's ids are looked up: the vocabulary's pre-tokeniser never joins across white space.

Defined results: null and empty texts are one piece of the end id; repeated rows are packed each; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import cut, narrow, small_batches, texts_of

CAPACITY, END, OPEN = 4096, 2, 4096
#: Rests left open by tasks that one task of the second pass takes.
GATHER = 50_000
#: Words kept with their ids in a worker; longer words are encoded each time.
WORDS, WORD_CHARS = 800_000, 48
#: Characters that str.split() takes for white space and the vocabulary's pattern does not.
_ODD = re.compile("[\x1c-\x1f]")
#: Letters that str.lower() treats otherwise than the normaliser, which looks at single characters.
_CASE = re.compile("[\u03a3\u0130]")
#: Letters and then marks of ASCII; an apostrophe may join what follows, so it is not among them.
_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


class Encoder(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes.

    A word of letters is encoded by the vocabulary's model alone, lower-cased; a word of letters before marks is that word's ids and the
    marks'; all else goes through the whole tokenizer.  The outcome is the tokenizer's in each case.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = np.array([END], "<u4").tobytes()

    def raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, word: str) -> bytes | None:
        """Ids of a word that the normaliser only lower-cases and the pre-tokeniser leaves whole."""
        if not word.isalpha() or not (word.isascii() or (unicodedata.is_normalized("NFC", word) and not _CASE.search(word))):
            return None
        low = word.lower()
        if low != word:
            return self[low]
        coded = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(coded)])

    def __missing__(self, word: str) -> bytes:
        if (ids := self._letters(word)) is None:
            cut = _MARKS.fullmatch(word)
            ids = self[cut[1]] + self[cut[2]] if cut else self.raw(word)
        if len(word) <= WORD_CHARS:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if len(self) > WORDS:
            self.clear()
        if _ODD.search(text):
            return self.raw(text) + self.end
        return b"".join(map(self.__getitem__, text.split())) + self.end


#: One encoder per worker process and vocabulary, so that tasks that follow each other share its words.
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Pieces are (doc_id, start, ids, doc_tokens); closed windows come out of ``closed`` as lists of pieces."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = OPEN) -> None:
        self.capacity, self.most_open = capacity, most_open
        self.level = np.zeros(capacity + 1, np.int64)
        self.windows: dict[int, list[list[tuple]]] = {}
        self.open = 0
        self.closed: list[list[tuple]] = []

    def choose(self, size: int) -> int:
        """The level whose window, joined by a rest of this size, leaves the least sum of squares."""
        c, n = self.capacity, self.level
        have = np.flatnonzero(n[: c - size + 1])
        to = have + size
        change = 1 - 2 * n[have] + np.where(to < c, 2 * n[np.minimum(to, c - 1)] + 1, 0)
        new = 2 * n[size] + 1
        if len(have) and (least := change.min()) <= new:
            return int(have[np.flatnonzero(change == least)[-1]])
        return 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, width = len(ids) // 4, 4 * self.capacity
        for at in range(0, len(ids) - width + 1, width):
            self.closed.append([(doc_id, at // 4, ids[at : at + width], total)])
        if rest := total % self.capacity:
            self.place((doc_id, total - rest, ids[len(ids) - 4 * rest :], total), rest)

    def place(self, piece: tuple, size: int) -> None:
        at = self.choose(size)
        if at:
            window = self.windows[at].pop()
            self.level[at] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        if at + size == self.capacity:
            self.closed.append(window)
            return
        self.windows.setdefault(at + size, []).append(window)
        self.level[at + size] += 1
        self.open += 1
        if self.open > self.most_open:
            self._lay(last=False)

    def _lay(self, last: bool) -> None:
        """Lay all open windows' pieces end to end, fullest window first, and cut them at window borders."""
        pieces = self.leave()
        left = sum(len(p[2]) for p in pieces) // 4
        window: list[tuple] = []
        room = size = self._size(left, last)
        for doc_id, start, ids, total in pieces:
            while ids:
                part, ids = ids[: 4 * room], ids[4 * room :]
                n = len(part) // 4
                window.append((doc_id, start, part, total))
                start, room, left = start + n, room - n, left - n
                if not room:
                    self.closed.append(window)
                    window = []
                    room = size = self._size(left, last)
        if window:
            at = size - room
            self.windows[at], self.open = [window], 1
            self.level[at] = 1

    def _size(self, left: int, last: bool) -> int:
        return self.capacity if left >= self.capacity or not last or not left else 1 << (left.bit_length() - 1)

    def leave(self) -> list[tuple]:
        """The pieces of all open windows, fullest window first; none is open afterwards."""
        pieces = [p for at in sorted(self.windows, reverse=True) for w in self.windows[at] for p in w]
        self.windows, self.open = {}, 0
        self.level[:] = 0
        return pieces

    def finish(self) -> None:
        self._lay(last=True)


def _rows(packer: Packer, sequence: int) -> tuple[pa.RecordBatch, int]:
    """The closed windows as rows, numbered from sequence on, and the next number."""
    out = []
    for window in packer.closed:
        offset = 0
        for doc_id, start, ids, total in window:
            out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, None))
            offset += len(ids) // 4
        sequence += 1
    packer.closed = []
    return _batch(out), sequence


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * (len(names) + 1)
    return pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.binary())], [*names, "ids"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its document, place there, length, checksum of its ids, sequence and place there."""
    schema = SCHEMA + ", ids binary"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(tokenizer), Packer(capacity)
        sequence = TaskContext.get().partitionId() << 36
        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                packer.add(doc_id, own.ids(text))
            if packer.closed:
                rows, sequence = _rows(packer, sequence)
                yield rows
        left = packer.leave()
        for i in range(0, len(left), 256):
            yield _batch([(doc_id, start, len(ids) // 4, zlib.crc32(ids), total, None, None, ids) for doc_id, start, ids, total in left[i : i + 256]])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity)
        sequence = (1 << 62) + (TaskContext.get().partitionId() << 36)
        for batch in batches:
            for doc_id, start, ids, total in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True):
                packer.place((doc_id, start, ids, total), len(ids) // 4)
            if packer.closed:
                rows, sequence = _rows(packer, sequence)
                yield rows
        packer.finish()
        if packer.closed:
            yield _rows(packer, sequence)[0]

    pieces = cut(narrow(docs, "doc_id", "text").mapInArrow(first, schema))
    left = pieces.where("sequence_id IS NULL")
    tasks = max(1, -(-left.count() // GATHER))
    again = left.coalesce(tasks).mapInArrow(second, schema)
    return pieces.where("sequence_id IS NOT NULL").unionByName(again).drop("ids")
