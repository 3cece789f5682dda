"""A bounded per-worker table of word scores.

Corpora repeat words, so models that are additive over words are evaluated once per distinct word and then
looked up.  The table holds at most ``limit`` words; when it would grow beyond that it starts anew, which costs
time and never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class _Ids(dict):
    """word -> row; an unseen word gets the next row and is remembered as pending."""

    def __init__(self) -> None:
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.pending.append(word)
        return row


class WordTable:
    def __init__(self, score: Callable[[list[str]], np.ndarray], width: int, limit: int = 400_000) -> None:
        self.score, self.width, self.limit = score, width, limit
        self._reset()

    def _reset(self) -> None:
        self.ids = _Ids()
        self.rows = np.zeros((4096, self.width))

    def lookup(self, words: list[str]) -> np.ndarray:
        """One row of scores per word, in order."""
        if len(self.ids) > self.limit:
            self._reset()
        at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if new := self.ids.pending:
            first = len(self.ids) - len(new)
            while len(self.rows) < len(self.ids):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                self.rows[first + i : first + i + len(part)] = self.score(part)
            self.ids.pending = []
        return self.rows[at]


def flat_codes(words: list[str], left: str = "", right: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Code points of the wrapped words laid end to end, and each wrapped word's length."""
    joined = "".join(f"{left}{w}{right}" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + len(left) + len(right)
    return codes, lengths


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit hashes (splitmix)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
