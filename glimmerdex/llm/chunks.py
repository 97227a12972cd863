"""Token ids of whole texts through a bounded cache of their pieces.

Pieces are parts of a text that are tokenised independently of what stands around them,
so a text's ids are the ids of its pieces one after another. Pieces repeat, and each task looks them up instead of encoding
them again. The cache only saves work: when it is full, pieces met only once leave it,
and pieces too long to be worth keeping are encoded each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np

CACHE_PIECES = 200_000
CACHE_IDS = 3_000_000
LONGEST_KEPT = 64
DOCUMENTS_AT_ONCE = 256


class _Codes(dict):
    """Numbers pieces as they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        code = self[piece] = len(self)
        self.new.append(piece)
        return code


def _room(array: np.ndarray, size: int) -> np.ndarray:
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class PieceCache:
    """Ids per piece, flat in one growing array.

    `encode` gives of new pieces how many ids each has, the ids, and whether its begin and
    its end could grow together with white space beside it; documents in which two such
    ends meet are reported. The cache holds `times` times the usual number of pieces.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, list[bool] | bool, list[bool] | bool]], times: int = 1):
        self.encode, self.times = encode, times
        self._empty()

    def _empty(self) -> None:
        self.code = _Codes()
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.start, self.size = (np.zeros(1 << 14, dtype=np.int64) for _ in range(2))
        self.met = np.zeros(1 << 14, dtype=np.int64)
        self.begins, self.ends = (np.zeros(1 << 14, dtype=bool) for _ in range(2))
        self.pieces, self.used = 0, 0

    def _shrink(self) -> None:
        """Keep the pieces met most often, at most half of what there is room for."""
        room = self.times * CACHE_PIECES // 2
        often = 2
        while (self.met[: self.pieces] >= often).sum() > room:
            often *= 2
        kept = [(p, c) for p, c in self.code.items() if isinstance(p, str) and self.met[c] >= often]
        codes = np.array([c for _, c in kept], dtype=np.int64)
        start, size, begins, ends, ids = self.start, self.size, self.begins, self.ends, self.ids
        if size[codes].sum() > self.times * CACHE_IDS // 2:
            kept, codes = [], codes[:0]
        self._empty()
        self.code.update((p, i) for i, (p, _) in enumerate(kept))
        self._store(size[codes], np.concatenate([ids[start[c] : start[c] + size[c]] for c in codes]) if kept else ids[:0])
        self.begins[: len(kept)], self.ends[: len(kept)] = begins[codes], ends[codes]

    def _store(self, sizes: np.ndarray, ids: np.ndarray) -> tuple[int, int]:
        """Append pieces of these sizes, whose ids follow each other; gives their first number and the next free one."""
        at, to = self.pieces, self.pieces + len(sizes)
        self.ids = _room(self.ids, self.used + len(ids))
        self.start, self.size, self.met, self.begins, self.ends = (
            _room(a, to) for a in (self.start, self.size, self.met, self.begins, self.ends)
        )
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[at:to] = sizes
        self.start[at:to] = self.used + np.cumsum(sizes) - sizes
        self.pieces, self.used = to, self.used + len(ids)
        return at, to

    def _add(self, pieces: list[str]) -> None:
        sizes, ids, begins, ends = self.encode(pieces)
        at, to = self._store(sizes, ids)
        self.begins[at:to], self.ends[at:to] = begins, ends

    def look_up(self, documents: list[list[str]]) -> tuple[list[np.ndarray], list[int]]:
        """The ids of each document, given as its pieces in order, and the documents in which open ends meet."""
        counts = np.cumsum([0] + [len(d) for d in documents])
        self._make_room()
        return self._found(np.fromiter(map(self.code.__getitem__, chain.from_iterable(documents)), dtype=np.int64, count=int(counts[-1])), counts)

    def look_up_encoded(self, pieces: list[str], at: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        """The same for documents given by the distinct pieces, the place of every piece among them, and where documents begin."""
        self._make_room()
        return self._found(np.fromiter(map(self.code.__getitem__, pieces), dtype=np.int64, count=len(pieces))[at], counts)

    def _make_room(self) -> None:
        if self.pieces > self.times * CACHE_PIECES or self.used > self.times * CACHE_IDS:
            self._shrink()

    def _found(self, codes: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        missing, self.code.new = self.code.new, []
        if missing:
            self._add(missing)
        self.met[: self.pieces] += np.bincount(codes, minlength=self.pieces)
        sizes = self.size[codes]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.start[codes] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[counts]
        meets = np.flatnonzero(self.ends[codes[:-1]] & self.begins[codes[1:]]) + 1 if len(codes) else np.zeros(0, np.int64)
        inside = meets[~np.isin(meets, counts)]
        open_ = sorted(set((np.searchsorted(counts, inside, "right") - 1).tolist()))
        if any(len(p) > LONGEST_KEPT for p in missing):
            self._forget([p for p in missing if len(p) > LONGEST_KEPT])
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], open_

    def _forget(self, pieces: list[str]) -> None:
        """Long pieces lose their text but not their number: numbers follow the length of the dictionary."""
        for piece in pieces:
            number = self.code.pop(piece)
            self.code[number] = number  # no piece is a number, so nothing asks for this entry


def in_groups(items: Iterable, size: int) -> Iterator[list]:
    group: list = []
    for item in items:
        group.append(item)
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group
