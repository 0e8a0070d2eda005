"""Packing token ids into windows of fixed size by the sum-of-squares rule (Csirik et al., 2006).

Each partition packs its documents as they come. Full windows are cut off a long document first; its rest
goes to the fill level that minimises the sum of the squared counts of partially filled windows, read off an
array of counts by level (a new window counts as level 0). A piece counts as its length rounded up to ``grain`` ids, so that the
array is short and few windows are open: some hundreds. At the last level a window is done, if no more than ``loss`` of it
is padding; else (many tiny pieces) its level is set to its true fill and it stays open.

Where the lengths can't be packed (all just above half a window, say) the rule would open windows without end. It never has more
than ``most_open``, as many as four for each level: beyond, a rest first fills what is left of the fullest open window, and
what remains of it goes by the rule. At the end of a partition the pieces of the windows still open are laid end to end
and cut at window borders, the last into lengths that are powers of two. Documents are cut only there and where longer than a window.

One pass over the input and no shuffle; partitions are those of the scan, some thousand documents or more each, so what is
open at their end is a small part. A sequence's number is its partition's number times 2^32 plus a count, so a task that
runs again after a loss gives the same rows. A task holds one batch and at most ``most_open`` windows.

Defined cases: a null text is empty and packs as its end id alone; null doc_id stays null; repeated rows are packed each; of levels with one cost
the fullest is taken; a very long text is cut into windows at once; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallywright.llm.scratch import small_batches
from tallywright.llm.token_ids import Encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Piece:
    __slots__ = ("doc", "ids", "of", "start")

    def __init__(self, doc: int | None, start: int, ids: np.ndarray, of: int):
        self.doc, self.start, self.ids, self.of = doc, start, ids, of

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.of), Piece(self.doc, self.start + n, self.ids[n:], self.of)


def length(pieces: list[Piece]) -> int:
    return sum(len(p.ids) for p in pieces)


class SumOfSquares:
    """Online packing; ``done`` collects finished windows as lists of pieces. ``placed`` counts pieces that lie where the rule put them,
    ``cut`` those cut at the bound or laid out at the end."""

    def __init__(self, window: int, grain: int = 4, loss: float = 1 / 32):
        self.window, self.grain, self.loss, self.levels, self.open = window, grain, loss, -(-window // grain), 0
        self.most_open = 4 * self.levels
        self.count = np.zeros(self.levels + 1, np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(self.levels)]
        self.done: list[list[Piece]] = []
        self.placed = self.cut = 0

    def level(self, size: int) -> int:
        """The level (0: a new window) whose choice leaves the least sum of squares; ``size`` in grains."""
        c, w = self.count, self.levels
        cost = 2 * (c[size : w + 1] - c[: w + 1 - size]) + 2
        cost[-1] -= 1 + 2 * c[w]  # a window that gets full isn't counted
        cost[1:][c[1 : w + 1 - size] == 0] = 1 << 60
        cost[0] = 2 * c[size] + 1
        # On a tie the fullest window.
        return len(cost) - 1 - int(cost[::-1].argmin())

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        whole = n - n % w
        for s in range(0, whole, w):
            self.done.append([Piece(doc, s, ids[s : s + w], n)])
        if whole < n:
            self.place(Piece(doc, whole, ids[whole:].copy(), n))

    def _take(self, level: int) -> list[Piece]:
        self.count[level] -= 1
        self.open -= 1
        return self.at[level].pop()

    def _finish(self, pieces: list[Piece]) -> None:
        self.done.append(pieces)
        self.placed += len(pieces)

    def place(self, piece: Piece) -> None:
        size = -(-len(piece.ids) // self.grain)
        level = self.level(size)
        if not level and size < self.levels and self.open >= self.most_open:
            level = next(h for h in range(self.levels - 1, 0, -1) if self.count[h])
            pieces = self._take(level)
            room = self.window - length(pieces)
            if room < len(piece.ids):
                head, piece = piece.cut(room)
                self.cut += 1
                self._finish([*pieces, head])
                return self.place(piece)
        else:
            pieces = self._take(level) if level else []
        pieces.append(piece)
        level += size
        if level >= self.levels:
            fill = length(pieces)
            if self.window - fill <= self.loss * self.window:
                return self._finish(pieces)
            level = -(-fill // self.grain)
        self.at[level].append(pieces)
        self.count[level] += 1
        self.open += 1

    def close(self) -> None:
        """Lay the open windows' pieces end to end, fullest windows first."""
        pieces = [p for level in reversed(self.at) for pieces in level for p in pieces]
        left = sum(len(p.ids) for p in pieces)
        self.at, self.open = [[] for _ in range(self.levels)], 0
        self.cut += len(pieces)
        self.count[:] = 0
        now: list[Piece] = []
        room = size = self._next(left)
        for p in pieces:
            while len(p.ids) >= room:
                head, p = p.cut(room) if len(p.ids) > room else (p, None)
                self.done.append([*now, head])
                left -= size
                now, room = [], (size := self._next(left))
                if p is None:
                    break
            if p is not None:
                now.append(p)
                room -= len(p.ids)

    def _next(self, left: int) -> int:
        return self.window if left >= self.window else 1 << max(left.bit_length() - 1, 0)


def pack(documents: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece (NAMES; with ``with_ids`` also its ids)."""
    small_batches(documents.sparkSession)

    def rows(done: list[list[Piece]], first: int) -> pa.RecordBatch:
        out: list[list] = [[] for _ in NAMES]
        ids = []
        for number, pieces in enumerate(done, first):
            offset = 0
            for p in pieces:
                n = len(p.ids)
                for column, x in zip(out, (p.doc, p.start, n, zlib.crc32(p.ids), p.of, number, offset), strict=True):
                    column.append(x)
                if with_ids:
                    ids.append(p.ids.astype(np.int32))
                offset += n
        arrays = [pa.array(c, pa.int64()) for c in out]
        return pa.RecordBatch.from_arrays([*arrays, *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], [*NAMES, *["ids"] * with_ids])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        packer, encoder = SumOfSquares(window), Encoder.at(tokenizer)
        for batch in batches:
            ids_of = batch.column(0).cast(pa.int64()).to_pylist()
            for lo, hi, ids, offsets in encoder.encode(batch.column(1), end_id):
                ids = ids.astype("<u4", copy=False)
                for doc, s, e in zip(ids_of[lo:hi], offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    packer.add(doc, ids[s:e])
            if packer.done:
                yield rows(packer.done, number)
                number += len(packer.done)
                packer.done = []
        packer.close()
        if packer.done:
            yield rows(packer.done, number)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
