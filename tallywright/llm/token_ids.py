"""Token ids of whole texts, fast, for byte-level BPE files of the tokenizers library.

The library encodes pretoken by pretoken (words with their leading space, numbers, marks, white space), and
few pretokens are new. So blocks of texts are cut into pretokens with array operations, each distinct one is
given to the library's model once per worker (as the signs that stand for its bytes, which is what the library's own
pipeline hands to it), and ids are gathered from there. Character classes are asked from the
library too, so its Unicode version decides. Texts that hold an added token's string, and tokenizers with any
other pipeline, go through the library as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallywright.llm import textkernel as tk

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
#: Distinct pretokens a worker remembers before it starts anew.
MOST_KNOWN = 1 << 21


def _signs() -> dict[int, str]:
    """The sign for each byte in byte-level vocabularies: printable Latin-1 signs stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SIGNS = _signs()
_PLAIN = tk.Alphabet(np.ones(256, bool), lower=False)
_encoders: dict[str, Encoder] = {}
_EMPTY = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    keys = np.concatenate([a[0], b[0]])
    order = np.argsort(keys, kind="stable")
    return (keys[order], np.concatenate([a[1], b[1]])[order], np.concatenate([a[2], b[2]])[order])


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_pretoken = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.forget()

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def forget(self) -> None:
        self.main = self.recent = _EMPTY
        self.ids, self.used = np.zeros(0, np.uint32), 0

    def class_of(self, char: str) -> int:
        pieces = lambda s: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(s))
        return LETTER if pieces("a" + char) == 1 else NUMBER if pieces("1" + char) == 1 else OTHER if pieces("!" + char) == 1 else SPACE

    def char_classes(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if (found == UNKNOWN).any():
            for p in np.unique(points[found == UNKNOWN]).tolist():
                self.classes[p] = self.class_of(chr(p))
            found = self.classes[points]
        return found

    def pretokens(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Start bytes of all pretokens of a block."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80) if len(points) < len(data) else None
        edges = offsets[:-1][np.diff(offsets) > 0]
        if byte_at is not None:
            edges = np.searchsorted(byte_at, edges)
        kind, n = self.char_classes(points), len(points)
        fresh = np.ones(n, bool)
        fresh[1:] = kind[1:] != kind[:-1]
        fresh[edges] = True
        runs = np.flatnonzero(fresh)
        ends = np.append(runs[1:], n)
        at_edge = np.zeros(n + 1, bool)
        at_edge[edges] = at_edge[n] = True
        start = fresh.copy()
        follows = np.zeros(n, bool)  # a run right after white space of its own text
        inner = runs[(kind[runs] != SPACE) & ~at_edge[runs]]
        after_space = inner[kind[inner - 1] == SPACE]
        start[after_space[points[after_space - 1] == 32]] = False
        follows[after_space[points[after_space - 1] == 32]] = True
        space = kind[runs] == SPACE
        last = ends[space] - 1
        start[last[~at_edge[ends[space]]]] = True
        # 's 't 'm 'd 're 've 'll, where the apostrophe is a run of its own and no space is before it.
        mark = runs[(kind[runs] == OTHER) & (ends - runs == 1) & (points[runs] == 39)]
        mark = mark[~follows[mark] & ~at_edge[mark + 1]]
        mark = mark[kind[mark + 1] == LETTER]
        if len(mark):
            a = points[mark + 1]
            b = np.where((mark + 2 < n) & ~at_edge[np.minimum(mark + 2, n)], points[np.minimum(mark + 2, n - 1)], 0)
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            mark, size = mark[one | two], np.where(one, 2, 3)[one | two]
            start[mark + 1] = False
            past = mark + size
            start[past[past < n]] = True
        where = np.flatnonzero(start)
        return byte_at[where] if byte_at is not None else where

    def learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        """New pretokens go to a small sorted table that joins the large one once it has an eighth of its size."""
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(text.decode("latin-1").translate(_SIGNS))] for text in texts]
        lengths = np.array([len(x) for x in ids], np.int64)
        starts = self.used + np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(self.used + len(flat) + 65536, np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.recent = _merged(self.recent, (hashes, starts, lengths))
        if len(self.recent[0]) * 8 > len(self.main[0]):
            self.main, self.recent = _merged(self.main, self.recent), _EMPTY

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known?, start, length) of each."""
        known, starts, lengths = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for keys, s, n in (self.main, self.recent):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                known |= hit
                starts[hit], lengths[hit] = s[at[hit]], n[at[hit]]
        return known, starts, lengths

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and their number by text."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        start = self.pretokens(data, offsets)
        end = np.append(start[1:], len(data))
        up, down = tk.powers(len(data) + 1)
        prefix = np.empty(len(data) + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(_PLAIN.values[data] * up[: len(data)], out=prefix[1:])
        hashes = tk.mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.main[0]) + len(self.recent[0]) + len(distinct) > MOST_KNOWN:
            self.forget()
        known, starts, lengths = self.find(distinct)
        if not known.all():
            raw = data.tobytes()
            self.learn(distinct[~known], [raw[start[i] : end[i]] for i in first[~known].tolist()])
            known, starts, lengths = self.find(distinct)
        lengths = lengths[which]
        ids = self.ids[tk.ragged(starts[which], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(total[np.searchsorted(start, offsets)])

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets) by blocks of rows; null is empty; ``end_id`` closes each text."""
        for lo, hi, data, offsets in tk.string_blocks(texts):
            raw = data.tobytes() if not self.by_pretoken or self.added else b""
            if not self.by_pretoken:
                ids, counts = self.whole([raw[s:e].decode("utf-8") for s, e in zip(offsets[:-1], offsets[1:], strict=True)])
            else:
                ids, counts = self.block(data, offsets)
                if any(a in raw for a in self.added):
                    parts = np.split(ids, np.cumsum(counts)[:-1])
                    for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                        if any(a in raw[s:e] for a in self.added):
                            parts[i], n = self.whole([raw[s:e].decode("utf-8")])
                            counts[i] = n[0]
                    ids = np.concatenate(parts)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                counts = counts + 1
            yield lo, hi, ids, np.concatenate([[0], np.cumsum(counts)])
