"""Secret scans: fixed patterns plus a battery of randomness tests.

The patterns (assign, access, hex) give the base spans. In the text between them every maximal run of 20 or more symbols
of one alphabet (decimal, hex, base32, base36, base62, base64, base64url) is a hypothesis "this is ordinary text or an
identifier"; runs of several alphabets may nest or overlap, and each is one. ``=`` belongs to no alphabet, so it parts a
name from its value; at the end of a run it is padding. Letters of one case only, with or without punctuation or a first
capital, are words and no hypothesis. The encoding is the smallest alphabet that holds the run; three tests then ask
whether it could be a random string in that encoding:

* chi-squared: are the symbols uniform over the inferred alphabet;
* runs: do symbols of the upper half of the alphabet alternate with the lower half as chance has it;
* serial correlation of neighbouring symbols.

A string that any test rejects (p < ``reject``) is not random. For the rest the evidence against ordinary
text is the likelihood ratio of the uniform model to a fixed letter-frequency model of prose; by Markov's
inequality its inverse is a p-value that falls with length, so short strings cannot reach it. These
p-values go through Benjamini-Hochberg within each document, each weighted by its length (weights of
mean one), at level ``fdr``. Of found runs that nest, the outermost is reported.

Defined cases: a null text is empty and has no spans; a null doc_id stays null; repeated rows are each scanned; offsets are code
points, end exclusive; hypotheses with one p-value are accepted or not together; a very long text is scanned whole, by itself;
other columns are ignored by ``scan`` and kept by ``redact``, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "random")

# Relative frequencies of a-z in English prose, per mille.
PROSE = dict(zip("abcdefghijklmnopqrstuvwxyz", (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1), strict=True))
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_SETS = {k: frozenset(v) for k, v in ALPHABETS.items()}
_RUNS = [re.compile(f"[{re.escape(v)}]{{20,}}") for v in ALPHABETS.values()]


def infer_encoding(value: str) -> str | None:
    """The smallest alphabet that holds all symbols; strings of letters of one case only are words, not codes."""
    symbols = set(value)
    if not any(c.isdigit() for c in symbols) and (value.islower() or value.isupper() or value[1:].islower()):
        return None
    return next((k for k, v in _SETS.items() if symbols <= v), None)


def _tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(value: str, encoding: str) -> tuple[float, float, float]:
    """p-values of the chi-squared, runs and serial-correlation tests under "uniform in this alphabet"."""
    alphabet = ALPHABETS[encoding]
    rank = {c: i for i, c in enumerate(alphabet)}
    x, n, k = [rank[c] for c in value], len(value), len(alphabet)
    counts = [0] * k
    for i in x:
        counts[i] += 1
    chi = sum(c * c for c in counts) * k / n - n
    # The statistic's exact mean k-1 and variance 2(k-1)(n-1)/n; with few symbols per cell a normal tail is nearer than chi-squared's.
    upper = 0.5 * math.erfc((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n) / math.sqrt(2))
    high = [i >= k // 2 for i in x]
    a = sum(high)
    b = n - a
    if not a or not b:
        runs = 2.0 ** (1 - n)
    else:
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = _tail(((1 + sum(p != q for p, q in zip(high, high[1:]))) - mean) / math.sqrt(var)) if var > 0 else 1.0
    m = sum(x) / n
    spread = sum((i - m) ** 2 for i in x)
    serial = _tail(sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / spread * math.sqrt(n)) if spread else 0.0
    return upper, runs, serial


def prose_p_value(value: str, encoding: str) -> float:
    """Markov bound on how often ordinary text looks at least this uniform."""
    log_uniform = -math.log(len(ALPHABETS[encoding]))
    total = 0.0
    for c in value:
        if c.isdigit():
            p = 0.01
        elif c.isalpha():
            p = 0.85 * PROSE[c.lower()] / 1002 * (0.9 if c.islower() else 0.1)
        else:
            p = 0.0125
        total += log_uniform - math.log(p)
    return math.exp(-max(total, 0.0))


def hypotheses(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, end with padding) of every maximal run of one alphabet outside the spans ``taken``, in order."""
    found, at = set(), 0
    for s, e in [*sorted(taken), (len(text), len(text))]:
        for m in CANDIDATE.finditer(text, at, max(s, at)):
            last = m.start() + len(m.group().rstrip("="))
            for run in _RUNS:
                found.update((*x.span(), m.end() if x.end() == last else x.end()) for x in run.finditer(text, m.start(), last))
        at = max(at, e)
    return sorted(found)


def random_spans(text: str, taken: list[tuple[int, int]], fdr: float, reject: float) -> list[tuple[int, int]]:
    found = []
    for s, end, e in hypotheses(text, taken):
        value = text[s:end]
        kind = infer_encoding(value)
        if kind is None:
            continue
        random = min(battery(value, kind)) >= reject
        found.append((prose_p_value(value, kind) if random else 1.0, s, e))
    if not found:
        return []
    mean = sum(e - s for _, s, e in found) / len(found)
    weighted = sorted((p * mean / (e - s), s, e) for p, s, e in found)
    passed = max((i for i, (p, _, _) in enumerate(weighted, 1) if p <= fdr * i / len(weighted)), default=0)
    spans: list[tuple[int, int]] = []
    for s, e in sorted(((s, e) for _, s, e in weighted[:passed]), key=lambda x: (x[0], -x[1])):
        if not spans or e > spans[-1][1]:
            spans.append((s, e))
    return spans


def scan_text(text: str, fdr: float = 1e-4, reject: float = 1e-3) -> list[tuple[int, int, str, int]]:
    """(start, rank of the kind, kind, end), in order."""
    base = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    base += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    base += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    more = random_spans(text, [(s, e) for s, _, _, e in base], fdr, reject)
    return sorted(base + [(s, 3, "random", e) for s, e in more])


def _said(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in spans)


SCAN_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def scan(documents: DataFrame, fdr: float = 1e-4, reject: float = 1e-3) -> DataFrame:
    """Spans of every document; map-only, one pass over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans = scan_text(text.as_py() or "", fdr, reject)
                base = [x for x in spans if x[1] < 3]
                rows.append((*(sum(x[1] == k for x in spans) for k in range(4)), hashlib.sha256(_said(base).encode()).hexdigest(), _said(spans)))
            cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, SCAN_SCHEMA)


def redact_text(text: str, spans: list[tuple[int, int, str, int]]) -> str:
    """Each maximal overlap of spans becomes one placeholder named after its first span's kind."""
    out, at = [], 0
    for s, _, kind, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, text: str = "text", length: str = "n_chars", fdr: float = 1e-4, reject: float = 1e-3) -> DataFrame:
    """The same columns and rows, with every span replaced and ``length`` (where there is such a column) set anew."""
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, lengths = [], batch.column(names.index(length)).to_pylist() if length in names else None
            for i, value in enumerate(batch.column(names.index(text))):
                value = value.as_py()
                if value:
                    spans = scan_text(value, fdr, reject)
                    if spans:
                        value = redact_text(value, spans)
                        if lengths is not None:
                            lengths[i] = len(value)
                new.append(value)
            cols = list(batch.columns)
            cols[names.index(text)] = pa.array(new, batch.column(names.index(text)).type)
            if lengths is not None:
                cols[names.index(length)] = pa.array(lengths, batch.column(names.index(length)).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return documents.mapInArrow(run, documents.schema)
