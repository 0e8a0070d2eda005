"""Quality classifier from weak labels.

Eleven heuristic labellers look at a whole text and vote good, bad or nothing; every kind of junk is in the view of two
of them at least. How often each pattern of votes occurs is counted over all documents (at most 3^11 patterns).
Expectation-maximisation on these counts (Dawid and Skene, 1979, with several latent classes) estimates how often each
labeller votes bad in each class, and so the posterior of every pattern. A class is bad if two labellers or more
vote bad on most of its texts: a labeller whose bad votes no other one confirms errs on good texts, and loses.
A linear scorer over hashed features (kinds of neighbouring bytes, repetition) is then trained on the posteriors of at
most ``Training.rows`` different texts, those with the least hash, and scores all documents.

Defined cases: null and empty texts get no vote and the score of an empty text; a text without any vote is kept; with fewer than
two kinds of vote patterns, or one class only, everything is kept; repeated rows and null doc_id are scored like any, and count
once in training; a tie of hashes is a tie of texts; a very long text is examined whole, by itself; other columns are ignored
by ``score`` and kept by ``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm import textkernel as tk
from tallywright.llm.scratch import small_batches

LABELLERS = ("signs", "capitals", "exclamations", "separators", "repeats", "bigrams", "sentences", "lengths", "lines", "glued", "triples")
GOOD, NOTHING, BAD = 2, 1, 0
CLASSES = 16
WIDTH = 1024
#: The pattern in which no labeller votes.
SILENT = sum(NOTHING * 3**i for i in range(len(LABELLERS)))
_LINES = tk.Alphabet(np.arange(256) != 10, lower=False)


@dataclass(frozen=True)
class Training:
    rows: int = 10_000
    rounds: int = 100
    steps: int = 300
    rate: float = 0.5
    ridge: float = 1e-5
    reject_below: float = 0.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    reject_below: float


def _byte_kinds() -> np.ndarray:
    """Lower, upper, digit, space, newline, full stop, comma, exclamation, question, quotes and brackets, dash, #$%&*, |, other signs, beyond ASCII."""
    kind = np.full(256, 13, np.int64)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, 14
    for i, chars in ((3, b" \t\r\x0b\x0c"), (4, b"\n"), (5, b"."), (6, b",;:"), (7, b"!"), (8, b"?"), (9, b"\"'()"), (10, b"-"), (11, b"#$%&*"), (12, b"|")):
        kind[list(chars)] = i
    return kind


_KIND = _byte_kinds()
_PLACE = (tk.mix(np.arange(CLASSES**3, dtype=np.uint64) + np.uint64(1)) % np.uint64(WIDTH)).astype(np.int64)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeated(hashes: np.ndarray, rows: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Of each row, the weight in values that stand earlier in the row too."""
    key = tk.mix(hashes ^ tk.mix(rows.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(rows[again], weight[again], n)


def examine(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, votes as one number in base 3, hashed features) by blocks."""
    for lo, hi, data, offsets in tk.string_blocks(texts, tk.WORK_BYTES):
        n = hi - lo
        row = np.repeat(np.arange(n), np.diff(offsets))
        kind = _KIND[data]
        counts = np.bincount(row * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
        start, end, hashes, of = tk.words(data, offsets, tk.NOT_SPACE)
        words = np.bincount(of, minlength=n)
        real = np.concatenate([[0], np.cumsum(np.isin(kind, (0, 1, 2, 14)))])
        blank = np.bincount(of[real[end] == real[start]], minlength=n)
        same = np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=n)
        pairs, pair_of = tk.grams(hashes, of, 2)
        twice = _repeated(pairs, pair_of, np.ones(len(pairs)), n)
        ends = np.bincount(of[np.isin(data[end - 1], list(b".,;:?!"))], minlength=n) if len(end) else np.zeros(n)
        a, b, line_hash, line_of = tk.words(data, offsets, _LINES)
        sign = np.isin(kind, (11, 12, 13))
        odd = np.concatenate([[0], np.cumsum(sign)])
        glued = np.bincount(of[(real[end] > real[start]) & (odd[end] > odd[start])], minlength=n)
        thrice = np.zeros(len(data) + 1, np.int64)
        if len(data) > 2:
            np.cumsum(sign[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]), out=thrice[3:])
        tripled = np.bincount(of[thrice[end] > thrice[np.minimum(start + 2, end)]], minlength=n)
        line_bytes = np.bincount(line_of, b - a, n)
        line_again = _repeated(line_hash, line_of, (b - a).astype(float), n)
        letters = counts[:, 0] + counts[:, 1]
        solid = counts.sum(1) - counts[:, 3] - counts[:, 4]

        def vote(bad: np.ndarray, good: np.ndarray, heard: np.ndarray) -> np.ndarray:
            return np.where(heard & bad, BAD, np.where(heard & good, GOOD, NOTHING))

        any_, some, many = words > 0, words >= 20, words >= 40
        signs, caps, shouts = _share(counts[:, 11] + counts[:, 12] + counts[:, 13], solid), _share(counts[:, 1], letters), _share(counts[:, 7], words)
        gaps, stutter, echo, stops, size, again = _share(blank, words), _share(same, words), _share(twice, words), _share(ends, words), _share(solid, words), _share(line_again, line_bytes)
        votes = [
            vote(signs > 0.08, signs < 0.04, any_),
            vote(caps > 0.4, caps < 0.2, letters >= 20),
            vote(shouts > 0.2, shouts < 0.05, some),
            vote(gaps > 0.15, gaps < 0.05, some),
            vote(stutter > 0.25, stutter < 0.1, some),
            vote(echo > 0.5, echo < 0.3, many),
            vote(stops > 0.7, (stops > 0.02) & (stops < 0.45), many),
            vote((size > 14) | (size < 2.5), (size > 3.2) & (size < 11), some),
            vote(again > 0.4, again < 0.2, many),
            vote(_share(glued, words) > 0.2, _share(glued, words) < 0.05, any_),
            vote(_share(tripled, words) > 0.15, _share(tripled, words) < 0.05, any_),
        ]
        code = sum(v * 3**i for i, v in enumerate(votes))
        inside = np.ones(max(len(data) - 2, 0), bool)
        if len(data) > 2:
            inside = row[:-2] == row[2:]
        triple = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:] if len(data) > 2 else np.zeros(0, np.int64)
        x = np.bincount(row[:-2][inside] * WIDTH + _PLACE[triple[inside]] if len(data) > 2 else np.zeros(0, np.int64), minlength=n * WIDTH).reshape(n, WIDTH).astype(np.float32)
        x = np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1))
        for i, part in enumerate((stutter, echo, again)):
            where = int(tk.mix(np.array([7_000_000 + i], np.uint64))[0] % np.uint64(WIDTH))
            x[:, where] += 2 * part
        yield lo, hi, code.astype(np.int64), x


def unpack(codes: np.ndarray) -> np.ndarray:
    return np.column_stack([codes // 3**i % 3 for i in range(len(LABELLERS))])


def expectation_maximisation(votes: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good by pattern, P(bad | class, it votes) as labellers x (bad, good), prior of good).

    One latent class starts from the texts without a bad vote, and one for each labeller from those that it votes bad on, a
    text's share being split evenly; from there only the votes count. Not to vote says nothing of the class. Junk
    comes in kinds and each labeller knows few of them, which two classes can't express. A class
    on which fewer than two labellers vote bad most of the time is a mere error of one, and so is good.
    """
    bad, good = (votes == BAD).astype(float), (votes == GOOD).astype(float)
    n, classes = len(votes), votes.shape[1] + 1
    share = np.empty((n, classes))
    share[:, 0] = bad.sum(1) == 0
    share[:, 1:] = bad / np.maximum(bad.sum(1, keepdims=True), 1)
    share = 0.98 * share + 0.02 / classes
    for _ in range(rounds):
        old = share
        held = (share * weight[:, None]).T
        mass = held.sum(1)
        b, g = held @ bad, held @ good
        rates = (b + 0.5) / (b + g + 1.0)
        logs = np.log((mass + 1) / (mass.sum() + classes)) + bad @ np.log(rates).T + good @ np.log(1 - rates).T
        share = np.exp(logs - logs.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        if np.abs(share - old).max() < 1e-6:
            break
    confirmed = (rates > 0.5).sum(1) >= 2
    post = share[:, ~confirmed].sum(1)
    held = np.stack([1 - post, post]) * weight
    b, g = held @ bad, held @ good
    return post, ((b + 0.5) / (b + g + 1.0)).T, float(held[1].sum() / weight.sum())


def fit(documents: DataFrame, t: Training = Training()) -> Model:
    small_batches(documents.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, code, _ in examine(batch.column(0)):
                kinds, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], ["code", "n"])

    # At most 3^11 rows.
    patterns = documents.select("text").mapInArrow(vote, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    keep_all = Model(np.zeros(WIDTH, np.float32), 10.0, t.reject_below)
    if len(patterns) < 2:
        return keep_all
    codes = patterns["code"].to_numpy()
    post, _, _ = expectation_maximisation(unpack(codes), patterns["n"].to_numpy(float), t.rounds)
    if post.min() > 0.5 or post.max() < 0.5:
        return keep_all
    hashed = documents.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    drawn = hashed.select(F.col("h").alias("drawn")).distinct().orderBy("drawn").limit(t.rows)
    # Of texts with one hash one is taken: at most t.rows rows, however often a text is repeated.
    sample = hashed.join(F.broadcast(drawn), F.col("h") == F.col("drawn")).groupBy("h").agg(F.first("text").alias("text")).select("text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, code, x in examine(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], ["code", "x"])

    # t.rows rows of 2 * WIDTH bytes.
    rows = sample.mapInArrow(features, "code long, x binary").toArrow()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float16).reshape(-1, WIDTH).astype(np.float32)
    y = post[np.searchsorted(codes, rows.column("code").to_numpy())].astype(np.float32)
    weights, bias = linear(x, y, t)
    return Model(weights, bias, t.reject_below)


def linear(x: np.ndarray, y: np.ndarray, t: Training) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, classes weighted alike, by accelerated gradient descent from zero."""
    good = float(y.mean())
    weight = np.where(y > 0.5, 0.5 / max(good, 1e-3), 0.5 / max(1 - good, 1e-3)).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    vw, vb = w.copy(), b
    for step in range(t.steps):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        r = weight * (p - y) / len(y)
        nw, nb = vw - t.rate * 10 * (x.T @ r + t.ridge * vw), vb - t.rate * 10 * r.sum()
        pull = step / (step + 3)
        vw, vb = nw + pull * (nw - w), nb + pull * (nb - b)
        w, b = nw, nb
    return w, float(b)


def _scorer(model: Model, spark):
    held = spark.sparkContext.broadcast(model)

    def scores(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        m = held.value
        for lo, hi, code, x in examine(texts):
            yield lo, hi, code, 1 / (1 + np.exp(-np.clip(x.astype(np.float64) @ m.weights + m.bias, -50, 50)))

    return scores


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (of good), kept, n_good and n_bad votes; map-only."""
    small_batches(documents.sparkSession)
    scores = _scorer(model, documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, code, p in scores(batch.column(1)):
                v = unpack(code)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(p), pa.array((p >= model.reject_below) | (code == SILENT)), *(pa.array((v == x).sum(1)) for x in (GOOD, BAD))], ["doc_id", "score", "kept", "n_good", "n_bad"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, kept boolean, n_good long, n_bad long")


def keep_good(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model keeps, with all their columns; map-only."""
    small_batches(documents.sparkSession)
    scores, at = _scorer(model, documents.sparkSession), documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [(p >= model.reject_below) | (code == SILENT) for _, _, code, p in scores(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return documents.mapInArrow(run, documents.schema)
