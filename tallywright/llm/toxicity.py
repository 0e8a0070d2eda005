"""Toxicity by maximum-scoring segments.

Training (on at most ``Training.rows`` labelled rows, those with the least hash of doc_id among labels whose document exists;
so it is bounded and the same at any size). Of rows with one label that agree in both the least and the greatest hash of
five words (most near copies do) one stays, so that a text which is copied often doesn't weigh more than others. Three
quarters of the rest give, for each word and each word head of 3 to 5 bytes, the numbers of toxic and clean
documents that hold it, and from these its log-odds under an informative Dirichlet prior proportional to its share of
all documents (Monroe et al., 2008). Kept are features of a weight of ``least_weight`` documents: as a document's
features weigh 4 * ``usual_words`` at most, these are fewer than 4 * usual_words * rows / least_weight, 5.4 million rows of
three numbers. A word scores as the best lower confidence bound of its kept features, up to the upper bound of the
longest of them, less a drift that makes ordinary text lose.

Scoring, one pass over whole texts: a linear scan (Ruzzo and Tompa, 1999) gives all maximal segments of a
document's word scores. A segment of score S in a text of n words has, after Karlin and Altschul (1990), an
expected number E = K n exp(-lambda S); lambda and K are fitted to the clean ones of the last quarter of the
training rows. Segments with E below ``significant`` are toxic passages. The document's evidence is the sum
of -ln E over its significant segments and of its best segment; a logistic curve on the last quarter
turns both into the probability.

Defined cases: null and empty texts score like a text without any passage; labels that are null or whose document is
missing don't count; of a doc_id that is labelled more than once the largest label counts; without toxic or
without clean training rows every score is the share of toxic rows (0 if there are none); doc_id may be null
(it is then not held out); repeated rows are scored each; of equal segments all count; a very long text is scanned whole, by itself; other
columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm import textkernel as tk
from tallywright.llm.components import own_exchange
from tallywright.llm.scratch import discard, materialise, small_batches

HEADS = (3, 4, 5)


@dataclass(frozen=True)
class Training:
    rows: int = 20_000
    least_weight: float = 3.0
    usual_words: int = 200
    prior: float = 10.0
    highest: float = 7.0
    sure: float = 1.5
    drift: float = 0.5
    significant: float = 0.05


@dataclass(frozen=True)
class Model:
    """``low`` and ``high`` bound each feature's log-odds."""

    keys: np.ndarray
    low: np.ndarray
    high: np.ndarray
    drift: float
    lam: float
    k: float
    significant: float
    weights: tuple[float, float, float]

    def word_scores(self, hashes: list[np.ndarray]) -> np.ndarray:
        """Each word's best lower bound, but no more than the upper bound of its longest known feature."""
        low = np.zeros(len(hashes[0]))
        high = np.zeros(len(hashes[0]))
        if len(self.keys):
            for h in (*hashes[1:], hashes[0]):  # short heads first, the word last
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                hit = self.keys[at] == h
                low[hit] = np.maximum(low[hit], self.low[at[hit]])
                high[hit] = self.high[at[hit]]
        return np.minimum(low, np.maximum(high, 0.0)) - self.drift


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments, in order, by one scan."""
    total, found = 0.0, []  # (start, end, sum before, sum after)
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, left, right = i, before, total
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
        found.append((start, i + 1, left, right))
    return [(a, b, r - l) for a, b, l, r in found]


def positive_parts(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal sign are summed first: (sum, first word) of each, so that the scan's loop is short."""
    sign = scores > 0
    first = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]])) if len(scores) else np.zeros(0, np.int64)
    return (np.add.reduceat(scores, first) if len(scores) else np.zeros(0)), first


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    sums, first = positive_parts(scores)
    ends = np.append(first[1:], len(scores))
    return [(int(first[a]), int(ends[b - 1]), s) for a, b, s in maximal_segments(sums.tolist())]


def evidence(found: list[tuple[int, int, float]], n_words: int, lam: float, k: float, significant: float) -> tuple[float, float, list[tuple[int, int, float]]]:
    """(-ln E of the best segment, sum of -ln E over significant ones, these)."""
    base = np.log(k * max(n_words, 1))
    logs = [(a, b, lam * s - base) for a, b, s in found]
    kept = [x for x in logs if x[2] > -np.log(significant)]
    return max((x[2] for x in logs), default=-base), sum(x[2] for x in kept), kept


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    for lo, hi, data, offsets in tk.string_blocks(texts):
        _, _, hashes, rows = tk.words_and_heads(data, offsets, tk.ALPHANUMERIC, HEADS)
        yield lo, hi, hashes, np.searchsorted(rows, np.arange(hi - lo + 1))


def _counts(usual: int):
    """(text, toxic) to (feature, weight of toxic documents, of clean ones), summed within the task's blocks. A document
    of more than ``usual`` words weighs less, as it holds ordinary words of any kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, hashes, at in _blocks(batch.column(0)):
                keys, label, weight = [], [], []
                for i in range(hi - lo):
                    own = np.unique(np.concatenate([h[at[i] : at[i + 1]] for h in hashes]))
                    own = own[own != 0]
                    keys.append(own)
                    label.append(np.full(len(own), toxic[lo + i], np.float64))
                    weight.append(np.full(len(own), min(1.0, usual / max(at[i + 1] - at[i], 1))))
                if not keys:
                    continue
                distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
                w = np.concatenate(weight)
                pos, every = np.bincount(which, np.concatenate(label) * w, len(distinct)), np.bincount(which, w, len(distinct))
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(pos), pa.array(every - pos)], ["feature", "pos", "neg"])

    return run


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least and the greatest hash of five words, in both of which most near copies agree, behind each row."""
    for batch in batches:
        for lo, hi, data, offsets in tk.string_blocks(batch.column(1)):
            _, _, hashes, rows = tk.words(data, offsets, tk.ALPHANUMERIC)
            grams, of = tk.grams(hashes, rows, 5)
            least, most = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
            if len(of):
                least[of[first]], most[of[first]] = np.minimum.reduceat(grams, first), np.maximum.reduceat(grams, first)
            part = batch.slice(lo, hi - lo)
            short = np.ones(hi - lo, bool)  # texts of fewer words stand for themselves
            short[of[first]] = False
            least[short] = tk.mix(part.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)[short].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least.view(np.int64)), pa.array(most.view(np.int64))], [*batch.schema.names, "least", "most"])


def fit(documents: DataFrame, labels: DataFrame, t: Training = Training()) -> Model:
    """``labels``: doc_id, toxic. Rows in both tables count."""
    spark = documents.sparkSession
    small_batches(spark)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = documents.select(own_exchange(F.col("doc_id").cast("long")).alias("there")).distinct()
    known = known.join(there, F.col("doc_id") == F.col("there"), "left_semi")
    chosen = known.select(F.col("doc_id").alias("id"), (F.col("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(t.rows)
    # At most t.rows rows of two numbers.
    drawn = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "text", "toxic")
    sketched = drawn.mapInArrow(_sketch, "doc_id long, text string, toxic int, least long, most long")
    first = F.min_by(F.struct("doc_id", "text", "toxic"), "doc_id")
    once = sketched.groupBy("least", "most", "toxic").agg(first.alias("r")).select("r.*")
    # Of a doc_id with several texts one is taken, so that the bound on ids is one on rows.
    rows = materialise(once.groupBy("doc_id").agg(F.min_by(F.struct("doc_id", "text", "toxic"), F.xxhash64("text")).alias("r")).select("r.*"), "labelled")
    last = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 3
    n_pos, n_neg = (float(x or 0) for x in rows.where(~last).agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    share = n_pos / max(n_pos + n_neg, 1)
    flat = float(np.log(share / (1 - share))) if 0 < share < 1 else (50.0 if share else -50.0)
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), t.drift, 1.0, 1.0, t.significant, (flat, 0.0, 0.0))
    if not n_pos or not n_neg:
        return empty
    counted = rows.where(~last).select("text", "toxic").mapInArrow(_counts(t.usual_words), "feature long, pos double, neg double").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    kept = counted.where(F.col("pos") + F.col("neg") >= t.least_weight).orderBy("feature").toPandas()
    keys = kept["feature"].to_numpy(np.int64).view(np.uint64)
    pos, neg = kept["pos"].to_numpy(float), kept["neg"].to_numpy(float)
    prior = t.prior * (pos + neg) / (n_pos + n_neg)
    odds = np.log((pos + prior) / (n_pos + t.prior - pos - prior + 1e-9).clip(0.5)) - np.log((neg + prior) / (n_neg + t.prior - neg - prior + 1e-9).clip(0.5))
    spread = np.sqrt(1 / (pos + prior) + 1 / (neg + prior))
    order = np.argsort(keys)
    keys, low, high = keys[order], np.clip(odds - t.sure * spread, 0, t.highest)[order], np.clip(odds + t.sure * spread, 0, t.highest)[order]
    draft = Model(keys, low, high, t.drift, 1.0, 1.0, t.significant, (flat, 0.0, 0.0))
    best = _best_scores(rows.where(last), draft)
    if not len(best) or best["toxic"].nunique() < 2:
        return empty
    clean = best[best["toxic"] == 0]
    lam, k = gumbel(clean["best"].to_numpy(), clean["n"].to_numpy())
    shown = _evidence(rows.where(last), Model(keys, low, high, t.drift, lam, k, t.significant, (flat, 0.0, 0.0)))
    discard(rows)
    weights = logistic(shown[["best", "total"]].to_numpy(), shown["toxic"].to_numpy(float))
    return Model(keys, low, high, t.drift, lam, k, t.significant, weights)


def _best_scores(rows: DataFrame, draft: Model):
    """Of a bounded number of rows: toxic, n words, best segment's score."""
    held = rows.sparkSession.sparkContext.broadcast(draft)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, hashes, at in _blocks(batch.column(0)):
                scores = held.value.word_scores(hashes)
                best = [max((float(s) for _, _, s in segments(scores[at[i] : at[i + 1]])), default=0.0) for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo).cast(pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(best, pa.float64())], ["toxic", "n", "best"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic long, n long, best double").toPandas()


def _evidence(rows: DataFrame, model: Model):
    """Of a bounded number of rows: toxic, and the evidence of the best and of all segments, as ``score`` takes it."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for lo, hi, hashes, at in _blocks(batch.column(0)):
                scores = m.word_scores(hashes)
                x = [evidence(segments(scores[at[i] : at[i + 1]]), int(at[i + 1] - at[i]), m.lam, m.k, m.significant)[:2] for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo).cast(pa.int64()), *(pa.array([float(v[i]) for v in x], pa.float64()) for i in range(2))], ["toxic", "best", "total"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic long, best double, total double").toPandas()


def gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and K from best scores of texts of n words, by moments of best - ln(n) / lambda."""
    n = np.maximum(n, 1)
    lam = 1.0
    for _ in range(50):
        spread = float(np.std(best - np.log(n) / lam))
        new = np.clip(np.pi / np.sqrt(6) / max(spread, 1e-6), 0.2, 3.0)
        if abs(new - lam) < 1e-6:
            break
        lam = float(new)
    mean = float(np.mean(best - np.log(n) / lam))
    return lam, float(np.exp(np.clip(lam * mean - 0.5772156649, -20, 20)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Newton's method on standardised inputs of bounded size."""
    x = squash(x)
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + ridge * np.array([0, 1, 1]) * w
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.diag([1e-6, 1, 1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1]), float(w[2])


def squash(x: np.ndarray) -> np.ndarray:
    """Best evidence between -5 and 10; the sum on a log scale."""
    return np.column_stack([np.clip(x[:, 0], -5, 10) / 5, np.log1p(np.clip(x[:, 1], 0, None))])


def score(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, passages (array of first word, end word, -ln E); map-only."""
    spark = documents.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for lo, hi, hashes, at in _blocks(batch.column(1)):
                scores = m.word_scores(hashes)
                x, passages = np.empty((hi - lo, 2)), []
                for i in range(hi - lo):
                    best, total, kept = evidence(segments(scores[at[i] : at[i + 1]]), int(at[i + 1] - at[i]), m.lam, m.k, m.significant)
                    x[i] = best, total
                    passages.append([{"start": a, "end": b, "evidence": float(e)} for a, b, e in kept])
                p = 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(x)), squash(x)]) @ np.array(m.weights), -50, 50)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(p), pa.array(passages, kind)], ["doc_id", "score", "passages"])

    scored = documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, passages array<struct<start:int,end:int,evidence:double>>")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def held_out(doc_id: str):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def score_held_out(documents: DataFrame, labels: DataFrame, t: Training = Training()) -> DataFrame:
    """Scores of all documents by a model that has seen no held-out label."""
    model = fit(documents, labels.select("doc_id", "toxic").where(~held_out("doc_id")), t)
    return score(documents, model)
