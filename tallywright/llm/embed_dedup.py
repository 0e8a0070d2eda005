"""Near-duplicate vectors by a subspace pigeonhole join, within equal labels, exact at any size.

Unit vectors with cosine >= t differ by a squared distance of at most 2 - 2t. They are rotated onto the principal
axes of a bounded sample (``sample`` vectors with the least hash of vec_id) and split into blocks of ``block``
dimensions; each block gets a part of the squared distance in proportion to its share of the variance. The parts
add up to the whole, so two vectors within the whole are within the part of one block at least. In each
block a range join finds the pairs within its part: vectors lie in cells as wide as the radius on the block's two leading axes,
and only neighbouring cells are compared. The union over the blocks is verified by cosine in double precision on the vectors as given.

Equal vectors of one label are merged first and carry their number. Each label's distinct vectors are dealt into tiles
of at most ``tile`` (and of at most ``NUMBERS`` numbers), and each pair of tiles is a task's group of its own that holds two tiles at
most and returns link counts and a spanning forest, not pairs; so a label that holds a third of all rows is split
like any other. A label of n distinct vectors is sent ceil(n / tile) times: in proportion to n up to one tile, beyond that n^2 / tile.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and vectors with a null
label, link with nothing and are their own component; vectors of different length never link; repeated rows
count as vectors of their own; a null vec_id has a null component unless an equal vector has one; a cosine of exactly the
threshold links; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.components import connected_components, own_exchange
from tallywright.llm.scratch import materialise, small_batches

#: Pairs verified at once, rows of a tile compared at once, distances computed at once, numbers in a tile.
PAIRS, STRIP, DISTANCES, NUMBERS = 1 << 16, 512, 1 << 22, 1 << 22
#: From this share of pairs on, candidates are verified by one matrix product.
DENSE = 0.05


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Rotation:
    """Principal axes, blocks of them, and each block's share of the squared distance."""

    def __init__(self, sample: np.ndarray, block: int):
        width = sample.shape[1]
        values, axes = np.linalg.eigh(np.cov(sample.T).reshape(width, width) if len(sample) > 1 else np.eye(width))
        order = np.argsort(-values)
        self.axes, values = axes[:, order], np.maximum(values[order], 1e-9)
        # Axes are dealt in turn, so that blocks have like shares.
        n = max(1, -(-width // block))
        self.blocks = [np.arange(b, width, n) for b in range(n)]
        self.shares = np.array([values[b].sum() for b in self.blocks]) / values.sum()

    def joins(self, vectors: np.ndarray, budget: float) -> list[RangeJoin]:
        """One range join a block over rotated vectors."""
        return [RangeJoin(vectors[:, columns], float(np.sqrt(budget * share + 1e-6))) for columns, share in zip(self.blocks, self.shares, strict=True)]


class RangeJoin:
    """Vectors of few dimensions in cells of the radius' width on their two leading axes, sorted by cell."""

    def __init__(self, vectors: np.ndarray, radius: float):
        self.radius = radius
        self.low = vectors.min(axis=0)[:2] if len(vectors) else np.zeros(2)
        cells = self._cells(vectors)
        self.width = int(cells[1].max(initial=0)) + 3
        key = cells[0] * self.width + cells[1]
        self.order = np.argsort(key, kind="stable")
        self.keys, self.sorted = key[self.order], vectors[self.order]
        self.squares = (self.sorted * self.sorted).sum(1)
        self.seen = 0

    def _cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers from 1 on the two axes; the second is 0 where there is one axis only."""
        at = [np.floor((vectors[:, a].astype(np.float64) - self.low[a]) / self.radius).astype(np.int64) + 1 for a in range(min(2, vectors.shape[1]))]
        return at[0], at[1] if len(at) > 1 else np.zeros(len(vectors), np.int64)

    def mark(self, vectors: np.ndarray, found: np.ndarray) -> None:
        """Set found[i, j] where vector i is within the radius of the j-th of the join's own."""
        x, y = self._cells(vectors)
        # Cells off the table's edge have no neighbours there but those in reach of the edge.
        inside = (y >= 0) & (y <= self.width - 1)
        rows = np.flatnonzero(inside)
        if not len(rows):
            return
        rows = rows[np.lexsort((y[rows], x[rows]))]
        starts = np.flatnonzero(np.concatenate([[True], (x[rows][1:] != x[rows][:-1]) | (y[rows][1:] != y[rows][:-1])]))
        limit = self.radius * self.radius
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)], strict=True):
            own = rows[lo:hi]
            cx, cy = int(x[own[0]]), int(y[own[0]])
            a = vectors[own]
            squares = (a * a).sum(1)
            for dx in (-1, 0, 1):
                base = (cx + dx) * self.width
                s, e = np.searchsorted(self.keys, (base + max(cy - 1, 0), base + min(cy + 1, self.width - 1) + 1)).tolist()
                step = max(1, DISTANCES // len(own))
                for at in range(s, e, step):
                    part = slice(at, min(at + step, e))
                    apart = squares[:, None] + self.squares[part][None, :] - 2 * (a @ self.sorted[part].T)
                    i, j = np.nonzero(apart <= limit)
                    found[own[i], self.order[part][j]] = True
                    self.seen += apart.size


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least index of each component) after links between a and b."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        label = label.copy()
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def verified(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, found: np.ndarray, cosine: float) -> np.ndarray:
    """The exact links among the candidates ``found``; a, b as given in double precision, na, nb their norms."""
    if found.mean() > DENSE:
        return found & ((a @ b.T) / (na[:, None] * nb[None, :]) >= cosine)
    i, j = np.nonzero(found)
    for at in range(0, len(i), PAIRS):
        x, y = i[at : at + PAIRS], j[at : at + PAIRS]
        close = np.einsum("ij,ij->i", a[x], b[y]) / (na[x] * nb[y]) >= cosine
        found[x[~close], y[~close]] = False
    return found


def _compare(rotations: dict[int, Rotation], cosine: float):
    """Rows (label, width, i, j, tile, vec_id, copies, vector), sorted by the first four, to counts and links."""

    def group(rows: list[tuple], width: int, i: int, j: int) -> tuple[list, list, list]:
        rotation = rotations[width]
        tile = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        if not len(left) or not len(right):
            return [], [], []
        given = np.array([r[3] for r in rows], np.float64)
        norms = np.sqrt((given * given).sum(1))
        turned = (unit(given) @ rotation.axes).astype(np.float32)
        joins = rotation.joins(turned[right], 2 - 2 * cosine)
        copies = np.array([r[2] for r in rows], np.int64)
        count, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for at in range(0, len(left), STRIP):
            part = left[at : at + STRIP]
            found = np.zeros((len(part), len(right)), bool)
            for join, columns in zip(joins, rotation.blocks, strict=True):
                join.mark(turned[part][:, columns], found)
            hit = verified(given[part], given[right], norms[part], norms[right], found, cosine)
            if i == j:
                hit[np.arange(len(part)), np.arange(at, at + len(part))] = False
            count[part] += hit @ copies[right]
            if i != j:
                count[right] += hit.T @ copies[part]
            x, y = np.nonzero(hit)
            label = united(label, part[x], right[y])
        some = np.flatnonzero((count > 0) | (label != np.arange(len(rows))))
        ids = [r[1] for r in rows]
        return [ids[k] for k in some], count[some].tolist(), [ids[k] for k in label[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if rows:
                a, n, b = group(rows, key[1], key[2], key[3])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(b, pa.int64())], ["a", "n", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:-1]]
            vectors = batch.column(batch.num_columns - 1)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(columns[1])]) if columns[1] else np.zeros(1, np.int64)
            for k, (label, width, i, j, tile, vec, copies) in enumerate(zip(*columns, strict=True)):
                if (label, width, i, j) != key:
                    yield from out()
                    key, rows = (label, width, i, j), []
                rows.append((tile, vec, copies, flat[at[k] : at[k + 1]]))
        yield from out()

    return run


def near_duplicates(embeddings: DataFrame, cosine: float = 0.93, block: int = 8, tile: int = 8192, sample: int = 4000) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vec_id, embedding, label."""
    spark = embeddings.sparkSession
    small_batches(spark)
    given = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("l"))
    sound = F.col("l").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    alike = F.when(F.coalesce(sound, F.lit(False)), F.struct(F.col("l"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), F.col("v")).alias("h2")))
    keyed = given.select("vec_id", "v", alike.alias("k")).select("vec_id", "v", "k.*")
    valid = keyed.where("h1 IS NOT NULL")
    merged = valid.groupBy("l", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min_by("v", "vec_id").alias("v"))
    reps = materialise(merged.withColumn("width", F.size("v")).where("rep IS NOT NULL"), "vectors")
    rotations = {}
    for r in reps.select("width").distinct().collect():  # as many as there are vector lengths
        drawn = reps.where(F.col("width") == r["width"]).orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toArrow().column("v").combine_chunks()
        x = drawn.flatten().to_numpy(zero_copy_only=False).reshape(-1, r["width"])
        rotations[r["width"]] = Rotation(unit(x), block)
    shape = reps.groupBy("l", "width").agg(F.ceil(F.count(F.lit(1)) / F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(NUMBERS) / F.col("width"))))).cast("int").alias("tiles"))
    shape = shape.select(F.concat("l", F.lit("")).alias("sl"), own_exchange(F.col("width").cast("long")).alias("sw"), "tiles")
    placed = reps.join(shape, (F.col("l") == F.col("sl")) & (F.col("width").cast("long") == F.col("sw"))).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    paired = paired.select(F.col("l").alias("label"), "width", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", F.col("rep").alias("vec"), "copies", "v")
    dealt = paired.repartition("label", "width", "i", "j").sortWithinPartitions("label", "width", "i", "j")
    found = materialise(dealt.mapInArrow(_compare(rotations, cosine), "a long, n long, b long"), "vector-links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    groups = connected_components(found.select("a", "b"))
    per = reps.select("l", "h1", "h2", "rep", "copies").join(counts.select(own_exchange(F.col("a")).alias("ca"), "n"), F.col("rep") == F.col("ca"), "left").join(groups.select(F.col("node").alias("node"), "component"), F.col("rep") == F.col("node"), "left")
    per = per.select(F.concat("l", F.lit("")).alias("pl"), own_exchange(F.col("h1")).alias("p1"), own_exchange(F.col("h2")).alias("p2"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("c"))
    every = keyed.drop("v").join(per, (F.col("l") == F.col("pl")) & (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2")), "left")
    component = F.coalesce("c", "vec_id")
    return every.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
