"""Exact n-gram Jaccard self-join by universe-partition pigeonhole; result: groups of linked documents.

A document is the set of its distinct k-word shingles (64-bit hashes). Sizes fall into bands; a set can link
only within its band or with the next. For a band whose largest set has ``mx`` shingles two linked sets differ
in at most ``H = 2 mx (1-t)/(1+t)`` tokens, for a threshold t. Token hashes cut the universe into m segments:

* plan "segments": m = H + 1 + T. At least T + 1 segments of two linked sets are equal.
* plan "deletions" (small sets): 2 m >= H + 1, and some segment pair differs in at most one token, so equal
  segments or one-deletion neighbourhoods meet. Here T = 0.
* plan "subsets" (small sets): m > H, and some m - H segments are equal; each subset of so many is a key. Here T = 0.

The plan and the slack T are chosen per band by cost: keys per set plus the expected cost of sets that would
be left with near-empty segments. Then the slack is spent by real cost: of each set's keys those T that most
sets share are dropped. Both sets of a linked pair rank their common keys alike, so of T + 1 common keys the
rarest stays with both; a set that shares at most T keys with any others links with none of them. That is
how a passage which many documents quote costs nothing.

Sets that share a remaining key form units (components of the candidate graph). They are verified exactly, by matrix products:

1. Up to ``HUBS`` sets of each unit, those with the least ids of as many hash slots, meet every set of the unit. The unit's sets
   lie in blocks of bounded size, each in one; only the hubs are sent to all of them. That decides a unit of few sets.
2. In a larger unit, sets that the hubs have already joined into its largest component needn't meet each other. Only the
   others ("outliers") still meet every set of the unit, block by block.

So a group of G near copies is sent about once, not G / block times; what is left of the square is outliers times sets. Only a
spanning forest of the links leaves a task, never pairs. Equal sets were merged before, by 128-bit digest and size.

Defined cases: no words or null text: an empty set, linked with nothing; fewer than k words: the whole
sequence is the one shingle; a null doc_id is its own row with a null component unless its set equals
another's; repeated rows stay repeated in the result; a similarity of exactly the threshold links; a very long text is one set,
in a block of its own; columns other than doc_id and text are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm import textkernel as tk
from tallywright.llm.components import connected_components, own_exchange
from tallywright.llm.scratch import discard, materialise, small_batches

#: Weight of a set that may be left with near-empty segments, in keys; with empty subsets of segments. A subset's key counts more
#: than others, as it holds part of the set only.
CROWD, CROWD_OF_SUBSETS, WEAK = 1e5, 1e4, 8
#: Sets of a unit that meet all others; sets and tokens of a block at most; blocks of the first step in one of the second.
HUBS, MOST_SETS, MOST_TOKENS, JOINED = 16, 256, 1 << 20, 4
#: Rows of places (some 40 bytes each) that are broadcast in the second step.
FEW = 100_000
SEGMENTS, DELETIONS, SUBSETS = 0, 1, 2
#: Keys of a set under the plan "subsets"; where it would need more, another plan is taken.
MOST_SUBSETS = 100


def _poisson_above(mean: float, t: int) -> float:
    term = total = math.exp(-mean)
    for i in range(1, t + 1):
        term *= mean / i
        total += term
    return max(0.0, 1.0 - total)


class Bands:
    """Segment numbers, slack and plan by size band for one threshold."""

    def __init__(self, numerator: int, denominator: int):
        self.threshold = Fraction(numerator, denominator)
        self.lows, self.plans = [1], []

    def _plan(self, low: int, most: int) -> tuple[int, int, int, int]:
        """(segments, slack, plan, segments of a key); no segments where only equal sets link."""
        t = self.threshold
        differ = math.floor(2 * most * (1 - t) / (1 + t))
        if differ == 0:
            return 0, 0, SEGMENTS, 1
        least = math.ceil(low * t)
        m = (differ + 2) // 2
        # At most one of ``least`` tokens in a segment.
        bare = (1 - 1 / m) ** least + least / m * (1 - 1 / m) ** (least - 1)
        best = (most + m + CROWD * min(1.0, m * bare), (m, 0, DELETIONS, 1))
        for slack in range(1 + differ // 16, 3 + differ // 2):
            m = differ + 1 + slack
            lam = least / m
            cost = m + CROWD * _poisson_above(m * math.exp(-lam), slack)
            if cost < best[0]:
                best = (cost, (m, slack, SEGMENTS, 1))
        for m in range(differ + 2, differ + 12):
            keys = math.comb(m, differ)
            cost = WEAK * keys + CROWD_OF_SUBSETS * min(1.0, keys * (differ / m) ** least)
            if cost < best[0] and keys <= MOST_SUBSETS:
                best = (cost, (m, 0, SUBSETS, m - differ))
        return best[1]

    def upto(self, size: int) -> None:
        while len(self.plans) < 2 or self.lows[-2] <= size:
            low = self.lows[-1]
            self.lows.append(max(low + 1, math.floor(low / self.threshold) + 1))
            self.plans.append(self._plan(low, self.lows[-1] - 1))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self.upto(int(sizes.max(initial=1)))
        return np.searchsorted(np.array(self.lows), sizes, "right") - 1


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, distinct shingle hashes sorted by row and value, offsets) by blocks of rows."""
    for lo, hi, data, offsets in tk.string_blocks(texts, tk.WORK_BYTES):
        _, _, hashes, rows = tk.words(data, offsets, tk.NOT_SPACE)
        counts = np.bincount(rows, minlength=hi - lo)
        sh, sh_rows = tk.grams(hashes, rows, k)
        starts = np.concatenate([[0], np.cumsum(counts)])
        per = np.bincount(sh_rows, minlength=hi - lo)
        at = np.concatenate([[0], np.cumsum(per)])
        sets = []
        for i in range(hi - lo):
            if counts[i] >= k:
                sets.append(np.unique(sh[at[i] : at[i + 1]]))
            elif counts[i]:
                whole = np.zeros(1, np.uint64)
                for h in hashes[starts[i] : starts[i + 1]]:
                    whole = tk.mix(whole * np.uint64(0x9E3779B185EBCA87) + h + np.uint64(counts[i]))
                sets.append(whole)
            else:
                sets.append(np.zeros(0, np.uint64))
        yield lo, hi, np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def digests(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(tokens ^ np.uint64(seed)), dtype=np.uint64)])
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def segment_keys(tokens: np.ndarray, offsets: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, slack) over sets: a key of each segment for the set's own band and, if it can link there, the next.
    ``slack`` is twice the band's slack, plus 1 for the next band."""
    sizes = np.diff(offsets)
    own = bands.of(np.maximum(sizes, 1))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    values = tk.mix(tokens ^ np.uint64(0xA0761D6478BD642F))
    place = tokens >> np.uint64(32)
    lows = np.array(bands.lows)
    for step in (0, 1):
        band = own + step
        plans = np.array(bands.plans)[np.minimum(band, len(bands.plans) - 1)] if len(sizes) else np.zeros((0, 4), int)
        used = (sizes > 0) & (plans[:, 0] > 0)
        if step:
            used &= sizes * bands.threshold.denominator >= lows[band] * bands.threshold.numerator
        rows = np.flatnonzero(used)
        if not len(rows):
            continue
        m = plans[rows, 0].astype(np.int64)
        base = np.concatenate([[0], np.cumsum(m)])
        n = sizes[rows]
        take = tk.ragged(offsets[rows], n)
        which = np.repeat(np.arange(len(rows)), n)
        segment = base[which] + ((place[take] * m[which].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[take][order], dtype=np.uint64)])
        edges = np.concatenate([[0], np.cumsum(np.bincount(segment, minlength=base[-1]))])
        content = sums[edges[1:]] - sums[edges[:-1]]
        of_row = np.repeat(np.arange(len(rows)), m)
        index = np.arange(base[-1]) - base[of_row]
        tag = tk.mix(band[rows][of_row].astype(np.uint64) * np.uint64(0x100000000) + index.astype(np.uint64))
        slack = 2 * plans[rows, 1] + step
        keyed = tk.mix(content ^ tag)
        alone = (plans[rows, 2] != SUBSETS)[of_row]
        found.append((rows[of_row[alone]], keyed[alone], slack[of_row[alone]]))
        for parts, size in np.unique(plans[rows][plans[rows, 2] == SUBSETS][:, [0, 3]], axis=0).tolist():
            these = np.flatnonzero((plans[rows, 2] == SUBSETS) & (m == parts) & (plans[rows, 3] == size))
            grid = keyed[base[these][:, None] + np.arange(parts)]
            chosen = np.array(list(combinations(range(parts), size)))
            joined = tk.mix(grid[:, chosen].sum(axis=2, dtype=np.uint64))
            found.append((np.repeat(rows[these], len(chosen)), joined.ravel(), np.repeat(slack[these], len(chosen))))
        short = (plans[rows, 2] == DELETIONS)[which]
        if short.any():
            found.append((rows[which[short]], tk.mix((content[segment] - values[take])[short] ^ tag[segment][short]), slack[which][short]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    rows_, keys_, slack_ = (np.concatenate([f[i] for f in found]) for i in range(3))
    return rows_, keys_.view(np.int64), slack_


def signatures(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles and the digests of the set, one row per document; map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, tokens, offsets in shingle_sets(batch.column(1), k):
                a, b = digests(tokens, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(a), pa.array(b)], ["doc_id", "n_shingles", "d1", "d2"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long")


def candidate_keys(documents: DataFrame, k: int, numerator: int, denominator: int) -> DataFrame:
    """doc_id, key, slack. Of equal sets in one partition only the first gives keys: the others are merged with it anyway."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(numerator, denominator), set()
        for batch in batches:
            for lo, hi, tokens, offsets in shingle_sets(batch.column(1), k):
                a, b = digests(tokens, offsets)
                ids = batch.column(0).slice(lo, hi - lo).cast(pa.int64())
                fresh = np.zeros(hi - lo, bool)
                for i, (known, both) in enumerate(zip(ids.is_valid().to_pylist(), zip(a.tolist(), b.tolist(), strict=True), strict=True)):
                    fresh[i] = known and both not in seen
                    if known:
                        seen.add(both)
                sizes = np.where(fresh, np.diff(offsets), 0)
                take = tk.ragged(offsets[:-1], sizes)
                row, key, slack = segment_keys(tokens[take], np.concatenate([[0], np.cumsum(sizes)]), bands)
                numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
                for at in range(0, len(row), 200_000):
                    part = slice(at, at + 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[row[part]]), pa.array(key[part]), pa.array(slack[part].astype(np.int32))], ["doc_id", "key", "slack"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, key long, slack int")


def linked_within(sizes: np.ndarray, tokens: np.ndarray, left: np.ndarray, right: np.ndarray, numerator: int, denominator: int) -> np.ndarray:
    """For sets given one after another: the matrix of exact links between sets ``left`` and ``right``."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count > 1
    code, owner = (np.cumsum(shared) - 1)[code][shared[code]], owner[shared[code]]
    total = np.zeros((len(left), len(right)), np.float32)
    slot = [np.full(len(sizes), -1), np.full(len(sizes), -1)]
    slot[0][left], slot[1][right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    width, most = 4096, int(shared.sum())
    for at in range(0, most, width):
        lo, hi = np.searchsorted(code, (at, at + width))
        sides = []
        for s, n in zip(slot, (len(left), len(right)), strict=True):
            place = s[owner[lo:hi]]
            there = place >= 0
            x = np.zeros((n, min(width, most - at)), np.float32)
            x[place[there], code[lo:hi][there] - at] = 1
            sides.append(x)
        total += sides[0] @ sides[1].T
    inter = total.astype(np.int64)
    return inter * (numerator + denominator) >= numerator * (sizes[left][:, None] + sizes[right][None, :])


def forest(links: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Labels of the n sets (least index in the same component) under a matrix of links."""
    label = np.arange(n)
    i, j = np.nonzero(links)
    i, j = left[i], right[j]
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(numerator: int, denominator: int):
    """Groups of rows (unit, i, j, left, right, doc_id, tokens), sorted by the first three, to the links between left and right ones."""

    def links_of(rows: list[tuple[bool, bool, int, bytes]]) -> tuple[list[int], list[int]]:
        left, right = (np.flatnonzero([r[side] for r in rows]) for side in (0, 1))
        if len(rows) < 2 or not len(left) or not len(right):
            return [], []
        ids = np.array([r[2] for r in rows], np.int64)
        sizes = np.array([len(r[3]) // 8 for r in rows], np.int64)
        tokens = np.frombuffer(b"".join(r[3] for r in rows), np.uint64)
        hit = linked_within(sizes, tokens, left, right, numerator, denominator)
        label = forest(hit, left, right, len(rows))
        moved = np.flatnonzero(label != np.arange(len(rows)))
        return ids[moved].tolist(), ids[label[moved]].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            a, b = [], []
            for u, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (u, i, j) != key:
                    x, y = links_of(rows)
                    a += x
                    b += y
                    key, rows = (u, i, j), []
                rows.append(tuple(row))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        x, y = links_of(rows)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def candidate_links(keys: DataFrame) -> DataFrame:
    """a, b: each set with the least set of every bucket that it stays in, once the slack is spent."""
    from pyspark.sql import Window

    bucket = Window.partitionBy("key")
    met = keys.withColumn("sharers", F.count(F.lit(1)).over(bucket)).where("sharers > 1")
    rank = F.row_number().over(Window.partitionBy("doc_id", "slack").orderBy(F.desc("sharers"), "key"))
    kept = met.withColumn("rank", rank).where(F.col("rank") > F.floor(F.col("slack") / 2)).select("key", "doc_id")
    hub = F.min("doc_id").over(bucket)
    return kept.select(F.col("doc_id").alias("a"), hub.alias("b")).where("a <> b").distinct()


def ngram_components(documents: DataFrame, k: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links, itself included)."""
    spark = documents.sparkSession
    small_batches(spark)
    sig = materialise(signatures(documents, k), "signatures")
    full = sig.where("n_shingles > 0")
    equal = full.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    same = equal.select(own_exchange(F.col("n_shingles")).alias("e0"), own_exchange(F.col("d1")).alias("e1"), own_exchange(F.col("d2")).alias("e2"), "rep")
    signed, sig = sig, materialise(sig.join(same, (F.col("n_shingles") == F.col("e0")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left").select("doc_id", "n_shingles", "rep"), "sets")
    discard(signed)
    near = materialise(candidate_links(candidate_keys(documents, k, numerator, denominator)), "candidates")
    rep = sig.where("rep IS NOT NULL AND doc_id <> rep").select("doc_id", "rep").distinct()

    def merged(links: DataFrame, side: str) -> DataFrame:
        return links.join(rep.select(F.col("doc_id").alias("copy"), F.col("rep").alias("first")), F.col(side) == F.col("copy"), "left").withColumn(side, F.coalesce("first", side)).drop("copy", "first")

    units = connected_components(merged(merged(near, "a"), "b"))
    members = units.join(sig.where("doc_id = rep").select("doc_id", "n_shingles").distinct(), F.col("node") == F.col("doc_id")).select("doc_id", F.col("component").alias("unit"), "n_shingles")
    members = materialise(members, "members")
    placed = materialise(_placed(members), "placed")
    for done in (near, units, members):
        discard(done)
    first = placed.withColumn("at", F.explode(F.when(F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
    first = first.select("id", "unit", F.col("at").alias("i"), F.lit(0).alias("j"), F.col("hub").alias("left"), (F.col("at") == F.col("block")).alias("right"))
    links = materialise(_links(documents, first, k, numerator, denominator), "verified")
    groups = connected_components(links)
    last = materialise(_undecided(placed, groups), "undecided")
    n_left = last.count()
    if n_left:
        more = _links(documents, last, k, numerator, denominator, few=n_left <= FEW)
        joined = connected_components(links.unionByName(more))
        discard(groups)
        groups = joined
    for done in (links, placed, last):
        discard(done)
    out = sig.join(groups, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def _placed(members: DataFrame) -> DataFrame:
    """id, unit, n_shingles, blocks, block, hub, decided: where each set of a unit lies, and whether it meets all others. Long sets
    leave a unit fewer hubs, so that these fill a block at most; with no more sets than hubs all are hubs."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(HUBS))
    least = F.array_compact(F.array(*(F.min(F.when(slot == i, F.col("doc_id"))) for i in range(HUBS))))
    shape = members.groupBy("unit").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("tokens"), least.alias("least"))
    hubs = F.greatest(F.lit(1), F.least(F.lit(HUBS), F.floor(F.lit(MOST_TOKENS) * F.col("sets") / F.col("tokens")))).cast("int")
    blocks = F.greatest(F.ceil(F.col("sets") / MOST_SETS), F.ceil(F.col("tokens") / MOST_TOKENS)).cast("int")
    shape = shape.select(own_exchange(F.col("unit")).alias("u"), blocks.alias("blocks"), F.slice("least", F.lit(1), hubs).alias("hubs"), (F.col("sets") <= hubs).alias("decided"))
    both = members.join(shape, F.col("unit") == F.col("u"))
    hub = F.col("decided") | F.array_contains("hubs", F.col("doc_id"))
    return both.select(F.col("doc_id").alias("id"), "unit", "n_shingles", "blocks", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks")).cast("int").alias("block"), hub.alias("hub"), "decided")


def _undecided(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """id, unit, i, j, left, right: every set of a unit against its outliers, in blocks. Two sets that aren't outliers are in one
    component or have met, as one is a hub."""
    known = groups.select(own_exchange(F.col("node")).alias("node"), "component")
    now = placed.where("NOT decided").join(known, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")
    largest = now.groupBy("unit", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("unit").agg(F.max(F.struct("n", "component")).alias("m"))
    now = now.join(largest.select(own_exchange(F.col("unit")).alias("u"), F.col("m.component").alias("main")), F.col("unit") == F.col("u")).drop("u")
    now = now.withColumn("outlier", (F.col("component") != F.col("main")) & ~F.col("hub"))
    shape = now.where("outlier").groupBy("unit").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("tokens"))
    others = F.greatest(F.ceil(F.col("sets") / (JOINED * MOST_SETS)), F.ceil(F.col("tokens") / MOST_TOKENS)).cast("int")
    now = now.join(shape.select(own_exchange(F.col("unit")).alias("u"), others.alias("others")), F.col("unit") == F.col("u"))
    # Blocks of the first step are joined where sets, not tokens, bound them.
    n, at = F.ceil(F.col("blocks") / JOINED).cast("int"), F.floor(F.col("block") / JOINED).cast("int")
    other = F.pmod(F.xxhash64("id", F.lit(2)), F.col("others")).cast("int")

    def upto(count):
        return F.sequence(F.lit(0), count - 1)

    def place(i, j, left: bool):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("left"), F.lit(not left).alias("right"))

    as_set = F.transform(upto(F.col("others")), lambda j: place(at, j, True))
    as_outlier = F.when(F.col("outlier"), F.transform(upto(n), lambda i: place(i, other, False))).otherwise(F.array().cast("array<struct<i:int,j:int,left:boolean,right:boolean>>"))
    return now.select("id", "unit", F.explode(F.concat(as_set, as_outlier)).alias("p")).select("id", "unit", "p.*")


def _links(documents: DataFrame, places: DataFrame, k: int, numerator: int, denominator: int, few: bool = False) -> DataFrame:
    """a, b: a spanning forest of the links between left and right sets of each (unit, i, j); ``places``: id, unit, i, j, left, right.
    ``few``: no more than FEW of these, so that they are broadcast and only their texts are sent. Else never, as sets with
    candidates are a share of all documents: the plan is then the same at every size."""
    each = places.groupBy("id").agg(F.collect_list(F.struct("unit", "i", "j", "left", "right")).alias("places"))
    texts = documents.select("doc_id", "text").join(F.broadcast(each) if few else each.hint("merge"), F.col("doc_id") == F.col("id")).select("doc_id", "text", "places")

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, tokens, offsets in shingle_sets(batch.column(1), k):
                raw = tokens.tobytes()
                sets = [raw[8 * s : 8 * e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(sets, pa.binary())], ["doc_id", "places", "tokens"])

    sets = texts.mapInArrow(tokens_of, "doc_id long, places array<struct<unit:long,i:int,j:int,left:boolean,right:boolean>>, tokens binary")
    rows = sets.select("doc_id", F.explode("places").alias("p"), "tokens").select("p.unit", "p.i", "p.j", "p.left", "p.right", "doc_id", "tokens")
    dealt = rows.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    return dealt.mapInArrow(_verify(numerator, denominator), "a long, b long")
