from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import components, decontaminate, embed_dedup, ngram_join


def rows_of(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 150), (150, 175)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(rows_of(components.connected_components(df), "node", "component"))
    want = brute.components({x for e in edges for x in e if x is not None and e[0] != e[1] and e[0] is not None}, [e for e in edges if None not in e])
    assert got == want
    assert components.connected_components(df.where("false")).count() == 0


@pytest.mark.parametrize("k,numerator", [(3, 90), (5, 80), (2, 50)])
def test_ngram_join_equals_brute_force(spark, k, numerator):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(rng.choice(words) for _ in range(50))
    for g in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([4, 9, 11, 15, 30, 80, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
            rows.append((len(rows), text + " " + passage if g % 3 == 0 else text))
    got = set(rows_of(ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string"), k, numerator, 100), "doc_id", "n_shingles", "component_id"))
    assert got == brute.ngram_components(rows, k, numerator, 100)


def test_ngram_join_in_blocks(spark, monkeypatch):
    """A large group of near copies over many blocks."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(220):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = set(rows_of(ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90, 100), "doc_id", "n_shingles", "component_id"))
    assert got == brute.ngram_components(rows, 3, 90, 100)


@pytest.mark.parametrize("numerator", [90, 75])
def test_ngram_join_of_large_units(spark, monkeypatch, numerator):
    """More sets than hubs, several blocks, several components and outliers in one unit."""
    monkeypatch.setattr(ngram_join, "MOST_SETS", 20)
    monkeypatch.setattr(ngram_join, "JOINED", 2)
    rng = random.Random(11)
    rows = []
    for g in range(3):
        base = [f"b{i}" for i in range(30)] + [f"g{g}_{i}" for i in range(40)]
        for _ in range(90):
            copy = list(base)
            for _ in range(rng.randrange(9)):
                copy[rng.randrange(70)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    got = set(rows_of(ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, numerator, 100), "doc_id", "n_shingles", "component_id"))
    assert got == brute.ngram_components(rows, 3, numerator, 100)


def test_sets_of_a_unit_are_sent_about_once(spark):
    """A group of near copies: places grow in proportion to the group."""
    for n in (2_000, 20_000):
        members = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("unit"), F.lit(100).cast("long").alias("n_shingles"))
        placed = ngram_join._placed(members)
        sent = placed.select(F.when(F.col("hub"), F.col("blocks")).otherwise(1).alias("n")).agg(F.sum("n")).first()[0]
        assert sent < 1.2 * n
        joined = spark.range(1, n - n // 100).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("component")).unionByName(spark.createDataFrame([(0, 0)], "node bigint, component bigint"))
        assert ngram_join._undecided(placed, joined).count() < 4 * n


@pytest.mark.parametrize("k,numerator", [(3, 80), (5, 80), (1, 90), (2, 60)])
def test_ngram_join_of_short_texts(spark, k, numerator):
    """Few shingles: the plans "deletions" and "subsets"."""
    rng = random.Random(k)
    rows = []
    for _ in range(120):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(3, 34))]
        for _ in range(4):
            copy = list(base)
            if rng.random() < 0.8:
                at = rng.choice((0, len(copy) - 1, rng.randrange(len(copy))))
                copy[at : at + 1] = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(3))]
            rows.append((len(rows), " ".join(copy)))
    got = set(rows_of(ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string"), k, numerator, 100), "doc_id", "n_shingles", "component_id"))
    assert got == brute.ngram_components(rows, k, numerator, 100)


def test_ngram_join_odd_rows(spark, odd, nothing):
    got = sorted(rows_of(ngram_join.ngram_components(odd, 3, 90, 100), "doc_id", "n_shingles", "component_id"), key=repr)
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 0, 3) in got and (4, 1, 4) in got
    assert (5, 1, 5) in got and (6, 1, 5) in got and (None, 1, 5) in got and (None, 0, None) in got
    assert (8, 119999, 7) in got and got.count((9, 6, 9)) == 2 and len(got) == 13
    assert ngram_join.ngram_components(nothing).count() == 0


def test_every_band_finds_pairs_at_the_threshold():
    bands = ngram_join.Bands(90, 100)
    bands.upto(3000)
    rng = np.random.default_rng(0)
    for n in (9, 10, 11, 19, 20, 45, 90, 200, 640, 2000):
        for _ in range(20):
            common = -(-9 * n // 10)
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[:common], rng.integers(0, 2**63, max(0, int(common / 0.9) - common - (n - common)), dtype=np.uint64)]))
            inter = len(np.intersect1d(a, b))
            if 100 * inter < 90 * (len(a) + len(b) - inter):
                continue
            row, key, slack = ngram_join.segment_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
            keys = [set(zip(key[row == r].tolist(), strict=True)) for r in (0, 1)]
            plan = bands.plans[int(bands.of(np.array([max(len(a), len(b))]))[0])]
            if plan[0]:
                assert len(keys[0] & keys[1]) > plan[1]


def test_decontamination_equals_brute_force(spark, documents, sf_dir):
    items = [(1, "alpha beta gamma"), (2, "single"), (3, " ".join(f"t{i}" for i in range(13))), (4, " ".join(f"t{i}" for i in range(5, 40))), (5, None), (6, "!!!"), (7, "Alpha, BETA gamma"), (8, " ".join(f"u{i}" for i in range(12)))]
    rng = random.Random(5)
    docs = [(0, None), (1, ""), (2, "x alpha, Beta-GAMMA y"), (3, "single single other"), (None, "single")]
    for i in range(10, 60):
        parts = [" ".join(f"n{rng.randrange(50)}" for _ in range(rng.randrange(40)))]
        a = rng.randrange(30)
        parts.append(" ".join(f"t{j}" for j in range(a, a + rng.randrange(1, 30))))
        parts.append(" ".join(f"u{j}" for j in range(rng.randrange(3), 12)))
        rng.shuffle(parts)
        docs.append((i, " ".join(parts)))
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert set(rows_of(decontaminate.contamination(d, b), *names)) == brute.contamination(docs, items)
    given = [(r.doc_id, r.text) for r in documents.collect()]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert set(rows_of(decontaminate.contamination(documents, bench), *names)) == brute.contamination(given, [(r.item_id, r.text) for r in bench.collect()])


def test_words_are_counted_and_least_neighbours_found(spark):
    texts = [None, "", " ", "a", " a", "a ", "!a b!", "Ab-Cd", "é!é", "\n", "!!!", " !a", "中 B"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(F.size(decontaminate.words_of(F.col("t"))), decontaminate.n_words(F.col("t"))).collect()]
    assert got == [(len(brute.item_words(t)),) * 2 for t in texts]
    given = [5, 3, 9, 1, 7, 7, 2, 8]
    columns, want = [], []
    for n in range(9):
        for w in (1, 2, 3, 5, 8, 9):
            columns.append(decontaminate._least_of(F.array(*map(F.lit, given[:n])).cast("array<bigint>"), w).alias(f"c{n}_{w}"))
            want.append([min(given[:n][i : i + w]) for i in range(max(0, n - w + 1))])
    assert list(spark.range(1).select(*columns).first()) == want


def test_decontamination_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate.contamination(odd, bench).collect() if r.doc_id is not None}
    assert got[5] == 2 and got[6] == 2 and got[4] == 0 and got[1] == 0
    assert decontaminate.contamination(odd, bench).count() == 13
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.contamination(odd, bench.where("false")).where("contaminated").count() == 0


def test_decontamination_tells_rows_without_or_of_one_id_apart(spark):
    docs = [(None, "one two three"), (None, "clean words only"), (None, "one two three"), (4, "one two three"), (4, "other clean words")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = rows_of(decontaminate.contamination(d, b), *names)
    assert len(got) == 5 and set(got) == brute.contamination(docs, [(1, "one two three")])


def test_range_join_finds_all_in_reach():
    rng = np.random.default_rng(4)
    for dims, radius in ((1, 0.1), (2, 0.3), (5, 0.6), (8, 1.5), (8, 50.0)):
        own, other = rng.normal(size=(300, dims)).astype(np.float32), 1.3 * rng.normal(size=(200, dims)).astype(np.float32)
        found = np.zeros((200, 300), bool)
        join = embed_dedup.RangeJoin(own, radius)
        join.mark(other, found)
        apart = ((other[:, None, :].astype(float) - own[None, :, :]) ** 2).sum(2)
        assert (found | (apart > radius**2 - 1e-4)).all() and not (found & (apart > radius**2 + 1e-4)).any()
    assert join.seen <= 200 * 300


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 24))
    vectors = [(b + rng.normal(size=24) * s).tolist() for b in base for s in (0, 0.05, 0.1, 0.2, 0.3, 0.4)] + [rng.normal(size=24).tolist() for _ in range(40)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(500, vectors[0], 0), (501, vectors[0], 0), (502, vectors[0], None), (503, None, 0), (504, [0.0] * 24, 0), (505, [float("nan")] * 24, 0), (506, [None] + [1.0] * 23, 0), (507, [], 0), (508, [1.0, 2.0], 0), (509, [2.0, 4.0], 0), (510, [2 * x for x in vectors[0]], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    links = []
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    for x, a, la in rows:
        for y, b, lb in rows:
            if x < y and la is not None and la == lb and ok(a) and ok(b) and len(a) == len(b) and np.dot(a, b) / np.sqrt(np.dot(a, a)) / np.sqrt(np.dot(b, b)) >= 0.93:
                links.append((x, y))
    found = brute.components([r[0] for r in rows], links)
    want = {(r[0], sum(r[0] in e for e in links), found[r[0]], found[r[0]] == r[0]) for r in rows}
    for tile in (512, 7):
        got = set(rows_of(embed_dedup.near_duplicates(df, tile=tile), "vec_id", "n_links", "component_id", "kept"))
        assert got == want
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0
    assert embed_dedup.near_duplicates(df.withColumnRenamed("extra", "x").selectExpr("*", "1 AS l", "2 AS h1", "3 AS v")).count() == len(rows)
