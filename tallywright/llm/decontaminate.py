"""Benchmark decontamination by winnowing (Schleimer et al., 2003), with DataFrame functions only.

Words of a text: A-Z lower-cased, runs of characters other than ASCII signs and spaces. Every ``span`` = 13
consecutive words of a benchmark item are a window; an item of fewer words is one window. Each side keeps the
least hash of ``gram`` = 5 words among any span - gram + 1 = 9 neighbouring ones. Two equal spans of 13 words keep
the same fingerprint, so every shared span is found. Items of fewer than 13 words have as fingerprint
the hash of all their words; documents then also give the hashes of their runs of those lengths.

Fingerprints are joined; around each hit the document's windows that can hold it are compared as strings with the
items' windows, so results are exact. Item tables are broadcast only below ``SMALL`` bytes, else both sides are
dealt by key. Texts are shuffled only to meet the documents with a hit.

Defined cases: null or empty texts have no words, are never hit, and as items have no window; doc_id may be null or
repeat, as rows are told apart by a 128-bit digest of doc_id and text; repeated rows each give the same result row;
repeated items count by item_id; a tie of hashes costs a comparison, nothing more, as windows are compared as strings; a very long text is
one row's array of words in one task; other columns are ignored, whatever their names; an empty table of documents gives no rows, one of
items no hits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.components import own_exchange, row_digest
from tallywright.llm.scratch import materialise

SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for text whose capitals are still there.
SIGNS_AND_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of an item table that are still broadcast.
SMALL = 16 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SIGNS), "")


def n_words(text: Column) -> Column:
    """``size(words_of(text))`` without making the words: what lies between signs, less the empty ends."""

    def inner(parts: Column) -> Column:
        ends = (F.element_at(parts, 1) == "").cast("int") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
        return F.size(parts) - ends

    return let(F.split(F.coalesce(text, F.lit("")), SIGNS_AND_CASE), inner)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often a nested lambda reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _upto(n: Column) -> Column:
    """1..n, empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def gram_hashes(hashes: Column, gram: int) -> Column:
    """The hash of every run of ``gram`` words, given the words' hashes."""
    return F.transform(_upto(F.size(hashes) - (gram - 1)), lambda i: F.xxhash64(*(F.element_at(hashes, i + j) for j in range(gram))))


def _least_of(values: Column, window: int) -> Column:
    """The least of every ``window`` neighbours, in a logarithm of ``window`` passes: each pass doubles what a value stands for."""

    def pass_(held: Column, so_far: int) -> Column:
        if so_far == window:
            return F.slice(held, F.lit(1), F.greatest(F.size(values) - (window - 1), F.lit(0)))
        step = min(so_far, window - so_far)
        paired = let(held, lambda h: F.zip_with(h, F.slice(h, F.lit(step + 1), F.size(h)), lambda a, b: F.least(a, b)))
        return pass_(paired, so_far + step)

    return pass_(values, 1)


def _kept(grams: Column, window: int) -> Column:
    return F.array_distinct(_least_of(grams, window))


def fingerprints(words: Column, span: int, gram: int, short: list[int]) -> Column:
    """Winnowed hashes; with ``short`` also those of all runs of these lengths."""

    def both(hashes: Column) -> Column:
        kept = let(gram_hashes(hashes, gram), lambda g: _kept(g, span - gram + 1))
        return F.array_distinct(F.concat(kept, *(gram_hashes(hashes, n) for n in short))) if short else kept

    return let(F.transform(words, lambda w: F.xxhash64(w)), both)


def _small(df: DataFrame, name: str) -> DataFrame:
    """Written down, so that its size in bytes is known; broadcast if that is small."""
    made = materialise(df, name)
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in made.columns), F.lit(0))
    return F.broadcast(made) if (made.agg(F.sum(size).alias("n")).first()["n"] or 0) <= SMALL else made


def keyed(documents: DataFrame) -> DataFrame:
    a, b = row_digest()
    return documents.select("doc_id", "text", a.alias("row_a"), b.alias("row_b"))


def matches(documents: DataFrame, benchmark: DataFrame, span: int = 13, gram: int = 5) -> DataFrame:
    """row_a, row_b (a row's digest), hits (array of first word from 1, and words), items (array of item_id): rows with a window only."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    found = items.where(F.size("words") < span).select(F.size("words").alias("n")).distinct()
    short = sorted(r["n"] for r in found.collect())  # fewer than ``span`` numbers
    own = F.when(F.size("words") >= span, fingerprints(F.col("words"), span, gram, [])).otherwise(F.array(let(F.transform("words", lambda w: F.xxhash64(w)), lambda h: _whole(h, short))))
    prints = _small(items.select(F.explode(own).alias("print")).distinct(), "item-prints")
    size = F.least(F.size("words"), F.lit(span))
    # Windows are cut out inside the array, so that no row carries all words along.
    said = F.transform(_upto(F.size("words") - size + 1), lambda i: F.array_join(F.slice("words", i, size), " "))
    windows = _small(items.select("item_id", size.alias("n"), F.explode(said).alias("window")).distinct(), "item-windows")

    rows = keyed(documents)
    mine = rows.select("row_a", "row_b", F.explode(fingerprints(words_of(F.col("text")), span, gram, short)).alias("fp"))
    hit = mine.join(prints, F.col("fp") == F.col("print")).groupBy("row_a", "row_b").agg(F.collect_set("fp").alias("fps"))
    hit = materialise(hit.select(F.col("row_a").alias("hit_a"), F.col("row_b").alias("hit_b"), "fps"), "hit-documents")
    texts = rows.join(hit, (F.col("row_a") == F.col("hit_a")) & (F.col("row_b") == F.col("hit_b"))).select("row_a", "row_b", words_of(F.col("text")).alias("words"), "fps")
    hashed = texts.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def around(hashes: Column, fps: Column, n: Column) -> Column:
        """(i, n) of the windows that a hit lies in."""
        long = let(
            gram_hashes(hashes, gram),
            lambda g: F.transform(F.filter(_upto(F.size(g)), lambda i: F.array_contains(fps, F.element_at(g, i))), lambda p: F.transform(_between(p - (span - gram), p, n - (span - 1)), lambda i: _window(i, F.lit(span)))),
        )
        return F.array_distinct(F.concat(F.flatten(long), *(exact(hashes, fps, s) for s in short)))

    def exact(hashes: Column, fps: Column, s: int) -> Column:
        """(i, s) of the runs of s words with a hit."""
        return let(
            gram_hashes(hashes, s),
            lambda g: F.transform(F.filter(_upto(F.size(g)), lambda i: F.array_contains(fps, F.element_at(g, i))), lambda i: _window(i, F.lit(s))),
        )

    # One struct holds all, bound once, so that nothing is computed anew for an element; the words of each window are cut out
    # there, so that no row carries all words along.
    def tried_in(s: Column) -> Column:
        return F.transform(around(s["hashes"], s["fps"], F.size(s["words"])), lambda w: F.struct(w["i"].alias("i"), w["n"].alias("long"), F.array_join(F.slice(s["words"], w["i"], w["n"]), " ").alias("said")))

    tried = hashed.select("row_a", "row_b", F.explode(let(F.struct("words", "hashes", "fps"), tried_in)).alias("w")).select("row_a", "row_b", "w.*")
    same = tried.join(windows, (F.col("said") == F.col("window")) & (F.col("long") == F.col("n")))
    return same.groupBy("row_a", "row_b").agg(F.collect_set(F.struct("i", "n")).alias("hits"), F.collect_set("item_id").alias("items"))


def _window(i: Column, n: Column) -> Column:
    return F.struct(i.cast("int").alias("i"), n.cast("int").alias("n"))


def _between(low: Column, high: Column, most: Column) -> Column:
    low, high = F.greatest(low, F.lit(1)), F.least(high, most)
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def _whole(hashes: Column, lengths: list[int]) -> Column:
    """The hash of all words of a short item: the only run of its length."""
    out = F.lit(None).cast("long")
    for n in lengths:
        out = F.when(F.size(hashes) == n, F.element_at(gram_hashes(hashes, n), 1)).otherwise(out)
    return out


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = 13, gram: int = 5, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (share * n_hit >= n_words > 0 hits) for every document."""
    return contamination_by_row(documents, benchmark, span, gram, share).drop("row_a", "row_b")


def contamination_by_row(documents: DataFrame, benchmark: DataFrame, span: int = 13, gram: int = 5, share: int = 20) -> DataFrame:
    """``contamination`` with each row's digest in front."""
    found = matches(documents, benchmark, span, gram)
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["i"], h["i"] + h["n"] - 1)))))
    named = F.array_join(F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string")))), ",")
    per = found.select(own_exchange(F.col("row_a")).alias("hit_a"), own_exchange(F.col("row_b")).alias("hit_b"), covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(named, 256).alias("items_sha256"))
    counted = keyed(documents).select("row_a", "row_b", "doc_id", n_words(F.col("text")).cast("long").alias("n_words"))
    every = counted.join(per, (F.col("row_a") == F.col("hit_a")) & (F.col("row_b") == F.col("hit_b")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return every.select(
        "row_a",
        "row_b",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
