"""A training corpus from ``documents``: five stages, each over all that the one before it kept.

Defined cases, of every stage: rows without doc_id, and rows that share one, are judged each by their own text; null and empty texts
pass all stages (nothing is found in them) and pack as their end id alone; exact repeats of a row stay until the join, which keeps one;
very long texts are judged whole; ties are settled by doc_id, then by a digest of the text; columns other than those of
``documents`` pass through all stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import decontaminate, ngram_join, packing, quality, secrets
from tallywright.llm.components import own_exchange, row_digest
from tallywright.llm.queries import table, tokenizer_path
from tallywright.llm.scratch import materialise, ship, swept


def _without(docs: DataFrame, gone: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``docs`` whose key in ``names`` isn't in ``gone``. Never broadcast: ``gone`` grows with ``docs``."""
    gone = gone.select(*(own_exchange(F.col(n)).alias(f"__gone_{n}") for n in names)).hint("merge")
    return docs.join(gone, reduce(and_, (docs[n] == F.col(f"__gone_{n}") for n in names)), "left_anti")


def _told_apart(docs: DataFrame) -> Column:
    """A long that two rows share only if they agree in doc_id and text: doc_id, with a hash where it is null, or where that
    doesn't tell all rows apart a hash of both; with another seed as long as different rows share one."""
    a, b = row_digest()
    text, seed = F.coalesce("text", F.lit("")), 0
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text))
    while docs.groupBy(key.alias("key")).agg(F.min(a).alias("a"), F.max(a).alias("c"), F.min(b).alias("b"), F.max(b).alias("d")).where("a <> c OR b <> d").limit(1).count():
        seed += 1
        key = F.xxhash64(F.lit(seed), "doc_id", text)
    return key


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to these documents, doesn't reject."""
    ship(spark)
    return quality.keep_good(docs, quality.fit(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by a similarity of 0.8 or more on five-word shingles, the one with the least doc_id; rows without doc_id
    come after all others. Of rows that agree in doc_id and text one stays. Texts without words are linked with nothing and stay."""
    ship(spark)
    key, worded = _told_apart(docs), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    groups = ngram_join.ngram_components(docs.select(key.alias("doc_id"), "text"), k=5, numerator=80, denominator=100)
    moved = materialise(groups.where("doc_id <> component_id").select("doc_id", "component_id").distinct(), "linked")
    members = moved.unionByName(moved.select(F.col("component_id").alias("doc_id"), "component_id").distinct())
    named = docs.select("doc_id", key.alias("__key")).distinct()
    named = members.select(own_exchange(F.col("doc_id")).alias("__member"), "component_id").join(named, F.col("__member") == F.col("__key"))
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__key")).alias("first")).select(F.col("first.__key").alias("__first"))
    gone = members.select(F.col("doc_id").alias("__key")).join(first, F.col("__key") == F.col("__first"), "left_anti")
    kept = _without(docs.where(worded).withColumn("__key", key), gone, ["__key"]).dropDuplicates(["__key"]).drop("__key")
    return kept.unionByName(docs.where(~worded))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which windows of ``benchmark`` hit less than one word in twenty."""
    ship(spark)
    found = decontaminate.contamination_by_row(docs, table(spark, sf_dir, "benchmark"))
    a, b = row_digest()
    return _without(docs.withColumns({"row_a": a, "row_b": b}), found.where("contaminated").select("row_a", "row_b").distinct(), ["row_a", "row_b"]).drop("row_a", "row_b")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret span is replaced by the name of its kind, and n_chars set anew there."""
    ship(spark)
    return secrets.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in windows of 1024: one row per piece, with its ids."""
    ship(spark)
    return packing.pack(docs, tokenizer_path(), window=1024, end_id=0, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", keep_uncontaminated),
    ("secret scans", redact_secrets),
    ("packing", pack_windows),
]

#: SQL can't express the classifier, the tests of randomness or the tokenizer; tests hold every stage against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage wrote besides its result, and its input, go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    with swept(spark) as sweep:
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            sweep(docs)
    return docs
