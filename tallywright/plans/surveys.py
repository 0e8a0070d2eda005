"""Surveys of published files in a folder: what they hold, by their columns and not by their names. Each result is a DataFrame; the
command line shows it and writes it down on demand."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import text
from tallywright.model import BULLETINS_DDL, GATES_DDL, MANIFEST_DDL, REGISTRY_DDL, RESULTS_DDL
from tallywright.operators import aggregate, lineage, profile, schema
from tallywright.sources.http import Fetched
from tallywright.sources.raw import decode_lenient, split_header
from tallywright.sources.tables import binary_files, exploded_map, read_json

PARSED = "file string, content binary, kind string, header array<string>, rows array<struct<row:int,line:string,cells:array<string>>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, content, kind) to header and non-blank rows; rows are numbered as in the file, the header being 1."""
    kind = pa.list_(pa.struct([("row", pa.int32()), ("line", pa.string()), ("cells", pa.list_(pa.string()))]))
    for batch in batches:
        headers, rows = [], []
        for body, sort in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines = decode_lenient(body).removeprefix("﻿").replace("\r\n", "\n").split("\n") if sort == "text" else []
            headers.append(split_header(lines[0]) if lines else None)
            rows.append([{"row": i, "line": x, "cells": next(csv.reader(io.StringIO(x)), [])} for i, x in enumerate(lines[1:], 2) if x.strip()])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(headers, pa.list_(pa.string())), pa.array(rows, kind)], ["file", "content", "kind", "header", "rows"])


def files(spark: SparkSession, folder: str) -> DataFrame:
    """file (path below the folder), content, kind, header, rows; files that aren't text have neither."""
    found = binary_files(spark, folder).select(F.regexp_replace("path", r"^.*?" + "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/", "").alias("file"), "content", text.sniff(F.col("content")).alias("kind"))
    return found.mapInArrow(_parse, PARSED)


def granularity(spark: SparkSession, folder: str) -> DataFrame:
    """Files named <code>/<title>.csv: file, code, direction, kind, granularity, basis, hits, rows."""
    given = files(spark, folder).withColumn("code", F.split("file", "/")[0]).withColumn("direction", text.direction_of(F.col("file")))
    judged = profile.granularity(given.withColumn("header", F.coalesce("header", F.array().cast("array<string>"))))
    return judged.select("file", "code", "direction", "kind", "granularity", "basis", "hits", F.size("rows").alias("rows"))


def bulletins(spark: SparkSession, folder: str) -> DataFrame:
    """One verdict per file."""
    given = files(spark, folder)
    each = given.select("file", "header", F.explode("rows").alias("r")).select("file", "header", "r.*")
    return profile.file_verdicts(given, profile.bulletin_rows(each))


def years(spark: SparkSession, folder: str, headers: dict[str, list[str]], expected: list[int]) -> DataFrame:
    """Files whose name states a fiscal year and a direction, against the columns that each direction should have."""
    labels = F.array(*(F.struct(F.lit(y).alias("year"), F.lit(label).alias("label")) for y in expected for label in text.era_labels(y)))
    named = files(spark, folder).withColumn("direction", text.direction_of(F.col("file"))).withColumn("year", F.filter(labels, lambda x: F.contains(F.col("file"), x["label"]))[0]["year"])
    lines = named.where("year IS NOT NULL").select("year", "direction", "header", F.explode_outer("rows").alias("r"))
    flat = lines.select("year", "direction", "header", F.try_element_at("r.cells", F.lit(1)).alias("fund"), F.try_element_at("r.cells", F.lit(8)).alias("amount"), F.coalesce("r.line", F.lit("")).alias("raw_line"))
    out = None
    for direction, header in headers.items():
        found = profile.year_verdicts(profile.year_compatibility(flat.where(F.col("direction") == direction), header), [(y, direction) for y in expected])
        out = found if out is None else out.unionByName(found)
    return out.orderBy("year", "direction")


def gates(spark: SparkSession, path: str, registry_path: str) -> dict[str, DataFrame]:
    """errors: what is wrong with a gates document and the registry, by code; counts: how often each value occurs; targets: what may be
    fetched."""
    document, registry = read_json(spark, path, GATES_DDL), read_json(spark, registry_path, REGISTRY_DDL)
    rows, known = schema.gate_rows(document, registry), exploded_map(registry, "jurisdictions")
    policy = document.select("policy.version", F.map_keys("policy.constraints").alias("constraints")).first()
    broken = schema.schema_errors(exploded_map(document, "jurisdictions"), "code", schema.gate_fields()).unionByName(schema.schema_errors(known, "code", schema.registry_fields()))
    errors = broken.select("code", F.concat(F.lit("not as declared: "), "path").alias("error"))
    errors = errors.unionByName(profile.gate_errors(rows, list(policy["constraints"] or []), policy["version"])).unionByName(profile.registry_errors(rows, known))
    values = aggregate.cells(rows.withColumn("constraint", F.explode_outer("constraints")), {"constraint": "constraint"}).unionByName(aggregate.cells(rows, {c: c for c in ("system_family", "robots", "ai_crawler", "fetch", "redistribute")}))
    counts = values.groupBy("kind", "cell").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", F.desc("n"), "cell")
    return {"errors": errors.orderBy("code", "error"), "counts": counts, "targets": profile.fetch_targets(rows).select("code", "transcript_url").orderBy("code")}


def graph(spark: SparkSession, manifest_path: str, results_path: str) -> dict[str, DataFrame]:
    """nodes, edges and checks of a build, from its manifest and its results; summary: how many checks passed, failed, warned."""
    manifest = read_json(spark, manifest_path, MANIFEST_DDL).first().asDict(recursive=True)
    results = read_json(spark, results_path, RESULTS_DDL).select(F.explode("results").alias("r")).select(F.col("r.unique_id").alias("id"), "r.status", "r.failures", "r.message")
    nodes, edges = lineage.topology(spark, manifest)
    checks = lineage.bind_results(spark.createDataFrame(lineage.tests_of(manifest), lineage.TEST_DDL), results)
    return {"nodes": nodes, "edges": edges, "checks": checks, "summary": lineage.summarise_results(checks)}


def robots(spark: SparkSession, path: str, registry_path: str, fetch: Callable[[str], Fetched]) -> DataFrame:
    """origin, codes, status, found, sha256, rules, reason: one request for each origin that the gates name."""
    document, registry = read_json(spark, path, GATES_DDL), read_json(spark, registry_path, REGISTRY_DDL)
    wanted = profile.by_origin(schema.gate_rows(document, registry)).orderBy("origin").collect()  # one row for each publisher
    got = [(r["origin"], r["codes"], fetch(f"{r['origin']}/robots.txt")) for r in wanted]
    rows = [(o, c, f.status, f.content_type, f.body, f.fetched_at, f.reason) for o, c, f in got]
    answers = profile.robots(spark.createDataFrame(rows, "origin string, codes array<string>, status int, content_type string, content binary, fetched_at string, reason string"))
    return answers.select("origin", "codes", "status", "found", F.when(F.col("found"), F.sha2("content", 256)).alias("sha256"), "rules", "fetched_at", "reason")


def bulletin_registry(spark: SparkSession, path: str) -> DataFrame:
    """Fields at fault in a list of bulletin datasets."""
    return schema.schema_errors(exploded_map(read_json(spark, path, BULLETINS_DDL), "datasets"), "code", schema.bulletin_fields())
