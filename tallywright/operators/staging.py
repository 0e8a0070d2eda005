"""Raw cells to the canonical table, one row for one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions import text
from tallywright.model import LEVELS, UNIT, Layout, canonical_columns


def stage(raw: DataFrame, direction: str, layout: Layout, as_typed: bool = False) -> DataFrame:
    """Trim each cell, split code and label, identify the line. ``raw`` has the layout's columns and the four partition columns."""
    levels = LEVELS[direction]
    *cells, amount = layout.columns[direction]
    sources = [text.trim_cell(F.col(f"`{c}`"), as_typed).alias(f"{level}_source") for level, c in zip(levels, cells, strict=True)]
    base = raw.select(
        F.col("jurisdiction").cast("string").alias("jurisdiction_code"),
        F.col("year").cast("int").alias("fiscal_year"),
        F.lit(direction).alias("direction"),
        "source_row",
        *sources,
        F.col("phase").cast("string").alias("phase_id"),
        F.col(f"`{amount}`").cast("bigint").alias("source_amount"),
    )
    parts = [F.col(c) for c in ("jurisdiction_code", "fiscal_year", "direction", "phase_id")]
    split = [f(F.col(f"{level}_source")).alias(f"{level}_{part}") for level in levels for part, f in (("code", text.code_of), ("label", text.label_of))]
    ident = text.digest_id(parts, [F.col(f"{level}_source") for level in levels]).alias("budget_line_id")
    return base.select("jurisdiction_code", "fiscal_year", "direction", "source_row", *(f"{level}_source" for level in levels), *split, "phase_id", ident, "source_amount")


def canonical(staged: DataFrame, direction: str) -> DataFrame:
    """The published form: codes, labels, and amounts in single units; sources and constants are dropped."""
    return staged.withColumn("value", F.col("source_amount") * F.lit(UNIT).cast("bigint")).select(*canonical_columns(direction))
