"""Checks as queries that return the rows at fault. An empty result passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import text
from tallywright.model import CONSOLIDATIONS, DIVISIONS, LEVELS, STATUSES, UNIT, Layout
from tallywright.operators import compare, consolidate


@dataclass(frozen=True)
class Check:
    name: str
    rows: DataFrame
    severity: str = "error"


@dataclass(frozen=True)
class Result:
    name: str
    severity: str
    failures: int

    @property
    def status(self) -> str:
        return "pass" if not self.failures else "warn" if self.severity == "warn" else "fail"


def run(checks: list[Check], together: int = 12) -> list[Result]:
    """Counts all rows at fault, the counts of up to ``together`` checks in one job."""
    found = {}
    for at in range(0, len(checks), together):
        some = checks[at : at + together]
        counts = [c.rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n") for i, c in enumerate(some, at)]
        found |= {r["i"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()}
    return [Result(c.name, c.severity, found[i]) for i, c in enumerate(checks)]


def summary(results: list[Result]) -> dict[str, int]:
    return {s: sum(r.status == s for r in results) for s in ("pass", "fail", "warn")}


def gate(results: list[Result]) -> None:
    bad = [r.name for r in results if r.status == "fail"]
    if bad:
        raise AssertionError(f"checks failed: {', '.join(bad)}")


def _cells(df: DataFrame, columns: list, amount) -> DataFrame:
    return df.select("jurisdiction_code", "fiscal_year", "phase_id", F.array(*columns, amount.cast("string")).alias("cells"))


_BAG = ["jurisdiction_code", "fiscal_year", "phase_id", "cells"]


def amount_normalization(canonical: DataFrame) -> DataFrame:
    return canonical.where(text.differs(F.col("value"), F.col("source_amount") * UNIT)).select("budget_line_id")


def canonical_preserves_source(raw: DataFrame, staged: DataFrame, direction: str, layout: Layout, as_typed: bool = False) -> DataFrame:
    """As many rows of each text on both sides; amounts are compared as published text."""
    *cells, amount = layout.columns[direction]
    named = raw.withColumnsRenamed({"jurisdiction": "jurisdiction_code", "phase": "phase_id"}).withColumn("fiscal_year", F.col("year").cast("int"))
    a = _cells(named, [text.trim_cell(F.col(f"`{c}`"), as_typed) for c in cells], F.col(f"`{amount}`"))
    return compare.multiset_diff(a, _cells(staged, [F.col(f"{x}_source") for x in LEVELS[direction]], F.col("source_amount")), _BAG)


def staging_is_one_to_one(raw: DataFrame, staged: DataFrame) -> DataFrame:
    a = raw.groupBy(F.col("jurisdiction").alias("j"), F.col("year").cast("int").alias("y"), F.col("direction").alias("d")).agg(F.count(F.lit(1)).alias("raw_rows"))
    b = staged.groupBy(F.col("jurisdiction_code").alias("j"), F.col("fiscal_year").alias("y"), F.col("direction").alias("d")).agg(F.count(F.lit(1)).alias("staged_rows"))
    return compare.reconcile(a, b, ["j", "y", "d"], "raw_rows", "staged_rows")


def core_covers_staging(staged: DataFrame, core: DataFrame) -> DataFrame:
    keys = ["jurisdiction_code", "fiscal_year", "direction"]
    counts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((staged, "staged_rows"), (core, "core_rows"))]
    return compare.reconcile(*counts, keys, "staged_rows", "core_rows")


def code_determines_label(staged: DataFrame, direction: str, levels: int = 4) -> DataFrame:
    """Below one parent a code has one label, from the fund down to moku; one pass for all levels."""
    names = LEVELS[direction]
    each = [F.struct(F.lit(names[i]).alias("level"), F.array(*(F.col(f"{x}_source") for x in names[:i]), F.col(f"{names[i]}_code")).alias("path"), F.col(f"{names[i]}_label").alias("label")) for i in range(levels)]
    flat = staged.select("jurisdiction_code", "fiscal_year", F.explode(F.array(*each)).alias("x")).select("jurisdiction_code", "fiscal_year", "x.*")
    return compare.dependency_violations(flat, ["jurisdiction_code", "fiscal_year", "level", "path"], "label")


def code_label_reconstructs_source(staged: DataFrame, direction: str, layout: Layout) -> DataFrame:
    each = []
    for x in LEVELS[direction]:
        cell, code, label = F.col(f"{x}_source"), F.col(f"{x}_code"), F.col(f"{x}_label")
        present = cell.isNull() | ~cell.isin(*layout.absent)
        bad = text.differs(cell, F.concat(code, label)) | ~F.coalesce(text.is_code(code), F.lit(False))
        each.append(F.when(present & bad, F.lit(x)))
    return staged.select("budget_line_id", F.explode(F.array_compact(F.array(*each))).alias("level"))


def judgment_invariants(core: DataFrame, lines: DataFrame) -> DataFrame:
    """rule, budget_line_id: domains, divisions where and only where assigned, counterparts of what is eliminated; every line once."""
    division = F.coalesce("cofog_division", F.lit(""))
    rules = [
        ("status", ~F.col("cofog_status").isin(*STATUSES)),
        ("consolidation", ~F.col("cofog_consolidation").isin(*CONSOLIDATIONS)),
        ("assigned without division", (F.col("cofog_status") == "assigned") & ~division.isin(*DIVISIONS)),
        ("division without assignment", (F.col("cofog_status") != "assigned") & (division != "")),
        ("eliminated without counterpart", (F.col("cofog_consolidation") == "eliminated") & F.col("cofog_counterpart_fund").isNull()),
    ]
    found = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules)))
    odd = core.select("budget_line_id", F.explode(found).alias("rule"))
    ids = compare.multiset_diff(lines, core, ["budget_line_id"]).select("budget_line_id", F.lit("not judged once").alias("rule"))
    return odd.unionByName(ids)


def consolidation_pairs_balance(paid: DataFrame, received: DataFrame) -> DataFrame:
    """Pairs whose sides differ; one row if nothing at all was eliminated, as the check would then be empty."""
    keys = ["jurisdiction_code", "fiscal_year", "from", "to"]
    wrong = compare.reconcile(paid, received, keys, "paid", "received").select("from", "to")
    nothing = paid.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("(nothing eliminated)").alias("from"), F.lit("").alias("to"))
    return wrong.unionByName(nothing)


def funds_balance(expenditure: DataFrame, revenue: DataFrame) -> DataFrame:
    keys = ["jurisdiction_code", "fiscal_year", "fund_label"]
    sums = [df.groupBy(*keys).agg(F.sum("source_amount").alias(n)) for df, n in ((expenditure, "spent"), (revenue, "received"))]
    return compare.reconcile(*sums, keys, "spent", "received")


def composite_key_is_unique(staged: DataFrame, direction: str) -> DataFrame:
    return compare.duplicates(staged, ["jurisdiction_code", "fiscal_year", "phase_id", *(f"{x}_source" for x in LEVELS[direction])])


def inputs_are_not_empty(spark: SparkSession, expected: list[tuple[str, str]], raw: DataFrame) -> DataFrame:
    wanted = spark.createDataFrame(expected, "jurisdiction_code string, direction string")
    return compare.not_covered(wanted, raw.withColumnRenamed("jurisdiction", "jurisdiction_code"), ["jurisdiction_code", "direction"])


def package_preserves_source(package: DataFrame, staged: DataFrame, direction: str, jurisdiction: str) -> DataFrame:
    """The CSV read back as text against staging, row texts with their numbers."""
    levels = [F.concat(f"{x}_code", f"{x}_label") for x in LEVELS[direction]]
    a = _cells(package.withColumn("jurisdiction_code", F.lit(jurisdiction)).withColumn("fiscal_year", F.col("fiscal_year").cast("int")), levels, F.col("source_amount"))
    return compare.multiset_diff(a, _cells(staged, levels, F.col("source_amount")), _BAG)


def derived_covers_core(derived: DataFrame, core: DataFrame) -> DataFrame:
    """Lines that one side lacks; and a row if the package is empty."""
    columns = ["budget_line_id", "cofog_status", "cofog_division", "cofog_consolidation"]
    lost = compare.set_diff(derived, core, columns).select("budget_line_id", "side")
    nothing = derived.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("").alias("budget_line_id"), F.lit("empty").alias("side"))
    return lost.unionByName(nothing)


def published_adds_up(published: DataFrame, meta: DataFrame) -> DataFrame:
    keys = ["jurisdiction_code", "fiscal_year"]
    sums = published.groupBy(*keys, "direction").agg(F.sum("amount_thousand_yen").alias("amount"))
    both = sums.join(meta.select(*keys, "total_thousand_yen"), keys, "left")
    return both.where(text.differs(F.col("amount"), F.col("total_thousand_yen"))).select(*keys, "direction")


def published_matches(published: DataFrame, meta: DataFrame, staged: dict[str, DataFrame]) -> DataFrame:
    """Ours against the published totals by kan, for the fund and phase that each document states."""
    keys = ["jurisdiction_code", "fiscal_year", "direction", "kan_label"]
    scope = meta.select("jurisdiction_code", "fiscal_year", F.col("fund").alias("fund_source"), F.col("phase").alias("phase_id")).distinct()
    columns = ["jurisdiction_code", "fiscal_year", "direction", "fund_source", "phase_id", "kan_label", "source_amount"]
    ours = reduce(DataFrame.unionByName, [df.select(*columns) for df in staged.values()])
    ours = ours.join(F.broadcast(scope), ["jurisdiction_code", "fiscal_year", "fund_source", "phase_id"], "left_semi").groupBy(*keys).agg(F.sum("source_amount").alias("ours"))
    theirs = published.join(F.broadcast(scope.select("jurisdiction_code", "fiscal_year")), ["jurisdiction_code", "fiscal_year"], "left_semi").select(*keys, F.col("amount_thousand_yen").alias("theirs"))
    return compare.reconcile(ours, theirs, keys, "ours", "theirs")


def surrounding_whitespace(raw: DataFrame, direction: str, layout: Layout) -> DataFrame:
    """Cells that trimming changes; a warning."""
    cells = F.explode(F.array(*(F.col(f"`{c}`") for c in layout.columns[direction][:-1])))
    return raw.select("source_row", cells.alias("cell")).where(text.trim_cell(F.col("cell")) != F.col("cell"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull()).select(column)


def unique(df: DataFrame, column: str) -> DataFrame:
    return compare.duplicates(df.where(F.col(column).isNotNull()), [column])


def accepted(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(column)


def of_staging(raw: DataFrame, staged: DataFrame, direction: str, layout: Layout) -> list[Check]:
    return [
        Check(f"canonical_preserves_source_{direction}", canonical_preserves_source(raw, staged, direction, layout)),
        Check(f"staging_is_one_to_one_{direction}", staging_is_one_to_one(raw, staged)),
        Check(f"code_determines_label_{direction}", code_determines_label(staged, direction)),
        Check(f"code_label_reconstructs_source_{direction}", code_label_reconstructs_source(staged, direction, layout)),
        Check(f"composite_key_is_unique_{direction}", composite_key_is_unique(staged, direction)),
        Check(f"surrounding_whitespace_{direction}", surrounding_whitespace(raw, direction, layout), "warn"),
        Check(f"source_row_not_null_{direction}", not_null(staged, "source_row")),
        Check(f"source_amount_not_null_{direction}", not_null(staged, "source_amount")),
        Check(f"budget_line_id_not_null_{direction}", not_null(staged, "budget_line_id")),
        Check(f"budget_line_id_unique_{direction}", unique(staged, "budget_line_id")),
    ]


def of_rules(rules: DataFrame) -> list[Check]:
    out = [Check(f"{c}_{n}", f(rules, c)) for c in ("rule_id", "priority") for n, f in (("not_null", not_null), ("unique", unique))]
    return [*out, Check("rule_status_accepted", accepted(rules, "status", STATUSES)), Check("rule_consolidation_accepted", accepted(rules, "consolidation", CONSOLIDATIONS))]


def of_core(spent: DataFrame, got: DataFrame, core_spent: DataFrame, core_got: DataFrame) -> list[Check]:
    paid, received = consolidate.paid_by_pair(core_spent, spent), consolidate.received_by_pair(core_got, got)
    return [
        Check("core_covers_expenditure", core_covers_staging(spent, core_spent)),
        Check("core_covers_revenue", core_covers_staging(got, core_got)),
        Check("judgment_invariants", judgment_invariants(core_spent, spent)),
        Check("consolidation_pairs_balance", consolidation_pairs_balance(paid, received)),
        Check("funds_balance", funds_balance(spent, got)),
    ]
