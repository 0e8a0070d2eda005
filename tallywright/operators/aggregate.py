"""Report aggregates and drill-down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.text import any_contains, labelled
from tallywright.sources.tables import constant
from tallywright.model import DIVISIONS, LEVELS, UNIT


def _amounts(core: DataFrame, staged: DataFrame) -> DataFrame:
    judged = core.select("budget_line_id", "cofog_status", "cofog_division", "cofog_consolidation", "cofog_decided_at_level", "cofog_rule_id")
    return judged.join(staged.select("budget_line_id", "fund_source", "kan_source", "source_amount"), "budget_line_id")


def with_division_names(df: DataFrame, code: str = "division", name: str = "divisionLabel", names: dict[str, str] = DIVISIONS) -> DataFrame:
    """The names of division codes by a join with the constant relation of both; '' for unknown codes."""
    known = F.broadcast(constant(df.sparkSession, list(names.items()), "__code string, __name string"))
    return df.join(known, F.col(code) == F.col("__code"), "left").withColumn(name, F.coalesce("__name", F.lit(""))).drop("__code", "__name")


def cells(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """kind, cell: every cell of the named columns that isn't null, one a row."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("cell")) for k, c in columns.items())))
    return df.select(each.alias("__x")).select("__x.*").where("cell IS NOT NULL")


def counted(df: DataFrame, key: str, conditions: dict[str, Column], sums: dict[str, tuple[str, Column]]) -> DataFrame:
    """key, n, how many rows meet each condition, and sums of a column over those that meet one (0 if none does)."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(c).alias(name) for name, c in conditions.items()),
        *(F.coalesce(F.sum(F.when(c, F.col(what))), F.lit(0)).alias(name) for name, (what, c) in sums.items()),
    )


def _total() -> Column:
    return (F.sum("source_amount") * UNIT).alias("sum")


def by_state(core: DataFrame, staged: DataFrame) -> DataFrame:
    out = _amounts(core, staged).groupBy(F.col("cofog_status").alias("status"), F.col("cofog_division").alias("division"), F.col("cofog_consolidation").alias("consolidation")).agg(F.count(F.lit(1)).alias("count"), _total())
    return out.withColumn("divisionLabel", labelled(F.col("division"), DIVISIONS)).orderBy(F.desc("sum"), "status", "division", "consolidation")


def by_kan(core: DataFrame, staged: DataFrame, rules: DataFrame) -> DataFrame:
    """By fund, kan and rule, so that a rule's reason belongs to its own amount."""
    sums = _amounts(core, staged).groupBy(
        F.col("fund_source").alias("fund"),
        F.col("kan_source").alias("kan"),
        F.col("cofog_division").alias("division"),
        F.col("cofog_status").alias("status"),
        F.col("cofog_decided_at_level").alias("decidedAtLevel"),
        F.col("cofog_rule_id").alias("ruleId"),
    ).agg(_total())
    reasons = F.broadcast(rules.select(F.col("rule_id").alias("ruleId"), "basis"))
    return sums.join(reasons, "ruleId", "left").withColumn("divisionLabel", labelled(F.col("division"), DIVISIONS)).orderBy(F.desc("sum"), "fund", "kan", F.asc_nulls_last("ruleId"))


def by_level(core: DataFrame, staged: DataFrame) -> DataFrame:
    return _amounts(core, staged).groupBy(F.col("cofog_decided_at_level").alias("level")).agg(F.count(F.lit(1)).alias("count"), _total()).orderBy(F.desc("sum"), "level")


def not_assigned(core: DataFrame, staged: DataFrame, rules: DataFrame) -> DataFrame:
    sums = _amounts(core, staged).where("cofog_status <> 'assigned'").groupBy(F.col("cofog_status").alias("status"), F.col("fund_source").alias("fund"), F.col("kan_source").alias("kan"), F.col("cofog_rule_id").alias("ruleId")).agg(_total())
    return sums.join(F.broadcast(rules.select(F.col("rule_id").alias("ruleId"), "basis")), "ruleId", "left").orderBy(F.desc("sum"), "fund", "kan", F.asc_nulls_last("ruleId"))


def level_profile(df: DataFrame, levels: Sequence[tuple[str, str]]) -> DataFrame:
    """level, distinct_codes, distinct_paths, reused: ``levels`` as (code column, cell column), outermost first.

    A path is a struct, so no separator can be missing between its cells. Each level's distinct values are
    found by a plain distinct of one pass over an exploded row, which shuffles hashes of values, not all columns.
    """
    each = []
    for i, (code, _) in enumerate(levels):
        path = F.sha2(F.to_json(F.struct(*(F.col(cell).alias(f"c{j}") for j, (_, cell) in enumerate(levels[: i + 1])))), 256)
        each += [F.struct(F.lit(i).alias("i"), F.lit(code).alias("level"), F.lit("code").alias("what"), F.col(code).cast("string").alias("value")), F.struct(F.lit(i).alias("i"), F.lit(code).alias("level"), F.lit("path").alias("what"), path.alias("value"))]
    values = df.select(F.explode(F.array(*each)).alias("x")).select("x.*").where("value IS NOT NULL").distinct()
    counted = values.groupBy("i", "level").agg(F.count_if(F.col("what") == "code").alias("distinct_codes"), F.count_if(F.col("what") == "path").alias("distinct_paths"))
    return counted.withColumn("reused", F.col("distinct_paths") > F.col("distinct_codes")).orderBy("i").drop("i")


def drilldown(df: DataFrame, levels: Sequence[str], path: Sequence[str] = (), query: str = "", amount: str = "value", division: str = "cofog_division", status: str = "cofog_status") -> DataFrame:
    """The children of a place in the hierarchy: name, count, sum, sums by division, statuses; largest first.

    ``path`` fixes the first levels, ``query`` keeps lines with the text in any level. Below the last level, the lines.
    """
    kept = df
    for level, value in zip(levels, path, strict=False):
        kept = kept.where(F.col(level) == value)
    if query:
        kept = kept.where(any_contains([F.col(c) for c in levels], query))
    if len(path) >= len(levels):
        return kept
    per = kept.groupBy(F.col(levels[len(path)]).alias("name"), F.col(division).alias("d"), F.col(status).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("a"))
    parts = per.groupBy("name", "d").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.collect_set("s").alias("s"))
    return parts.groupBy("name").agg(
        F.sum("n").alias("count"),
        F.sum("a").alias("sum"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("d", F.lit("")).alias("k"), F.col("a").alias("v"))))).alias("by_division"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("statuses"),
    ).orderBy(F.desc("sum"), "name")


def shares(df: DataFrame, key: str, amount: str) -> DataFrame:
    """key, sum and share of the total; the total is one row, joined back, not a window over all rows."""
    sums = df.groupBy(key).agg(F.sum(amount).alias("sum"))
    whole = df.agg(F.sum(amount).alias("__all"))
    return sums.crossJoin(F.broadcast(whole)).select(key, "sum", (F.col("sum") / F.col("__all")).alias("share")).orderBy(F.desc("sum"), key)


def headline(core: DataFrame, staged: DataFrame) -> DataFrame:
    """total, assigned, eliminated and the assigned share."""
    amounts = _amounts(core, staged)
    out = amounts.agg(
        (F.sum("source_amount") * UNIT).alias("total"),
        (F.sum(F.when(F.col("cofog_status") == "assigned", F.col("source_amount"))) * UNIT).alias("assigned"),
        (F.sum(F.when(F.col("cofog_consolidation") == "eliminated", F.col("source_amount"))) * UNIT).alias("eliminated"),
    )
    return out.withColumn("assigned_share", F.col("assigned") / F.nullif(F.col("total"), F.lit(0)))


def best_per_group(df: DataFrame, key: str, rank: str, tie: str) -> DataFrame:
    """The row with the highest rank; on a tie the first by ``tie``."""
    first = Window.partitionBy(key).orderBy(F.desc(rank), tie)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def frequencies(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), value)


def detail(canonical: DataFrame, derived: DataFrame, rules: DataFrame, direction: str) -> DataFrame:
    """Canonical lines with their judgment, the rule's reason, the division's name and the rebuilt source cells; by source row as a number."""
    judged = derived.select("budget_line_id", "cofog_status", F.col("cofog_division").alias("cofog_division_code"), "cofog_consolidation", "cofog_decided_at_level", "cofog_rule_id")
    reasons = F.broadcast(rules.select(F.col("rule_id").alias("cofog_rule_id"), F.col("basis").alias("cofog_basis")))
    sources = [F.concat(f"{level}_code", f"{level}_label").alias(f"{level}_source") for level in LEVELS[direction]]
    out = canonical.join(judged, "budget_line_id", "left").join(reasons, "cofog_rule_id", "left")
    return out.select(*canonical.columns, *sources, F.lit("千円").alias("source_amount_unit"), "cofog_status", "cofog_division_code", "cofog_consolidation", "cofog_decided_at_level", "cofog_rule_id", labelled(F.col("cofog_division_code"), DIVISIONS).alias("cofog_division_label"), "cofog_basis").orderBy(F.col("source_row").cast("long"))


def as_column_table(df: DataFrame) -> dict:
    """{columns, rows}: a small result (a preview) for transport, all cells as text, null as ''."""
    return {"columns": df.columns, "rows": [["" if v is None else str(v) for v in r] for r in df.toLocalIterator()]}


def to_rows(table: dict) -> list[dict[str, str]]:
    """A column table back as one mapping a row; a row of another length is an error."""
    if any(len(r) != len(table["columns"]) for r in table["rows"]):
        raise ValueError("a row hasn't as many cells as there are columns")
    return [dict(zip(table["columns"], r, strict=True)) for r in table["rows"]]
