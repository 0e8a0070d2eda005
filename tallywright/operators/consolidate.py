"""Transfers between funds of one body: found on the revenue side, paired with what was paid, eliminated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.text import differs
from tallywright.model import GENERAL_FUND, INTERFUND_BASIS, NO_RULE, REVENUE_BASIS, UNIT


def is_interfund(kan: Column, kou: Column) -> Column:
    """A transfer in, unless it comes out of a reserve; missing labels are none."""
    return F.coalesce(kan.contains("繰入金") & ~kou.contains("基金繰入金"), F.lit(False))


def counterpart(interfund: Column, kou: Column, moku: Column) -> Column:
    sender = F.when(kou == "特別会計繰入金", F.regexp_replace(moku, r"繰入金\z", "")).otherwise(GENERAL_FUND)
    return F.when(interfund, sender)


def judge_revenue(lines: DataFrame) -> DataFrame:
    interfund = is_interfund(F.col("kan_label"), F.col("kou_label"))
    return lines.withColumn("__in", interfund).select(
        "jurisdiction_code",
        "fiscal_year",
        "direction",
        "budget_line_id",
        "source_row",
        F.lit("not-applicable").alias("cofog_status"),
        F.lit("").alias("cofog_division"),
        F.when(F.col("__in"), "eliminated").otherwise("retained").alias("cofog_consolidation"),
        F.when(F.col("__in"), "項").otherwise(NO_RULE).alias("cofog_decided_at_level"),
        F.when(F.col("__in"), "revenue-interfund").alias("cofog_rule_id"),
        counterpart(F.col("__in"), F.col("kou_label"), F.col("moku_label")).alias("cofog_counterpart_fund"),
        F.when(F.col("__in"), INTERFUND_BASIS).otherwise(REVENUE_BASIS).alias("cofog_basis"),
    )


def _scope(df: DataFrame) -> list[str]:
    return [c for c in ("jurisdiction_code", "fiscal_year") if c in df.columns]


def paid_by_pair(core: DataFrame, staged: DataFrame) -> DataFrame:
    """from, to, paid: eliminated expenditure by fund and counterpart, per jurisdiction and year."""
    lines = core.where("cofog_consolidation = 'eliminated'").select("budget_line_id", "cofog_counterpart_fund").join(staged, "budget_line_id")
    return lines.groupBy(*_scope(staged), F.col("fund_label").alias("from"), F.col("cofog_counterpart_fund").alias("to")).agg((F.sum("source_amount") * UNIT).alias("paid"))


def received_by_pair(core: DataFrame, staged: DataFrame) -> DataFrame:
    """from, to, received, received_count: eliminated revenue, seen from the fund that paid."""
    lines = core.where("cofog_consolidation = 'eliminated'").select("budget_line_id", "cofog_counterpart_fund").join(staged, "budget_line_id")
    return lines.groupBy(*_scope(staged), F.col("cofog_counterpart_fund").alias("from"), F.col("fund_label").alias("to")).agg((F.sum("source_amount") * UNIT).alias("received"), F.count(F.lit(1)).alias("received_count"))


def pairs(paid: DataFrame, received: DataFrame, how: str = "inner") -> DataFrame:
    """Both sides by pair; ``full_outer`` also shows pairs of which a side is missing. ok is false there."""
    keys = [c for c in ("jurisdiction_code", "fiscal_year", "from", "to") if c in paid.columns and c in received.columns]
    return paid.join(received, keys, how).withColumn("ok", ~differs(F.col("paid"), F.col("received")))
