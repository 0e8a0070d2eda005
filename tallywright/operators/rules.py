"""First match wins: an ordered rule table over lines.

A rule has conditions on named columns; '' or null is "don't care". Three kinds: equal, one of a '|'-list, and
LIKE '%x%'. Two plans give the same rows:

* ``classify_join``: for rule tables of any size. Only the distinct kinds of lines (their values under conditions) meet the rules: rules
  are grouped by which columns they constrain, and each group is hash-joined on those with fixed alternatives; what LIKE
  asks is checked on the joined rows. The first rule of each kind is then joined back to the lines;
* ``classify_compiled``: the rules become one CASE expression when the table is small enough to be read by the
  driver. Map-only: no join, no shuffle. This is the plan for large inputs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.text import like_within
from tallywright.model import NO_RULE, NO_RULE_BASIS

#: Rules that may be compiled; beyond, the join is used. Bytes of rules that may be broadcast.
MOST_RULES, MOST_BYTES = 500, 8 << 20


@dataclass(frozen=True)
class Condition:
    """``rule`` column against ``line`` column. kind: eq, list, or mode (LIKE if the rule's ``mode`` column says contains, else list)."""

    line: str
    rule: str
    kind: str = "eq"
    mode: str = ""


@dataclass(frozen=True)
class RuleBook:
    conditions: Sequence[Condition]
    outcomes: Sequence[str]
    order: str = "priority"
    key: str = "rule_id"


BUDGET_RULES = RuleBook(
    conditions=(
        Condition("jurisdiction_code", "applies_to"),
        Condition("fund_label", "match_fund"),
        Condition("kan_label", "match_kan"),
        Condition("kou_label", "match_kou", "list"),
        Condition("moku_label", "match_moku", "mode", "moku_mode"),
        Condition("setsu_label", "match_setsu"),
    ),
    outcomes=("status", "division", "consolidation", "decided_at_level", "counterpart_fund", "basis"),
)


def normalised(rules: DataFrame, book: RuleBook) -> DataFrame:
    """Null conditions become ''; a null mode is eq."""
    out = rules
    for c in book.conditions:
        out = out.withColumn(c.rule, F.coalesce(c.rule, F.lit("")))
        if c.mode:
            out = out.withColumn(c.mode, F.coalesce(c.mode, F.lit("eq")))
    return out


def _alternatives(c: Condition) -> Column:
    """The values that meet a condition: null for any, [] where only LIKE can say."""
    wanted = F.col(c.rule)
    listed = F.split(wanted, "[|]") if c.kind in ("list", "mode") else F.array(wanted)
    if c.kind == "mode":
        listed = F.when(F.col(c.mode) == "contains", F.array().cast("array<string>")).otherwise(listed)
    return F.when(wanted != "", listed)


def _small(rules: DataFrame) -> bool:
    size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) * 4 + 16 for c in rules.columns), F.lit(0))
    return (rules.agg(F.sum(size).alias("n")).first()["n"] or 0) <= MOST_BYTES


def with_first(lines: DataFrame, rules: DataFrame, book: RuleBook) -> DataFrame:
    """``lines`` with a column ``rule``: the struct of the first rule's key and outcomes, null where none holds."""
    names = list(dict.fromkeys(c.line for c in book.conditions))
    kinds = lines.select(*(F.coalesce(n, F.lit("\0")).alias(f"__k_{n}") for n in names)).distinct()
    held = normalised(rules, book)
    shaped = held.select(*(F.col(c).alias(f"__{c}") for c in held.columns), *(_alternatives(c).alias(f"__a{i}") for i, c in enumerate(book.conditions)))
    fixed = F.concat(*(F.when(F.size(f"__a{i}") > 0, "1").otherwise("0") for i in range(len(book.conditions))))
    shaped = shaped.withColumn("__shape", fixed)
    shapes = sorted(r[0] for r in shaped.select("__shape").distinct().collect())  # at most 2 to the number of conditions
    small = _small(rules)
    found = None
    for shape in shapes:
        part, equal, other = shaped.where(F.col("__shape") == shape), F.lit(True), F.lit(True)
        for i, c in enumerate(book.conditions):
            line = F.col(f"__k_{c.line}")
            if shape[i] == "1":
                part = part.withColumn(f"__v{i}", F.explode(F.array_distinct(f"__a{i}")))
                equal = equal & (line == F.col(f"__v{i}"))
            else:
                other = other & ((F.col(f"__{c.rule}") == "") | ((line != "\0") & like_within(line, F.col(f"__{c.rule}"))))
        hit = kinds.join(F.broadcast(part) if small else part, equal & other)
        hit = hit.select(*(f"__k_{n}" for n in names), F.struct(F.col(f"__{book.order}").alias("o"), *(F.col(f"__{c}").alias(c) for c in (book.key, *book.outcomes))).alias("r"))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = kinds.withColumn("r", F.lit(None).cast("struct<o:int," + ",".join(f"{c}:string" for c in (book.key, *book.outcomes)) + ">")).where("false")
    first = found.groupBy(*(f"__k_{n}" for n in names)).agg(F.min_by("r", "r.o").alias("rule"))
    met = F.lit(True)
    for n in names:
        met = met & (F.coalesce(F.col(n), F.lit("\0")) == F.col(f"__k_{n}"))
    return lines.join(first, met, "left").drop(*(f"__k_{n}" for n in names))


def match_join(lines: DataFrame, rules: DataFrame, book: RuleBook, line_key: Sequence[str]) -> DataFrame:
    """Each line's first rule: line_key, the rule's key and outcomes. Lines without a rule are absent."""
    return with_first(lines, rules, book).where("rule IS NOT NULL").select(*line_key, *(F.col(f"rule.{c}").alias(c) for c in (book.key, *book.outcomes)))


def first_match(rules: list[dict], book: RuleBook) -> Column:
    """One expression: a struct of the key and outcomes of the first rule that holds, else null."""
    out = None
    names = (book.key, *book.outcomes)
    for rule in sorted(rules, key=lambda x: x[book.order]):
        holds = F.lit(True)
        for c in book.conditions:
            wanted = rule[c.rule] or ""
            if wanted:
                holds = holds & _constant(c, wanted, rule.get(c.mode) if c.mode else None)
        found = F.struct(*(F.lit(rule[n]).cast("string").alias(n) for n in names))
        out = F.when(holds, found) if out is None else out.when(holds, found)
    if out is None:
        return F.lit(None).cast("struct<" + ",".join(f"{n}:string" for n in names) + ">")
    return out


def _constant(c: Condition, wanted: str, mode: str | None) -> Column:
    line = F.col(c.line)
    if c.kind == "mode" and mode == "contains":
        return F.coalesce(line.like(f"%{wanted}%"), F.lit(False))
    if c.kind == "eq":
        return F.coalesce(line == wanted, F.lit(False))
    return F.coalesce(line.isin(wanted.split("|")), F.lit(False))


def match_compiled(lines: DataFrame, rules: DataFrame, book: RuleBook) -> DataFrame:
    """``lines`` with a column ``rule``: the struct of ``first_match``."""
    rows = [r.asDict() for r in rules.limit(MOST_RULES + 1).collect()]
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: use the join")
    return lines.withColumn("rule", first_match(rows, book))


def _judged(lines: DataFrame, rule: str) -> DataFrame:
    def pick(name: str) -> Column:
        return F.col(f"{rule}{name}")

    return lines.select(
        "jurisdiction_code",
        "fiscal_year",
        "direction",
        "budget_line_id",
        "source_row",
        F.coalesce(pick("status"), F.lit("unclassifiable")).alias("cofog_status"),
        F.coalesce(pick("division"), F.lit("")).alias("cofog_division"),
        F.coalesce(pick("consolidation"), F.lit("retained")).alias("cofog_consolidation"),
        F.coalesce(pick("decided_at_level"), F.lit(NO_RULE)).alias("cofog_decided_at_level"),
        pick("rule_id").alias("cofog_rule_id"),
        F.nullif(pick("counterpart_fund"), F.lit("")).alias("cofog_counterpart_fund"),
        F.coalesce(pick("basis"), F.lit(NO_RULE_BASIS)).alias("cofog_basis"),
    )


def classify_compiled(lines: DataFrame, rules: DataFrame, book: RuleBook = BUDGET_RULES) -> DataFrame:
    return _judged(match_compiled(lines, rules, book), "rule.")


def classify_join(lines: DataFrame, rules: DataFrame, book: RuleBook = BUDGET_RULES) -> DataFrame:
    return _judged(with_first(lines, rules, book), "rule.")


def classify(lines: DataFrame, rules: DataFrame, book: RuleBook = BUDGET_RULES) -> DataFrame:
    """The compiled plan where the rule table is small enough, else the join."""
    return classify_join(lines, rules, book) if rules.limit(MOST_RULES + 1).count() > MOST_RULES else classify_compiled(lines, rules, book)
