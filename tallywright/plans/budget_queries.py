"""The budget engine's own operators over the driver's tables: a made-up budget, bulletins and gates, each cell given by one
expression that Spark and the SQL share; what is done with the cells is the library's there and plain SQL here."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions import text
from tallywright.model import DIVISIONS, EXPENDITURE, LAYOUTS, LEVELS, RULES_DDL
from tallywright.operators import aggregate, consolidate, lineage, profile, rules, schema, staging
from tallywright.plans import checks
from tallywright.plans.queries import _shared, query, table
from tallywright.sources import catalog, raw, taxonomy
from tallywright.sources import tables as sources

CITY, LAYOUT = "132047", LAYOUTS["132047"]


def shown(df: DataFrame, cells: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(x).alias(name) for name, x in cells.items()))


def listed(cells: dict[str, str]) -> str:
    return ", ".join(f'{x} AS "{name}"' for name, x in cells.items())


def values(rows: list[tuple]) -> str:
    def said(x: object) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, (list, tuple)):
            return f"[{', '.join(map(said, x))}]"
        return str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(said, r)) + ")" for r in rows)


# --- a budget of orders ---------------------------------------------------------------------------------------

SPENT = dict(
    zip(
        ("source_row", *LAYOUT.columns[EXPENDITURE], "jurisdiction", "year", "phase", "direction"),
        (
            "o_orderkey",
            "CASE o_orderstatus WHEN 'O' THEN '01一般会計' ELSE '02国民健康保険事業特別会計' END",
            "CASE o_custkey % 3 WHEN 0 THEN '03民生費' WHEN 1 THEN ' 12公債費　' ELSE '01議会費' END",
            "'0' || CAST(o_custkey % 7 + 1 AS STRING) || CASE WHEN o_custkey % 2 = 0 THEN '小学校費' ELSE '議会費' END",
            "CASE o_orderkey % 5 WHEN 0 THEN '05国民健康保険事業特別会計繰出金' WHEN 1 THEN '01元金' ELSE '02利子' END",
            "'0' || CAST(o_custkey % 10 AS STRING) || '事業'",
            "CASE o_orderkey % 4 WHEN 0 THEN '28繰出金' WHEN 1 THEN '24積立金' ELSE '10需用費' END",
            "CASE WHEN o_custkey % 50 = 0 THEN '0' ELSE '01item' || CAST(o_custkey AS STRING) END",
            "CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING)",
            f"'{CITY}'",
            "CAST(year(o_orderdate) AS STRING)",
            "'approved'",
            "'expenditure'",
        ),
        strict=True,
    )
)
BUDGET_RULES = [
    (1, "transfer", CITY, None, None, None, "国民健康保険事業特別会計繰出金", "contains", "繰出金", "assigned", "07", "eliminated", "目", "国民健康保険事業特別会計", "to health"),
    (2, "principal", None, None, "公債費", None, "元金", "eq", None, "out-of-scope", None, "retained", "目", None, "repaid"),
    (3, "interest", None, None, "公債費", None, "利子|元金", "eq", None, "assigned", "01", "retained", "目", None, "interest"),
    (4, "saving", None, None, None, None, None, None, "積立金", "out-of-scope", None, "retained", "節", None, "saved"),
    (5, "schools", CITY, "一般会計", None, "小学校費|中学校費", None, None, None, "assigned", "09", "retained", "項", None, "schools"),
    (6, "elsewhere", "999999", None, None, None, None, None, None, "assigned", "02", "retained", "会計", None, "another body"),
    (7, "council", None, None, "議会費", None, None, None, None, "unclassifiable", None, "retained", "款", None, "council"),
]


def spent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(table(spark, sf_dir, "orders"), SPENT)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(spent(spark, sf_dir), EXPENDITURE, LAYOUT)


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUDGET_RULES, RULES_DDL)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(staged(spark, sf_dir), rule_table(spark))


def _staged_sql() -> str:
    levels = LEVELS[EXPENDITURE]
    blanks = "' ' || chr(9) || chr(10) || chr(13) || chr(12288)"
    trimmed = ", ".join(f'trim("{c}", {blanks}) AS {x}_source' for x, c in zip(levels, LAYOUT.columns[EXPENDITURE], strict=False))
    parts = ", ".join(f"regexp_extract({x}_source, '^([0-9]{{2}})', 1) AS {x}_code, regexp_replace({x}_source, '^[0-9]{{2}}', '') AS {x}_label" for x in levels)
    tail = " || chr(31) || ".join(["jurisdiction_code", "CAST(fiscal_year AS VARCHAR)", "direction", "phase_id", *(f"{x}_source" for x in levels)])
    return f"""raw AS (SELECT {listed(SPENT)} FROM orders),
trimmed AS (SELECT jurisdiction AS jurisdiction_code, CAST(year AS INT) AS fiscal_year, direction, source_row, {trimmed}, phase AS phase_id, CAST("{LAYOUT.columns[EXPENDITURE][-1]}" AS BIGINT) AS source_amount FROM raw),
staged AS (SELECT *, {parts}, jurisdiction_code || ':' || fiscal_year || ':' || direction || ':' || phase_id || ':' || substr(sha256({tail}), 1, 16) AS budget_line_id FROM trimmed)"""


STAGED = _staged_sql()
CORE = f"""{STAGED}, rules(priority, rule_id, applies_to, match_fund, match_kan, match_kou, match_moku, moku_mode, match_setsu, status, division, consolidation, decided_at_level, counterpart_fund, basis) AS (VALUES {values(BUDGET_RULES)}),
hits AS (SELECT source_row, rules.*, row_number() OVER (PARTITION BY source_row ORDER BY priority) AS rn FROM staged JOIN rules ON coalesce(applies_to, jurisdiction_code) = jurisdiction_code
  AND coalesce(match_fund, fund_label) = fund_label AND coalesce(match_kan, kan_label) = kan_label AND coalesce(match_setsu, setsu_label) = setsu_label AND (match_kou IS NULL OR list_contains(str_split(match_kou, '|'), kou_label))
  AND (match_moku IS NULL OR CASE WHEN moku_mode = 'contains' THEN moku_label LIKE '%' || match_moku || '%' ELSE list_contains(str_split(match_moku, '|'), moku_label) END)),
core AS (SELECT s.jurisdiction_code, s.fiscal_year, s.direction, s.budget_line_id, s.source_row, s.source_amount, s.fund_source, s.kan_source, s.fund_label, coalesce(h.status, 'unclassifiable') AS cofog_status, coalesce(h.division, '') AS cofog_division,
  coalesce(h.consolidation, 'retained') AS cofog_consolidation, coalesce(h.decided_at_level, '（規則なし）') AS cofog_decided_at_level, h.rule_id AS cofog_rule_id, nullif(h.counterpart_fund, '') AS cofog_counterpart_fund,
  coalesce(h.basis, 'どの規則にも当たらなかった。捨てずに分類不能として残す') AS cofog_basis FROM staged s LEFT JOIN (SELECT * FROM hits WHERE rn = 1) h USING (source_row))"""
JUDGED = "jurisdiction_code, fiscal_year, direction, budget_line_id, source_row, cofog_status, cofog_division, cofog_consolidation, cofog_decided_at_level, cofog_rule_id, cofog_counterpart_fund, cofog_basis"
DIVISION_NAMES = f"divisions(code, label) AS (VALUES {values(list(DIVISIONS.items()))})"


@query(f"WITH {STAGED} SELECT jurisdiction_code, fiscal_year, direction, source_row, {', '.join(f'{x}_{p}' for x in LEVELS[EXPENDITURE] for p in ('source', 'code', 'label'))}, phase_id, budget_line_id, source_amount FROM staged")
def staging_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


@query(f"WITH {STAGED} SELECT budget_line_id, fiscal_year, phase_id, source_row, {', '.join(f'{x}_{p}' for x in LEVELS[EXPENDITURE] for p in ('code', 'label'))}, source_amount * 1000 AS value, source_amount FROM staged")
def canonical_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.canonical(staged(spark, sf_dir), EXPENDITURE)


@query(f"WITH {CORE} SELECT {JUDGED} FROM core")
def budget_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir)


@query(f"WITH {CORE} SELECT {JUDGED} FROM core")
def budget_classified_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the plan for rule tables of any size."""
    return rules.classify_join(staged(spark, sf_dir), rule_table(spark))


def _once(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Staged lines and judgments with an identifier of each line's own: the made-up cells may agree in two lines."""
    lines = staged(spark, sf_dir).withColumn("budget_line_id", F.col("source_row").cast("string"))
    return lines, rules.classify(lines, rule_table(spark))


@query(f"WITH {CORE} SELECT CAST(sum(source_amount) * 1000 AS BIGINT) AS total, CAST(sum(source_amount) FILTER (WHERE cofog_status = 'assigned') * 1000 AS BIGINT) AS assigned, CAST(sum(source_amount) FILTER (WHERE cofog_consolidation = 'eliminated') * 1000 AS BIGINT) AS eliminated, CAST(sum(source_amount) FILTER (WHERE cofog_status = 'assigned') AS DOUBLE) / CAST(sum(source_amount) AS DOUBLE) AS assigned_share FROM core")
def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, core = _once(spark, sf_dir)
    return aggregate.headline(core, lines)


def _in_order(df: DataFrame) -> DataFrame:
    """A small ordered result with its positions, so that the order counts too."""
    return df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(df.collect(), 1)], T.StructType([T.StructField("position", T.LongType()), *df.schema.fields]))


@query(f"""WITH {CORE}, {DIVISION_NAMES}, s AS (SELECT cofog_status AS status, cofog_division AS division, cofog_consolidation AS consolidation, count(*) AS count, CAST(sum(source_amount) * 1000 AS BIGINT) AS sum FROM core GROUP BY ALL)
SELECT row_number() OVER (ORDER BY sum DESC, status, division, consolidation) AS position, s.*, coalesce(label, '') AS "divisionLabel" FROM s LEFT JOIN divisions ON code = division""")
def report_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, core = _once(spark, sf_dir)
    return _in_order(aggregate.by_state(core, lines))


@query(f"""WITH {CORE}, {DIVISION_NAMES}, s AS (SELECT cofog_rule_id AS "ruleId", fund_source AS fund, kan_source AS kan, cofog_division AS division, cofog_status AS status, cofog_decided_at_level AS "decidedAtLevel", CAST(sum(source_amount) * 1000 AS BIGINT) AS sum FROM core GROUP BY ALL)
SELECT row_number() OVER (ORDER BY sum DESC, fund, kan, "ruleId" NULLS LAST) AS position, s.*, basis, coalesce(label, '') AS "divisionLabel" FROM s LEFT JOIN rules ON rule_id = "ruleId" LEFT JOIN divisions ON code = s.division""")
def report_by_kan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, core = _once(spark, sf_dir)
    return _in_order(aggregate.by_kan(core, lines, rule_table(spark)))


@query(f"""WITH {CORE}, {DIVISION_NAMES} SELECT s.source_row, {', '.join(f's.{x}_source' for x in LEVELS[EXPENDITURE])}, s.source_amount * 1000 AS value, '千円' AS source_amount_unit, c.cofog_status, c.cofog_division AS cofog_division_code, c.cofog_rule_id,
  coalesce(label, '') AS cofog_division_label, basis AS cofog_basis FROM staged s JOIN core c USING (source_row) LEFT JOIN rules ON rule_id = c.cofog_rule_id LEFT JOIN divisions ON code = c.cofog_division""")
def detail_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, core = _once(spark, sf_dir)
    out = aggregate.detail(staging.canonical(lines, EXPENDITURE), core, rule_table(spark), EXPENDITURE)
    return out.select("source_row", *(f"{x}_source" for x in LEVELS[EXPENDITURE]), "value", "source_amount_unit", "cofog_status", "cofog_division_code", "cofog_rule_id", "cofog_division_label", "cofog_basis")


@query(f"""WITH {CORE}, paid AS (SELECT jurisdiction_code, fiscal_year, fund_label AS "from", cofog_counterpart_fund AS "to", CAST(sum(source_amount) * 1000 AS BIGINT) AS paid FROM core WHERE cofog_consolidation = 'eliminated' GROUP BY ALL),
received AS (SELECT jurisdiction_code, fiscal_year, cofog_counterpart_fund AS "from", fund_label AS "to", CAST(sum(source_amount) * 1000 AS BIGINT) AS received, count(*) AS received_count FROM core WHERE cofog_consolidation = 'eliminated' GROUP BY ALL)
SELECT jurisdiction_code, fiscal_year, "from", "to", paid, received, received_count, paid = received AS ok FROM paid JOIN received USING (jurisdiction_code, fiscal_year, "from", "to")""")
def paired_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only pairs that both sides have."""
    lines, core = _once(spark, sf_dir)
    return consolidate.pairs(consolidate.paid_by_pair(core, lines), consolidate.received_by_pair(core, lines))


@query(f"""WITH {STAGED}, a AS (SELECT jurisdiction AS j, CAST(year AS INT) AS y, direction AS d, count(*) AS raw_rows FROM raw GROUP BY ALL),
b AS (SELECT jurisdiction_code AS j, fiscal_year AS y, direction AS d, count(*) AS staged_rows FROM staged WHERE fiscal_year <> 1995 AND NOT (fiscal_year = 1996 AND source_amount < 5000) GROUP BY ALL)
SELECT j, y, d, raw_rows, staged_rows FROM a FULL JOIN b USING (j, y, d) WHERE raw_rows IS DISTINCT FROM staged_rows""")
def rows_lost_in_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = staged(spark, sf_dir).where("fiscal_year <> 1995 AND NOT (fiscal_year = 1996 AND source_amount < 5000)")
    return checks.staging_is_one_to_one(spent(spark, sf_dir), kept)


@query("SELECT '(nothing eliminated)' AS \"from\", '' AS \"to\"")
def nothing_eliminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One constant row where the check would have nothing to look at."""
    lines, core = _once(spark, sf_dir)
    none = core.where("cofog_consolidation = 'never'")
    return checks.consolidation_pairs_balance(consolidate.paid_by_pair(none, lines), consolidate.received_by_pair(none, lines))


@query(f"""WITH {STAGED}, p AS (SELECT jurisdiction_code, fiscal_year, direction, kan_label, sum(source_amount) AS amount FROM staged GROUP BY ALL),
m AS (SELECT jurisdiction_code, fiscal_year, sum(source_amount) + max(CASE WHEN fiscal_year % 2 = 0 THEN 1 ELSE 0 END) AS total FROM staged GROUP BY 1, 2)
SELECT jurisdiction_code, fiscal_year, direction FROM (SELECT jurisdiction_code, fiscal_year, direction, sum(amount) AS amount FROM p GROUP BY ALL) JOIN m USING (jurisdiction_code, fiscal_year) WHERE amount <> total""")
def published_adds_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = staged(spark, sf_dir)
    published = lines.groupBy("jurisdiction_code", "fiscal_year", "direction", "kan_label").agg(F.sum("source_amount").alias("amount_thousand_yen"))
    odd = F.when(F.col("fiscal_year") % 2 == 0, 1).otherwise(0)
    meta = lines.groupBy("jurisdiction_code", "fiscal_year").agg(F.sum("source_amount").alias("t")).select("jurisdiction_code", "fiscal_year", (F.col("t") + odd).alias("total_thousand_yen"))
    return checks.published_adds_up(published, meta)


@query(f"""WITH {STAGED} SELECT source_row, level FROM (SELECT source_row, unnest({values([tuple(LEVELS[EXPENDITURE])]).replace("(", "[").replace(")", "]")}) AS level,
  unnest([{', '.join(f"{x}_source" for x in LEVELS[EXPENDITURE])}]) AS source, unnest([{', '.join(f"{x}_code" for x in LEVELS[EXPENDITURE])}]) AS code FROM (SELECT * REPLACE (CASE WHEN source_row % 7 = 0 THEN '' ELSE kan_code END AS kan_code) FROM staged))
WHERE source <> '0' AND NOT regexp_full_match(code, '[0-9]{{2}}')""")
def cells_that_do_not_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = staged(spark, sf_dir)
    broken = lines.withColumns({"kan_code": F.when(F.col("source_row") % 7 == 0, "").otherwise(F.col("kan_code")), "budget_line_id": F.col("source_row").cast("string")})
    return checks.code_label_reconstructs_source(broken, EXPENDITURE, LAYOUT).select(F.col("budget_line_id").cast("bigint").alias("source_row"), "level")


@query(f"""WITH {STAGED} SELECT fiscal_year AS year, 'expenditure' AS direction, bool_and(fiscal_year % 3 <> 0) AS same_header, bool_and(source_amount % 1000 <> 7) AS whole_amounts, count(*) FILTER (WHERE source_row % 1001 = 0) AS quoted_rows,
  string_agg(DISTINCT fund_source, ',' ORDER BY fund_source) AS funds, CAST(sum(source_amount) FILTER (WHERE source_amount % 1000 <> 7) AS BIGINT) AS total, count(*) AS rows,
  bool_and(fiscal_year % 3 <> 0) AND bool_and(source_amount % 1000 <> 7) AND count(*) FILTER (WHERE source_row % 1001 = 0) = 0 AS compatible FROM staged GROUP BY 1
UNION ALL SELECT 2050, 'expenditure', NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
def year_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.when(F.col("fiscal_year") % 3 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    amount = F.when(F.col("source_amount") % 1000 == 7, "1.5").otherwise(F.col("source_amount").cast("string"))
    lines = staged(spark, sf_dir).select(F.col("fiscal_year").alias("year"), "direction", header.alias("header"), F.col("fund_source").alias("fund"), amount.alias("amount"), F.when(F.col("source_row") % 1001 == 0, 'x,"y"').otherwise("x,y").alias("raw_line"))
    found = profile.year_compatibility(lines, ["a", "b"])
    there = [r[0] for r in lines.select("year").distinct().collect()]
    judged = profile.year_verdicts(found, [(y, "expenditure") for y in [*there, 2050]])
    return judged.select("year", "direction", "same_header", "whole_amounts", "quoted_rows", F.array_join("funds", ",").alias("funds"), "total", "rows", "compatible")


# --- text ----------------------------------------------------------------------------------------------------------


@query("""
WITH x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '令和６年度歳出' WHEN 1 THEN '令和元年度歳入' WHEN 2 THEN '平成30年度歳入歳出' WHEN 3 THEN '令和6年度歳出予算' ELSE '地図' END AS title FROM orders)
SELECT o_orderkey, CASE WHEN title LIKE '%歳出%' AND title NOT LIKE '%歳入%' THEN 'expenditure' WHEN title LIKE '%歳入%' AND title NOT LIKE '%歳出%' THEN 'revenue' ELSE 'unknown' END AS direction,
  title LIKE '%令和6年度%' OR title LIKE '%令和６年度%' AS is_2024, title LIKE '%令和元年度%' AS is_2019, title LIKE '%平成30年度%' OR title LIKE '%平成３０年度%' AS is_2018 FROM x""")
def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("o_orderkey"), F.col("title")
    said = F.when(k % 5 == 0, "令和６年度歳出").when(k % 5 == 1, "令和元年度歳入").when(k % 5 == 2, "平成30年度歳入歳出").when(k % 5 == 3, "令和6年度歳出予算").otherwise("地図")
    given = table(spark, sf_dir, "orders").select("o_orderkey", said.alias("title"))
    return given.select("o_orderkey", text.direction_of(t).alias("direction"), *(text.has_era_label(t, y).alias(f"is_{y}") for y in (2024, 2019, 2018)))


AMOUNT = "CAST(round(o_totalprice * 100) AS BIGINT) * CASE o_custkey % 4 WHEN 0 THEN 1000 WHEN 1 THEN 1 WHEN 2 THEN -10 ELSE 0 END + o_orderkey % 10000"


@query(f"""
WITH x AS (SELECT o_orderkey, {AMOUNT} AS v FROM orders)
SELECT o_orderkey, CASE WHEN abs(v) >= 10000000000 THEN printf('%.0f', round(v / 100000000.0)) || '億円' WHEN abs(v) >= 100000000 THEN printf('%.1f', round(v / 100000000.0, 1)) || '億円'
  WHEN abs(v) >= 10000 THEN format('{{:,}}', CAST(round(v / 10000.0) AS BIGINT)) || '万円' ELSE format('{{:,}}', v) || '円' END AS said FROM x""")
def compact_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(table(spark, sf_dir, "orders"), {"o_orderkey": "o_orderkey", "v": AMOUNT}).select("o_orderkey", text.yen_short(F.col("v")).alias("said"))


@query("""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'zip' WHEN 1 THEN 'pdf' WHEN 2 THEN 'xls' WHEN 3 THEN CASE WHEN regexp_matches(html, '^\\s*<(!DOCTYPE|html)', 'i') THEN 'html' ELSE 'text' END ELSE 'text' END AS kind,
  greatest(len(list_filter(string_split(replace(html, '<', chr(10)), chr(10)), lambda x: trim(x) <> '')) - 1, 0) AS data_rows FROM pages""")
def sniffed(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.when(F.col("page_id") % 5 == 0, "PK\x03").when(F.col("page_id") % 5 == 1, "%PDF-1").when(F.col("page_id") % 5 == 3, "  ").otherwise("x")
    body = F.when(F.col("page_id") % 5 == 2, F.concat(F.unhex(F.lit("D0CF11")), F.col("html").cast("binary"))).otherwise(F.concat(head, F.col("html")).cast("binary"))
    return table(spark, sf_dir, "pages").select("page_id", text.sniff(body).alias("kind"), text.data_rows(F.replace("html", F.lit("<"), F.lit("\n"))).alias("data_rows"))


RANGES = [("a:level{1..3}:code",), ("plain",), ("b{7..8}",)]


@query(f"WITH t(name) AS (VALUES {values(RANGES)}), r AS (SELECT name, CAST(nullif(regexp_extract(name, '\\{{([0-9]+)\\.\\.', 1), '') AS INT) AS lo, CAST(nullif(regexp_extract(name, '\\.\\.([0-9]+)\\}}', 1), '') AS INT) AS hi FROM t) SELECT CASE WHEN n IS NULL THEN name ELSE regexp_replace(name, '\\{{[0-9.]+\\}}', CAST(n AS VARCHAR)) END AS name FROM (SELECT name, unnest(CASE WHEN lo IS NULL THEN [NULL] ELSE generate_series(lo, hi) END) AS n FROM r)")
def expanded_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.expand_ranges(spark.createDataFrame(RANGES, "name string"), "name")


NAMES = [("﻿全国地方公共団体コード ",), ("発行元連絡先_電話番号_",), ("発行元連絡先(電話番号)",), ("発行元所在地_建物名等（方書）",), ("分類",), (" URL",)]


@query(f"WITH t(name) AS (VALUES {values(NAMES)}) SELECT name, CASE trim(ltrim(name, chr(65279))) WHEN '発行元連絡先_電話番号_' THEN '発行元連絡先（電話番号）' WHEN '発行元連絡先(電話番号)' THEN '発行元連絡先（電話番号）' WHEN '発行元所在地_建物名等（方書）' THEN '発行元所在地_建物名等(方書)' ELSE trim(ltrim(name, chr(65279))) END AS column FROM t")
def bulletin_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(NAMES, "name string").select("name", profile.bulletin_column(F.col("name")).alias("column"))


# --- bulletins and gates -------------------------------------------------------------------------------------------

LINES = {
    "file": "'f' || CAST(c_nationkey AS STRING)",
    "row": "CAST(c_custkey AS INT)",
    "code": "CASE WHEN c_custkey % 11 = 0 THEN '12' ELSE lpad(CAST(c_custkey AS STRING), 6, '0') END",
    "issued": "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END",
    "address": "CASE WHEN c_custkey % 17 = 0 THEN 'nowhere' WHEN c_custkey % 5 = 0 THEN '' ELSE 'https://x.jp/' || CAST(c_custkey AS STRING) END",
}


def _bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.array(*(F.lit(x) for x in ("全国地方公共団体コード", "発行年月", "URL")))
    lines = shown(table(spark, sf_dir, "customer"), LINES).select("file", "row", header.alias("header"), F.array("code", "issued", "address").alias("cells"))
    return profile.bulletin_rows(lines)


@query(f"WITH x AS (SELECT {listed(LINES)} FROM customer) SELECT row, code, nullif(trim(issued), '') AS issued, nullif(address, '') AS url, concat_ws('/', CASE WHEN length(code) <> 6 THEN 'code' END, CASE WHEN address = 'nowhere' THEN 'url' END) AS problems FROM x")
def bulletin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bulletins(spark, sf_dir).select("row", "code", "issued", "url", F.array_join("problems", "/").alias("problems"))


@query(f"WITH x AS (SELECT {listed(LINES)} FROM customer) SELECT file, count(*) AS rows, count(*) FILTER (WHERE length(code) <> 6 OR address = 'nowhere') AS invalid, CASE WHEN count(*) FILTER (WHERE length(code) <> 6 OR address = 'nowhere') > 0 THEN 'broken' ELSE 'conformant' END AS conformance FROM x GROUP BY 1")
def bulletin_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.file_conformance(_bulletins(spark, sf_dir))


@query(f"""WITH x AS (SELECT {listed(LINES)} FROM customer), bad AS (SELECT file, row, concat_ws('/', CASE WHEN length(code) <> 6 THEN 'code' END, CASE WHEN address = 'nowhere' THEN 'url' END) AS problems FROM x),
few AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY row) AS n FROM bad WHERE problems <> ''),
files AS (SELECT 'f' || CAST(n_nationkey AS VARCHAR) AS file, n_nationkey % 6 AS sort FROM nation),
per AS (SELECT file, count(*) AS n, count(*) FILTER (WHERE problems <> '') AS invalid FROM bad GROUP BY 1)
SELECT files.file, CASE WHEN sort < 2 OR invalid > 0 OR sort = 3 THEN 'broken' ELSE 'conformant' END AS conformance, CASE WHEN sort >= 2 THEN coalesce(n, 0) END AS rows,
  (SELECT string_agg(CAST(row AS VARCHAR) || ': ' || problems, ',' ORDER BY row) FROM few WHERE few.file = files.file AND few.n <= 3) AS row_failures,
  CASE WHEN sort = 0 THEN 'can''t be fetched' WHEN sort = 1 THEN 'HTML, not CSV' WHEN invalid > 0 THEN 'rows at fault' WHEN sort = 3 THEN 'missing URL; extra ' END AS note FROM files LEFT JOIN per USING (file)""")
def bulletin_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sort, whole = F.col("n_nationkey") % 6, F.array(*(F.lit(x) for x in profile.BULLETIN_COLUMNS))
    content = F.when(sort == 1, "  <!doctype html><p>").when(sort > 1, "a,b").cast("binary")
    given = table(spark, sf_dir, "nation").select(F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("file"), F.when(sort == 3, F.slice(whole, 1, len(profile.BULLETIN_COLUMNS) - 1)).when(sort > 1, whole).alias("header"), content.alias("content"))
    return profile.file_verdicts(given, _bulletins(spark, sf_dir)).select("file", "conformance", "rows", F.array_join("row_failures", ",").alias("row_failures"), "note")


GATES = {
    "code": "lpad(CAST(c_custkey AS STRING), 6, '0')",
    "ocd_id": "CASE WHEN c_custkey % 13 = 0 THEN 'x/city:1' ELSE 'x/city:' || lpad(CAST(c_custkey AS STRING), 6, '0') END",
    "system_family": "CASE c_custkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'dnp' ELSE 'own-site' END",
    "transcript_url": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'https://h' || CAST(c_custkey % 9 AS STRING) || '.jp/x' END",
    "tenant": "CASE WHEN c_custkey % 2 = 0 THEN 't' ELSE NULL END",
    "tenant_id": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS INT) END",
    "ai_crawler": "CASE WHEN c_custkey % 7 = 0 THEN 'disallowed' ELSE 'unspecified' END",
    "fetch": "CASE c_custkey % 5 WHEN 0 THEN 'allow' WHEN 1 THEN 'deny' WHEN 2 THEN 'allow' ELSE 'review' END",
    "redistribute": "CASE WHEN c_custkey % 6 = 0 THEN 'allow' ELSE 'deny' END",
    "policy_version": "CASE WHEN c_custkey % 19 = 0 THEN '0' ELSE '1' END",
    "held": "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'no-source' WHEN 2 THEN 'terms-unverified' ELSE 'new' END",
}
GATE_RULES = (
    ("the identifier doesn''t end in the code", "ocd_id <> 'x/city:' || code"),
    ("no system but an address", "system_family = 'none' AND transcript_url IS NOT NULL"),
    ("fetch is allowed without an address", "g.fetch = 'allow' AND transcript_url IS NULL"),
    ("the hosted system needs a tenant", "system_family = 'dnp' AND tenant IS NULL"),
    ("fetch is allowed without a tenant id", "system_family = 'dnp' AND g.fetch = 'allow' AND tenant_id IS NULL"),
    ("fetch is allowed against a constraint", "g.fetch = 'allow' AND held = 'no-source'"),
    ("fetch isn''t allowed and no reason is given", "g.fetch <> 'allow' AND held = ''"),
    ("redistribution is allowed with rights unverified", "redistribute = 'allow' AND held = 'terms-unverified'"),
    ("crawlers are refused but fetch is allowed", "ai_crawler = 'disallowed' AND g.fetch = 'allow'"),
    ("another policy version", "policy_version <> '1'"),
    ("unknown constraint new", "held = 'new'"),
)


def _gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(table(spark, sf_dir, "customer"), GATES).withColumn("constraints", F.when(F.col("held") == "", F.array().cast("array<string>")).otherwise(F.array("held")))


@query(f"WITH g AS (SELECT {listed(GATES)} FROM customer) " + " UNION ALL ".join(f"SELECT code, '{said}' AS error FROM g WHERE {bad}" for said, bad in GATE_RULES))
def gate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.gate_errors(_gates(spark, sf_dir), ["no-source", "terms-unverified"], "1")


@query(f"WITH g AS (SELECT {listed(GATES)} FROM customer) SELECT code, transcript_url FROM g WHERE g.fetch = 'allow' AND transcript_url IS NOT NULL")
def fetch_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.fetch_targets(_gates(spark, sf_dir)).select("code", "transcript_url")


@query(f"""WITH g AS (SELECT {listed(GATES)} FROM customer), r AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code FROM orders UNION SELECT 'none')
SELECT code, 'not in the registry' AS error FROM (SELECT code FROM g EXCEPT SELECT code FROM r) UNION ALL SELECT code, 'not in the gates' FROM (SELECT code FROM r EXCEPT SELECT code FROM g)""")
def registry_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("code")).unionByName(spark.createDataFrame([("none",)], "code string"))
    return profile.registry_errors(_gates(spark, sf_dir), known)


BODIES = {
    "code": "CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE lpad(CAST(c_custkey AS STRING), 6, '0') END",
    "name": "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END",
    "ocdId": "CASE WHEN c_custkey % 5 = 0 THEN 'ocd-division/country:jp/city:1' ELSE 'ocd-division/country:jp/prefecture:13/city:' || lpad(CAST(c_custkey AS STRING), 6, '0') END",
    "tokyoCatalogDatasets": "CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_custkey ELSE -1 END",
}


@query(f"""WITH b AS (SELECT c_custkey, {listed(BODIES)} FROM customer) SELECT c_custkey, 'code' AS path FROM b WHERE code = 'x' UNION ALL SELECT c_custkey, 'name' FROM b WHERE name IS NULL
UNION ALL SELECT c_custkey, 'ocdId' FROM b WHERE "ocdId" NOT LIKE '%prefecture%' UNION ALL SELECT c_custkey, 'tokyoCatalogDatasets' FROM b WHERE "tokyoCatalogDatasets" < 0""")
def registry_schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.schema_errors(shown(table(spark, sf_dir, "customer"), {"c_custkey": "c_custkey"} | BODIES), "c_custkey", schema.registry_fields())


STANCES = [("000001", "dnp", "https://a.jp", "allow", "2024-02-30"), ("000002", "other", "nowhere", "allow", "2024-02-29"), ("3", "none", None, "maybe", "2024-01-01"), ("000004", "none", None, "deny", None)]


@query("SELECT * FROM (VALUES ('000001', 'transcript.gate.evaluatedAt'), ('000002', 'transcript.systemFamily'), ('000002', 'transcript.transcriptUrl'), ('3', 'code'), ('3', 'transcript.gate.fetch'), ('000004', 'transcript.gate.evaluatedAt')) AS v(code, path)")
def gate_schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document of four gates, written as JSON and read with the declared schema."""
    from tallywright.model import GATES_DDL

    def body(family: str, url: str | None, fetch: str, day: str | None) -> dict:
        gate = {"fetch": fetch, "redistribute": "deny", "constraints": ["no-source"], "policyVersion": "1", "evaluatedAt": day}
        robots = {"verdict": "none", "aiCrawler": "unchecked", "observation": None}
        return {"transcript": {"systemFamily": family, "transcriptUrl": url, "robots": robots, "gate": gate, "hasCommittee": None, "recordType": None, "confidence": "confirmed"}, "status": {"driver": "not-started", "ingestValidated": False, "published": False}}

    document = {"generatedAt": "2024-01-01", "note": "", "sources": {}, "policy": {"version": "1", "decidedAt": "2024-01-01", "rule": "", "constraints": {}}, "jurisdictions": {c: body(*rest) for c, *rest in STANCES}}
    path = _shared(spark, "gates")
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(path)
    return schema.schema_errors(sources.exploded_map(sources.read_json(spark, path, GATES_DDL), "jurisdictions"), "code", schema.gate_fields())


# --- lineage -------------------------------------------------------------------------------------------------------

MANIFEST = {
    "nodes": {
        "m.stg": {"name": "stg", "resource_type": "model", "path": "staging/stg.sql", "depends_on": {"nodes": ["s.raw"]}},
        "m.core": {"name": "core", "resource_type": "model", "path": "core/core.sql", "depends_on": {"nodes": ["m.stg", "x.rules", "macro.m"]}},
        "m.canon": {"name": "canon", "resource_type": "model", "path": "package/canon.sql", "depends_on": {"nodes": ["m.stg"]}, "config": {"location": "canon.csv"}},
        "m.derived": {"name": "derived", "resource_type": "model", "path": "package/derived.sql", "depends_on": {"nodes": ["m.core"]}},
        "x.rules": {"name": "rules", "resource_type": "seed", "path": "rules.csv", "meta": {"role": "judgment-rule"}},
        "x.public": {"name": "public", "resource_type": "seed", "path": "public.csv", "meta": {"role": "external-reference"}},
        "t.a": {"name": "a", "resource_type": "test", "description": " first ", "depends_on": {"nodes": ["m.stg"]}},
        "t.b": {"name": "b", "resource_type": "test", "depends_on": {"nodes": ["m.stg", "m.core"]}},
        "t.c": {"name": "c", "resource_type": "test"},
        "t.d": {"name": "d", "resource_type": "test", "depends_on": {"nodes": ["m.core"]}},
    },
    "sources": {"s.raw": {"name": "raw", "resource_type": "source"}},
}
RESULTS = [("t.a", "pass", 0, None), ("t.b", "fail", 3, "three"), ("t.d", "warn", 1, "one")]
NODES = [(1, "s.raw", "raw", "source", "ingestion", False, False, None), (2, "m.stg", "stg", "model", "staging", False, False, None), (3, "m.core", "core", "model", "core", True, True, None), (4, "x.public", "public", "seed", "core", False, False, None), (5, "x.rules", "rules", "seed", "core", True, True, None), (6, "m.canon", "canon", "model", "package", False, False, "canon.csv"), (7, "m.derived", "derived", "model", "package", False, True, None)]


@query(f"SELECT * FROM (VALUES {values(NODES)}) AS v(position, id, label, kind, stage, introduces_judgment, contains_judgment, artifact)")
def topology_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _ = lineage.topology(spark, MANIFEST)
    return _in_order(nodes.select("id", "label", "kind", "stage", "introduces_judgment", "contains_judgment", "artifact"))


@query("SELECT * FROM (VALUES (1, 'm.core', 'm.derived'), (2, 'm.stg', 'm.canon'), (3, 'm.stg', 'm.core'), (4, 's.raw', 'm.stg'), (5, 'x.rules', 'm.core')) AS v(position, src, dst)")
def topology_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between known nodes only, in order."""
    _, edges = lineage.topology(spark, MANIFEST)
    return _in_order(edges.select("src", "dst"))


def _bound(spark: SparkSession) -> DataFrame:
    tests = spark.createDataFrame(lineage.tests_of(MANIFEST), lineage.TEST_DDL)
    return lineage.bind_results(tests, spark.createDataFrame(RESULTS, "id string, status string, failures bigint, message string"))


@query("SELECT * FROM (VALUES (1, 'b', '', 'm.stg,m.core', false, 'error', 'fail', 3, 'three'), (2, 'c', '', '', false, 'error', 'not run', NULL, ''), (3, 'd', '', 'm.core', false, 'warn', 'warn', 1, 'one'), (4, 'a', 'first', 'm.stg', true, 'error', 'pass', 0, '')) AS v(position, name, description, binds, ok, severity, status, failures, detail)")
def checks_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_order(_bound(spark).withColumn("binds", F.array_join("binds", ",")))


@query("SELECT 1 AS passed, 2 AS failed, 1 AS warned, 'b,d' AS core_checks, 'a,b' AS staging_checks, 1 AS unbound, 2 AS failed_on_core")
def checks_summarised(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = _bound(spark)
    by = {r["node"]: ",".join(r["checks"]) for r in lineage.checks_by_node(bound).collect()}
    out = lineage.summarise_results(bound)
    return out.select("*", F.lit(by["m.core"]).alias("core_checks"), F.lit(by["m.stg"]).alias("staging_checks"), F.lit(lineage.unbound(bound).count()).alias("unbound"), F.lit(lineage.of_node(bound, "m.core", failed_only=True).count()).alias("failed_on_core"))


# --- files ---------------------------------------------------------------------------------------------------------


@query("SELECT CAST(n_nationkey AS VARCHAR) AS k, '0' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation")
def csv_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns text, named by the header: codes keep their zeros."""
    path = _shared(spark, "text")
    given = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.concat(F.lit("0"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("name"))
    sources.write_csv(given, path, ["k"])
    return sources.read_csv_text(spark, path)


@query(f"SELECT priority, rule_id, applies_to, match_moku, division FROM (VALUES {values(BUDGET_RULES)}) AS v(priority, rule_id, applies_to, match_fund, match_kan, match_kou, match_moku, moku_mode, match_setsu, status, division, consolidation, decided_at_level, counterpart_fund, basis)")
def seed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file with line ends of another system, blank cells, and codes, read with declared types."""
    lines = [",".join(x.split()[0] for x in RULES_DDL.split(", ")), *(",".join("" if x is None else str(x) for x in r) for r in BUDGET_RULES)]
    path = _shared(spark, "seed")
    spark.createDataFrame([("\r\n".join(lines) + "\r\n",)], "value string").coalesce(1).write.option("lineSep", " ").text(path)
    return sources.read_csv(spark, path, RULES_DDL, blank_is_null=True).where("priority IS NOT NULL").select("priority", "rule_id", "applies_to", "match_moku", "division")


@query("SELECT o_custkey, max_by(o_orderkey, o_orderkey) AS o_orderkey, max_by(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def last_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.last_by(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey", "o_orderkey")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, n_regionkey AS region FROM nation")
def json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document with a map by code, read with a declared schema."""
    rows = table(spark, sf_dir, "nation").collect()
    document = {"places": {str(r.n_nationkey): {"name": r.n_name, "region": r.n_regionkey} for r in rows}}
    path = _shared(spark, "json")
    spark.createDataFrame([(json.dumps(document, indent=1),)], "value string").coalesce(1).write.text(path)
    return sources.exploded_map(sources.read_json(spark, path, "places map<string, struct<name:string, region:int>>"), "places")


CSV_TEXT = "01会計,02款\r\n01一般会計,01Ⅰ型\r\n02特別会計, x　\r\n\r\n"


@query("SELECT * FROM (VALUES (2, '01一般会計', '01Ⅰ型', true, '', 'a|b,c', '予算'), (3, '02特別会計', ' x　', true, '', 'a|b,c', '予算')) AS v(source_row, first, second, rebuilt, uneven, header, lenient)")
def parsed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes decoded without loss, cells as they stand, and the text rebuilt from them."""
    p = raw.verified(CSV_TEXT.encode("cp932"), "cp932")
    same, header = raw.rebuild(p) == CSV_TEXT, "|".join(raw.split_header('﻿a, "b,c" '))
    uneven, lenient = ",".join(map(str, raw.uneven_rows(p))), raw.decode_lenient("予算".encode("shift_jis"))
    return spark.createDataFrame([(i, *r, same, uneven, header, lenient) for i, r in enumerate(p.rows, 2)], "source_row int, first string, second string, rebuilt boolean, uneven string, header string, lenient string")


@query("SELECT * FROM (VALUES (3, 1), (4, 3), (6, 1), (7, 1), (8, 1)) AS v(source_row, cells)")
def uneven_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows whose cells aren't as many as the header's."""
    return spark.createDataFrame(raw.uneven_rows(raw.parse("a,b\n1,2\n3\n4,5,6\n7,8\n9\n1\n2\n3\n")), "source_row int, cells int")


@query("SELECT source_row, jurisdiction, year, phase, direction, k, name, true AS first, false AS again, 25 AS rows, CAST(NULL AS BIGINT) AS differs_from FROM (SELECT row_number() OVER (ORDER BY n_nationkey) + 1 AS source_row, '132047' AS jurisdiction, '2024' AS year, 'approved' AS phase, 'expenditure' AS direction, CAST(n_nationkey AS VARCHAR) AS k, n_name AS name FROM nation)")
def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested twice: the same bytes are skipped. The raw copy is read back, with what its provenance says."""
    rows = sorted((r.n_nationkey, r.n_name) for r in table(spark, sf_dir, "nation").collect())
    body = ("k,name\n" + "".join(f"{k},{n}\n" for k, n in rows)).encode()
    root = _local_folder(spark)
    first, again = (raw.ingest(spark, body, "utf-8", root, CITY, 2024, "approved", EXPENDITURE) for _ in range(2))
    record = json.loads((Path(raw.partition_path(root, CITY, 2024, "approved", EXPENDITURE)) / "provenance.json").read_text())
    kind = T.StructType([T.StructField("source_row", T.LongType()), T.StructField("k", T.StringType()), T.StructField("name", T.StringType())])
    back = raw.read_raw(spark, root, kind, direction=EXPENDITURE)
    given = raw.frame(spark, raw.parse(body.decode()))
    differs = raw.first_difference(given, back.select(*given.columns))
    return back.select("*", F.lit(first).alias("first"), F.lit(again).alias("again"), F.lit(record["rows"]).alias("rows"), F.lit(differs).cast("bigint").alias("differs_from"))


def _local_folder(spark: SparkSession) -> str:
    """The shared folder as a path for plain file access; a raw copy's provenance is written beside it."""
    path = _shared(spark, "raw").removeprefix("file:")
    if not path.startswith("/"):
        raise ValueError("the raw copy's folder must be reachable as a path")
    return "/" + path.lstrip("/")


@query("SELECT position, line FROM (SELECT row_number() OVER (ORDER BY n_regionkey DESC, n_name) + 1 AS position, n_regionkey || ',' || n_name AS line FROM nation) UNION ALL SELECT 1, 'n_regionkey,n_name'")
def ordered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file in a fixed order, as its lines."""
    path = _local_folder(spark) + ".csv"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    sources.write_csv_file(table(spark, sf_dir, "nation").select("n_regionkey", "n_name"), path, [F.desc("n_regionkey"), "n_name"])
    return spark.createDataFrame(list(enumerate(Path(path).read_text().splitlines(), 1)), "position int, line string")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS position, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE o_orderstatus END AS status FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) <= 20")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty rows as a column table, and back."""
    head = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 2 == 1, F.col("o_orderstatus")).alias("status")).orderBy("o_orderkey").limit(20)
    rows = aggregate.to_rows(aggregate.as_column_table(head))
    return spark.createDataFrame([(i, r["o_orderkey"], r["status"]) for i, r in enumerate(rows, 1)], "position int, o_orderkey string, status string")


REGISTRY = """
[catalog.c]
endpoint = "https://c/search"
org_prefix = "t"
["132047:2024"]
catalog = "c"
jurisdiction_code = "132047"
jurisdiction_name = "三鷹市"
fiscal_year = 2024
fiscal_year_label = "令和６年度"
phase_id = "approved"
phase_label = "当初予算"
dataset_title = "予算"
encoding = "cp932"
redistribute = "review"
redistribute_basis = "x"
license_id = "CC-BY-4.0"
attribution = "a"
landing_page = "https://l"
[["132047:2024".resources]]
direction = "expenditure"
resource_name = "令和６年度（歳出）"
[["132047:2024".resources]]
direction = "revenue"
resource_name = "令和６年度（歳入）"
"""
PACKAGES = [("t132047", "予算", [("令和６年度（歳入）", "u1"), ("令和６年度（歳出）", "u2"), ("令和６年度（歳出）", "u3")]), ("t132047", "決算", [("令和６年度（歳出）", "u4")])]


@query("SELECT * FROM (VALUES ('132047:2024', 't132047', 'expenditure', false, 'u2', 2), ('132047:2024', 't132047', 'revenue', false, 'u1', 1)) AS v(key, organization, direction, may_publish, url, n)")
def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of sources, and the catalogue's entry for each resource: the first of its name."""
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        (Path(folder) / "sources.toml").write_text(REGISTRY)
        found = catalog.load_sources(f"{folder}/sources.toml")
    packages = spark.createDataFrame(PACKAGES, "organization string, title string, resources array<struct<name:string,url:string>>")
    out = []
    for s in found.values():
        for r in s.resources:
            where = (packages, s.organization, s.dataset_title, r.resource_name)
            out.append((s.key, s.organization, r.direction, catalog.may_publish(s), catalog.resource_url(*where), catalog.resolve_resource(*where).count()))
    return spark.createDataFrame(out, "key string, organization string, direction string, may_publish boolean, url string, n int")


MARKDOWN = "# T\n##### `value`\n\n- _dataType_: number\n\n##### `a:level{1..2}:code`\n\nText\n- _dataType_: `string`\n- _unique_: true\n\n##### `a:level{1..2}:label`\n- _dataType_: string\n- _labelOf_: `a:level1:code`\n##### `none`\nnothing"


@query("SELECT * FROM (VALUES ('value', 'number', false, NULL, NULL), ('a:level1:code', 'string', true, NULL, NULL), ('a:level2:code', 'string', true, NULL, NULL), ('a:level1:label', 'string', false, 'a:level1:code', NULL), ('a:level2:label', 'string', false, 'a:level2:code', NULL)) AS v(name, \"dataType\", \"unique\", \"labelOf\", prior)")
def taxonomy_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.column_types(spark.createDataFrame([(MARKDOWN,)], "value string")).withColumn("prior", F.col("prior").cast("string"))


@query("SELECT '2024-05-01T00:00:00+00:00' AS created")
def newest_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a package says it was created: the newest source's time of fetching."""
    given = spark.createDataFrame([("2024-05-01T00:00:00+00:00",), ("2024-04-30T23:59:59+00:00",), (None,)], "fetched_at string")
    return spark.createDataFrame([(raw.latest_fetch(given),)], "created string")


@query(f"WITH {STAGED} SELECT jurisdiction_code, fiscal_year, direction, count(*) AS n FROM staged WHERE fiscal_year = 1996 GROUP BY ALL")
def pruned_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw copy of all years below one folder, staged for one year."""
    path = _shared(spark, "years")
    spent(spark, sf_dir).repartition("year").write.partitionBy("jurisdiction", "year", "phase", "direction").parquet(path)
    one = raw.read_raw(spark, path, LAYOUT.raw_schema(EXPENDITURE), jurisdiction=CITY, year=1996)
    return staging.stage(one, EXPENDITURE, LAYOUT).groupBy("jurisdiction_code", "fiscal_year", "direction").agg(F.count(F.lit(1)).alias("n"))




FIELDS = [
    ("budget_line_id", "string", "budget-line-id", None),
    ("fiscal_year", "integer", "date:fiscal-year", None),
    ("phase_id", "string", "phase:id", None),
    ("source_row", "integer", "tallywright:source:row", None),
    *((f"{x}_{p}", "string", f"{kind}:{p}", None if p == "code" else f"{kind}:code") for x, kind in (
        ("fund", "tallywright:fund"),
        ("kan", "functional-classification:generic:level1"),
        ("kou", "functional-classification:generic:level2"),
        ("moku", "functional-classification:generic:level3"),
        ("jikou", "activity:generic:program"),
        ("setsu", "economic-classification:generic:level1"),
        ("saisaisetsu", "economic-classification:generic:level2"),
    ) for p in ("code", "label")),
    ("value", "integer", "value", None),
    ("source_amount", "integer", "tallywright:source:amount", None),
]


@query(f"WITH f(name, type, column_type, label_of) AS (VALUES {values(FIELDS)}) SELECT 'tabular-data-package' AS profile, 'p' AS package, '2024-05-01' AS created, f.*, (SELECT count(*) FROM orders) AS rows FROM f")
def package_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A package written down, and what its descriptor says of each column; the descriptor's digest is the file's."""
    import hashlib

    from tallywright.plans import package

    folder = Path(_local_folder(spark))
    table_ = staging.canonical(staged(spark, sf_dir), EXPENDITURE)
    package.write_package(str(folder), "p", {EXPENDITURE: (table_, "x", ["budget_line_id"], ["source_row"])}, "2024-05-01")
    told = json.loads((folder / "datapackage.json").read_text())
    one, body = told["resources"][0], (folder / "expenditure.csv").read_bytes()
    rows = body.count(b"\n") - 1 if one["hash"] == "sha256:" + hashlib.sha256(body).hexdigest() and one["bytes"] == len(body) else -1
    out = [(told["profile"], told["name"], told["created"], f["name"], f["type"], f.get("columnType"), f.get("labelOf"), rows) for f in one["schema"]["fields"]]
    return spark.createDataFrame(out, "profile string, package string, created string, name string, type string, column_type string, label_of string, rows bigint")


@query("SELECT n_name AS name, count(*) AS n FROM nation GROUP BY 1")
def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of a catalogue that gives seven at a time; of those with one name the last."""
    found = [{"name": r.n_name, "title": "t", "organization": {"name": "o"}, "resources": []} for r in table(spark, sf_dir, "nation").collect()]
    found += found[:3]
    got = list(catalog.all_results(lambda start: {"count": len(found), "results": found[start : start + 7]}))
    return catalog.packages_of(spark, got).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
