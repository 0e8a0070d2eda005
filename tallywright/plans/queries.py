"""The operators over the driver's tables, each with the SQL that says the same.

Money is summed in whole cents, so that no result depends on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import text
from tallywright.model import PARTITIONS
from tallywright.operators import aggregate, compare, consolidate, lineage, profile, rules
from tallywright.sources import raw
from tallywright.sources import tables as sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


CENTS = "CAST(round({} * 100) AS BIGINT)"

# --- codes, labels, identity ---------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, regexp_extract(o_orderpriority, '^([0-9])', 1) AS code, regexp_replace(o_orderpriority, '^[0-9]', '') AS label,
  regexp_extract(o_orderpriority, '^([0-9])', 1) || regexp_replace(o_orderpriority, '^[0-9]', '') = o_orderpriority AS reversible,
  regexp_full_match(regexp_extract(o_orderpriority, '^([0-9])', 1), '[0-9]') AS has_code
FROM orders""")
def split_code_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("o_orderpriority")
    code, label = text.code_of(cell, 1), text.label_of(cell, 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"), label.alias("label"), (F.concat(code, label) == cell).alias("reversible"), text.is_code(code, 1).alias("has_code"))


@query("""
SELECT c_custkey, r_name || ':' || n_name || ':' || substr(sha256(r_name || chr(31) || n_name || chr(31) || c_name || chr(31) || CAST(c_custkey AS VARCHAR)), 1, 16) AS line_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def stable_line_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return lines.select("c_custkey", text.digest_id([F.col("r_name"), F.col("n_name")], [F.col("c_name"), F.col("c_custkey")]).alias("line_id"))


# --- rules ---------------------------------------------------------------------------------------------------------

RULE_COLUMNS = "priority int, rule_id string, match_brand string, match_type string, type_mode string, match_flag string, status string, division string, counterpart string"
RULES = [
    (1, "steel-returned", "", "STEEL", "contains", "R", "assigned", "01", "mill"),
    (2, "brand-1-or-2", "Brand#1|Brand#2", "", "eq", "", "assigned", "02", ""),
    (3, "economy", "", "ECONOMY", "contains", "", "assigned", "03", ""),
    (4, "brand-3-kept", "Brand#3", "", "eq", "N", "out-of-scope", "", "store"),
    (5, "copper-type", "", "STANDARD COPPER|PROMO COPPER", "eq", "", "assigned", "04", ""),
    (6, "returned", "", "", "eq", "R", "out-of-scope", "", ""),
    (7, "promo", "", "PROMO", "contains", "", "unclassifiable", "", ""),
    (8, "brand-4-accepted", "Brand#4", "", "eq", "A", "assigned", "05", ""),
]
BOOK = rules.RuleBook(
    (rules.Condition("p_brand", "match_brand", "list"), rules.Condition("p_type", "match_type", "mode", "type_mode"), rules.Condition("l_returnflag", "match_flag")),
    ("status", "division", "counterpart"),
)
DIVISION_NAMES = {"01": "metal", "02": "house brands", "03": "economy", "04": "copper", "05": "late"}


def _rule_values() -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in r) + ")" for r in RULES)


CLASSIFIED_SQL = f"""
rules(priority, rule_id, match_brand, match_type, type_mode, match_flag, status, division, counterpart) AS (VALUES {_rule_values()}),
lines AS (SELECT l_orderkey, l_linenumber, l_returnflag, {CENTS.format('l_extendedprice')} AS cents, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
kinds AS (SELECT DISTINCT p_brand, p_type, l_returnflag FROM lines),
matched AS (
  SELECT p_brand, p_type, l_returnflag, rules.*, row_number() OVER (PARTITION BY p_brand, p_type, l_returnflag ORDER BY priority) AS rn
  FROM kinds JOIN rules ON (match_brand = '' OR list_contains(str_split(match_brand, '|'), p_brand))
    AND (match_type = '' OR CASE WHEN type_mode = 'contains' THEN p_type LIKE '%' || match_type || '%' ELSE list_contains(str_split(match_type, '|'), p_type) END)
    AND (match_flag = '' OR l_returnflag = match_flag)
),
classified AS (
  SELECT l.l_orderkey, l.l_linenumber, l.cents, coalesce(m.status, 'unclassifiable') AS status, coalesce(m.division, '') AS division, m.rule_id AS rule_id, nullif(coalesce(m.counterpart, ''), '') AS counterpart
  FROM lines l LEFT JOIN (SELECT * FROM matched WHERE rn = 1) m ON l.p_brand = m.p_brand AND l.p_type = m.p_type AND l.l_returnflag = m.l_returnflag
)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", cents("l_extendedprice").alias("cents"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map-only after the join with ``part``: the rules are compiled to one expression."""
    return _outcomes(rules.match_compiled(_lines(spark, sf_dir), spark.createDataFrame(RULES, RULE_COLUMNS), BOOK))


def _outcomes(hit: DataFrame) -> DataFrame:
    return hit.select(
        "l_orderkey",
        "l_linenumber",
        "cents",
        F.coalesce("rule.status", F.lit("unclassifiable")).alias("status"),
        F.coalesce("rule.division", F.lit("")).alias("division"),
        F.col("rule.rule_id").alias("rule_id"),
        F.nullif(F.col("rule.counterpart"), F.lit("")).alias("counterpart"),
    )


@query(f"WITH {CLASSIFIED_SQL} SELECT * FROM classified")
def rule_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir)


@query(f"WITH {CLASSIFIED_SQL} SELECT * FROM classified")
def rule_first_match_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the join plan, for rule tables of any size: rules meet the distinct kinds of lines, not the lines."""
    return _outcomes(rules.with_first(_lines(spark, sf_dir), spark.createDataFrame(RULES, RULE_COLUMNS), BOOK))


@query(f"WITH {CLASSIFIED_SQL} SELECT status, division, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM classified GROUP BY ALL")
def classified_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy("status", "division").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).orderBy(F.desc("cents"), "status", "division")


@query(f"WITH {CLASSIFIED_SQL} SELECT coalesce(rule_id, '(none)') AS level, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM classified GROUP BY 1")
def classified_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy(F.coalesce("rule_id", F.lit("(none)")).alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).orderBy(F.desc("cents"), "level")


@query(f"WITH {CLASSIFIED_SQL} SELECT status, rule_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM classified WHERE status <> 'assigned' GROUP BY 1, 2")
def not_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).where("status <> 'assigned'").groupBy("status", "rule_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).orderBy(F.desc("cents"), F.asc_nulls_last("rule_id"))


@query(
    f"WITH {CLASSIFIED_SQL}, names(code, name) AS (VALUES "
    + ", ".join(f"('{k}', '{v}')" for k, v in DIVISION_NAMES.items())
    + """)
SELECT c.rule_id, any_value(r.counterpart) AS rule_counterpart, coalesce(names.name, '') AS division_name, CAST(sum(cents) AS BIGINT) AS cents
FROM classified c LEFT JOIN rules r ON r.rule_id = c.rule_id LEFT JOIN names ON names.code = c.division GROUP BY 1, 3"""
)
def classified_with_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _classified(spark, sf_dir).groupBy("rule_id", "division").agg(F.sum("cents").alias("cents"))
    reasons = F.broadcast(spark.createDataFrame(RULES, RULE_COLUMNS).select("rule_id", F.col("counterpart").alias("rule_counterpart")))
    return aggregate.with_division_names(sums.join(reasons, "rule_id", "left"), "division", "division_name", DIVISION_NAMES).select("rule_id", "rule_counterpart", "division_name", "cents")


# --- transfers -----------------------------------------------------------------------------------------------------


TRANSFERS = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '繰入金' WHEN '2' THEN '繰入金等' WHEN '3' THEN '市税' ELSE NULL END AS kan_label,
  CASE o_orderstatus WHEN 'O' THEN '特別会計繰入金' WHEN 'F' THEN '基金繰入金' ELSE '他会計繰入金' END AS kou_label,
  'fund' || CAST(o_custkey % 9 AS STRING) || '繰入金' AS moku_label"""
TRANSFERS_LIST = TRANSFERS.split(",\n")


@query(f"""
WITH x AS (SELECT o_orderkey, {TRANSFERS} FROM orders), y AS (SELECT *, coalesce(kan_label LIKE '%繰入金%' AND kou_label NOT LIKE '%基金繰入金%', false) AS flag FROM x)
SELECT o_orderkey, CASE WHEN flag THEN 'eliminated' ELSE 'retained' END AS consolidation, CASE WHEN flag THEN '項' ELSE '（規則なし）' END AS level,
  CASE WHEN flag THEN 'revenue-interfund' END AS rule_id, CASE WHEN NOT flag THEN NULL WHEN kou_label = '特別会計繰入金' THEN regexp_replace(moku_label, '繰入金$', '') ELSE '一般会計' END AS counterpart FROM y""")
def interfund_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").selectExpr("o_orderkey", *TRANSFERS_LIST, "'x' AS jurisdiction_code", "2024 AS fiscal_year", "'revenue' AS direction", "CAST(o_orderkey AS STRING) AS budget_line_id", "o_orderkey AS source_row")
    judged = consolidate.judge_revenue(lines)
    return judged.select(F.col("source_row").alias("o_orderkey"), F.col("cofog_consolidation").alias("consolidation"), F.col("cofog_decided_at_level").alias("level"), F.col("cofog_rule_id").alias("rule_id"), F.col("cofog_counterpart_fund").alias("counterpart"))


PAIRS_SQL = f"""
WITH flows AS (
  SELECT cn.n_name AS buyer, sn.n_name AS seller, {CENTS.format('l_extendedprice')} AS cents, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
), paid AS (SELECT buyer AS "from", seller AS "to", CAST(sum(cents) AS BIGINT) AS paid FROM flows GROUP BY 1, 2),
received AS (SELECT buyer AS "from", seller AS "to", CAST(sum(cents) AS BIGINT) AS received, count(*) AS received_count FROM flows WHERE l_returnflag <> 'R' GROUP BY 1, 2)
SELECT "from", "to", paid, received, received_count, coalesce(paid = received, false) AS ok FROM paid FULL JOIN received USING ("from", "to")"""


@query(PAIRS_SQL)
def consolidation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    buyers = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("buyer"))
    sellers = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("seller"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "buyer")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", cents("l_extendedprice").alias("cents"))
    flows = items.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # One aggregation of the joined flows gives both sides.
    kept = F.col("l_returnflag") != "R"
    both = flows.groupBy(F.col("buyer").alias("from"), F.col("seller").alias("to")).agg(F.sum("cents").alias("paid"), F.sum(F.when(kept, F.col("cents"))).alias("received"), F.nullif(F.count_if(kept), F.lit(0).cast("bigint")).alias("received_count"))
    return consolidate.pairs(both.select("from", "to", "paid"), both.where("received_count IS NOT NULL").select("from", "to", "received", "received_count"), "full_outer")


@query(f"""
WITH a AS (SELECT o_orderstatus AS status, CAST(sum({CENTS.format('o_totalprice')}) AS BIGINT) AS ordered FROM orders GROUP BY 1),
b AS (SELECT l_linestatus AS status, CAST(sum({CENTS.format('l_extendedprice')}) AS BIGINT) AS billed FROM lineitem GROUP BY 1)
SELECT status, ordered, billed FROM a FULL JOIN b USING (status) WHERE coalesce(ordered, -1) IS DISTINCT FROM coalesce(billed, -2)""")
def fund_balance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.sum(cents("o_totalprice")).alias("ordered"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("status")).agg(F.sum(cents("l_extendedprice")).alias("billed"))
    return compare.reconcile(a, b, ["status"], "ordered", "billed")


# --- reconciliation ------------------------------------------------------------------------------------------------


@query("""
WITH a AS (SELECT [CAST(o_orderstatus AS VARCHAR), CAST(o_orderpriority AS VARCHAR), CAST(o_custkey AS VARCHAR)] AS cells FROM orders),
b AS (SELECT [CAST(o_orderstatus AS VARCHAR), CAST(o_orderpriority AS VARCHAR), CAST(o_custkey AS VARCHAR)] AS cells FROM orders WHERE o_totalprice > 20000)
SELECT array_to_string(cells, '|') AS cells, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT cells, count(*) AS n FROM a GROUP BY 1 UNION ALL SELECT cells, -count(*) FROM b GROUP BY 1) GROUP BY 1 HAVING sum(n) <> 0""")
def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_totalprice", F.array("o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string")).alias("cells"))
    return compare.multiset_diff(orders, orders.where("o_totalprice > 20000"), ["cells"]).select(F.array_join("cells", "|").alias("cells"), "n")


@query("""
WITH a AS (SELECT nullif(o_orderkey, 7) AS k, o_orderstatus AS s FROM orders), b AS (SELECT l_orderkey AS k, 'O' AS s FROM lineitem WHERE l_quantity > 10)
SELECT k, s, 'a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT k, s, 'b' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def except_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.nullif(F.col("o_orderkey"), F.lit(7)).alias("k")
    orders = table(spark, sf_dir, "orders").select(k, F.col("o_orderstatus").alias("s"))
    items = table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("k"), F.lit("O").alias("s"))
    return compare.set_diff(orders, items, ["k", "s"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT p_brand, p_size, count(DISTINCT p_type) AS n_values FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_type) > 1")
def fd_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.dependency_violations(table(spark, sf_dir, "part"), ["p_brand", "p_size"], "p_type")


_PLACES = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"""
WITH x AS (SELECT r_name, n_name, c_mktsegment FROM {_PLACES})
SELECT 'r_name' AS level, count(DISTINCT r_name) AS distinct_codes, count(DISTINCT (r_name)) AS distinct_paths, false AS reused FROM x
UNION ALL SELECT 'n_name', count(DISTINCT n_name), count(DISTINCT (r_name, n_name)), count(DISTINCT (r_name, n_name)) > count(DISTINCT n_name) FROM x
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), count(DISTINCT (r_name, n_name, c_mktsegment)), count(DISTINCT (r_name, n_name, c_mktsegment)) > count(DISTINCT c_mktsegment) FROM x""")
def level_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    df = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return aggregate.level_profile(df, [(c, c) for c in ("r_name", "n_name", "c_mktsegment")])


@query(f"""
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_quantity > 25) AS n_large,
  CAST(coalesce(sum({CENTS.format('l_extendedprice')}) FILTER (WHERE l_linestatus = 'O'), 0) AS BIGINT) AS open_cents,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open_orders
FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM region WHERE r_name = 'NOWHERE') GROUP BY 1 HAVING count(*) > (SELECT count(*) FROM nation)""")
def filtered_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("cents", cents("l_extendedprice"))
    per = aggregate.counted(lines, "l_returnflag", {"n_large": F.col("l_quantity") > 25}, {"open_cents": ("cents", F.col("l_linestatus") == "O")})
    for name, df in {"per": per, "orders": table(spark, sf_dir, "orders"), "region": table(spark, sf_dir, "region"), "nation": table(spark, sf_dir, "nation")}.items():
        df.createOrReplaceTempView(f"tw_{name}")
    return spark.sql("""
SELECT *, (SELECT count(*) FROM tw_orders WHERE o_orderstatus = 'O') AS open_orders FROM tw_per
WHERE n > (SELECT count(*) FROM tw_nation) AND NOT EXISTS (SELECT 1 FROM tw_region WHERE r_name = 'NOWHERE')""")


@query("""
SELECT kind, count(*) AS n, count(*) FILTER (WHERE trim(cell) <> cell OR cell LIKE '% %') AS n_blank, count(DISTINCT cell) AS n_distinct
FROM (SELECT unnest(['name', 'type', 'brand']) AS kind, unnest([p_name, p_type, p_brand]) AS cell FROM part) WHERE cell IS NOT NULL GROUP BY 1""")
def explode_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = aggregate.cells(table(spark, sf_dir, "part"), {k: f"p_{k}" for k in ("name", "type", "brand")})
    return flat.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.trim("cell") != F.col("cell")) | F.col("cell").contains(" ")).alias("n_blank"), F.countDistinct("cell").alias("n_distinct"))


@query(f"""
WITH scope AS (SELECT DISTINCT year(o_orderdate) AS y, o_orderstatus AS s FROM orders WHERE o_totalprice > 400000)
SELECT y, s, count(*) AS n, CAST(sum({CENTS.format('o_totalprice')}) AS BIGINT) AS cents FROM orders JOIN scope ON year(o_orderdate) = y AND o_orderstatus = s GROUP BY 1, 2""")
def scope_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("bigint").alias("y"), F.col("o_orderstatus").alias("s"), "o_totalprice")
    return compare.scoped(orders, orders.where("o_totalprice > 400000"), ["y", "s"]).groupBy("y", "s").agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("cents"))


@query("""
WITH expected(status) AS (VALUES ('F'), ('O'), ('P'), ('X')), found AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1)
SELECT status, coalesce(n, 0) AS n FROM expected FULL JOIN found USING (status)""")
def count_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = spark.createDataFrame([(x,) for x in "FOPX"], "status string")
    return compare.covered(expected, table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"), ["status"])


# --- browsing ------------------------------------------------------------------------------------------------------


@query(f"""
WITH x AS (SELECT r_name, n_name, c_mktsegment, o_orderstatus, {CENTS.format('o_totalprice')} AS cents, o_orderpriority
  FROM orders JOIN {_PLACES.replace('customer JOIN', 'customer ON o_custkey = c_custkey JOIN')} WHERE r_name = 'ASIA' AND (lower(r_name) LIKE '%a%' OR lower(n_name) LIKE '%a%' OR lower(c_mktsegment) LIKE '%a%'))
SELECT a.*, b.by_division FROM (SELECT n_name AS name, count(*) AS count, CAST(sum(cents) AS BIGINT) AS sum, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM x GROUP BY 1) a
JOIN (SELECT n_name AS name, string_agg(o_orderpriority || '=' || CAST(c AS VARCHAR), ',' ORDER BY o_orderpriority) AS by_division FROM (SELECT n_name, o_orderpriority, CAST(sum(cents) AS BIGINT) AS c FROM x GROUP BY 1, 2) GROUP BY 1) b USING (name)""")
def drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name", "n_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).withColumn("cents", cents("o_totalprice"))
    out = aggregate.drilldown(orders, ["r_name", "n_name", "c_mktsegment"], ["ASIA"], "A", "cents", "o_orderpriority", "o_orderstatus")
    by = F.transform(F.map_entries("by_division"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("name", "count", "sum", F.array_join("statuses", ",").alias("statuses"), F.array_join(by, ",").alias("by_division"))


@query(f"""
WITH x AS (SELECT l_shipmode, cents FROM (SELECT l_returnflag AS l_shipmode, {CENTS.format('l_extendedprice')} AS cents FROM lineitem))
SELECT l_shipmode AS l_returnflag, CAST(sum(cents) AS BIGINT) AS sum, CAST(sum(cents) AS DOUBLE) / (SELECT CAST(sum(cents) AS DOUBLE) FROM x) AS share FROM x GROUP BY 1""")
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.shares(table(spark, sf_dir, "lineitem").withColumn("cents", cents("l_extendedprice")), "l_returnflag", "cents")


@query(f"""
SELECT o_custkey, o_orderkey, {CENTS.format('o_totalprice')} AS cents FROM orders WHERE o_orderstatus <> 'F'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {CENTS.format('o_totalprice')} DESC, o_orderkey) = 1""")
def best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_custkey", "o_orderkey", cents("o_totalprice").alias("cents"))
    return aggregate.best_per_group(orders, "o_custkey", "cents", "o_orderkey")


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def frequency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.frequencies(table(spark, sf_dir, "events").select(F.col("event_type").alias("value")), "value")


# --- profiles ------------------------------------------------------------------------------------------------------

HEADERS = [
    ("a", "132047", ["01会計", "02款", "03項", "04目", "05事項", "08予算額"]),
    ("b", "132195", ["款", "項", "目", "大事業", "予算額(円)"]),
    ("c", "131016", ["款", "項", "目", "節", "決算額（千円）"]),
    ("d", "131016", ["目的別", "金額"]),
    ("e", "131016", ["年度", "経常収支比率"]),
    ("f", "131016", ["氏名", "住所"]),
    ("g", "131016", ["款", "目", "事業者", "金額"]),
]
WANTED = ["a", "b", "c"]


def _header_values() -> str:
    return ", ".join(f"('{f}', '{c}', [{', '.join(chr(39) + x + chr(39) for x in h)}])" for f, c, h in HEADERS)


@query(f"""
WITH files(file, code, header) AS (VALUES {_header_values()}),
c AS (SELECT file, code, list_transform(header, lambda x: trim(regexp_replace(regexp_replace(x, '^[0-9０-９]+[._\\-\\s]*', ''), '[（(].*?[）)]', '', 'g'))) AS cols FROM files),
d AS (SELECT *, array_to_string(cols, '|') AS whole, CASE code WHEN '132047' THEN ['事項'] WHEN '132195' THEN ['大事業', '中事業', '小事業'] END AS declared FROM c),
e AS (SELECT *, list_filter(['款', '項', '目', '節'], lambda x: list_contains(cols, x)) AS levels,
  CASE WHEN declared IS NOT NULL THEN list_filter(cols, lambda x: list_contains(declared, x)) ELSE list_filter(cols, lambda x: regexp_matches(x, '事業|事項|施策') AND NOT regexp_matches(x, '事業者|事業所|事業年度')) END AS activity,
  regexp_matches(whole, '予算額|決算額|金額|予算計|予算現額|執行累計|支出済額') AS amount FROM d)
SELECT file, CASE WHEN len(activity) > 0 AND list_contains(cols, '目') AND amount THEN 'project' WHEN list_contains(cols, '目') AND amount THEN 'account-item'
  WHEN (len(levels) > 0 OR regexp_matches(whole, '目的別|性質別')) AND amount THEN 'category' WHEN regexp_matches(whole, '比率|指標|財政力|経常収支|将来負担') THEN 'indicator' ELSE 'unchecked' END AS granularity,
  CASE WHEN declared IS NULL THEN 'inferred' ELSE 'declared' END AS basis FROM e""")
def granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.granularity(spark.createDataFrame(HEADERS, "file string, code string, header array<string>")).select("file", "granularity", "basis")


CONFORMANCE = [("a", ["a", "b", "c"]), ("b", ["a", "b"]), ("c", ["b", "a", "c"]), ("d", ["a", "b", "c", "d"]), ("e", ["_id", "a", "b", "c", ""])]


@query(
    "WITH files(file, header) AS (VALUES "
    + ", ".join(f"('{f}', [{', '.join(chr(39) + x + chr(39) for x in h)}])" for f, h in CONFORMANCE)
    + """), c AS (SELECT file, list_filter(header, lambda x: x NOT IN ('_id', '')) AS cols FROM files),
d AS (SELECT *, list_filter(['a', 'b', 'c'], lambda x: NOT list_contains(cols, x)) AS missing, list_filter(cols, lambda x: NOT list_contains(['a', 'b', 'c'], x)) AS extra, list_filter(cols, lambda x: list_contains(['a', 'b', 'c'], x)) AS known FROM c)
SELECT file, CASE WHEN len(missing) > 0 THEN 'broken' WHEN len(extra) = 0 AND known = ['a', 'b', 'c'] THEN 'conformant' ELSE 'variant' END AS conformance, array_to_string(missing, ',') AS missing, array_to_string(extra, ',') AS extra, CAST(len(cols) AS INTEGER) AS columns FROM d"""
)
def header_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.conformance(spark.createDataFrame(CONFORMANCE, "file string, header array<string>"), wanted=WANTED, rename=lambda c: c)
    return out.select("file", "conformance", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "columns")


@query("""
WITH d AS (SELECT page_id, 't' || lpad(CAST(page_id % 50 AS VARCHAR), 6, '0') AS org, CASE page_id % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'CSV' ELSE 'pdf' END AS format,
  CASE page_id % 4 WHEN 0 THEN '令和予算書' WHEN 1 THEN '決算' WHEN 2 THEN '地図' ELSE '財政と歳出' END || CAST(page_id AS VARCHAR) AS title FROM pages)
SELECT page_id, substr(org, 2) AS code FROM d WHERE upper(format) = 'CSV' AND title NOT LIKE '%地図%' AND CAST(substr(org, 2) AS INT) < 30""")
def candidate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    formats = F.when(k % 3 == 0, "csv").when(k % 3 == 1, "CSV").otherwise("pdf")
    titles = F.when(k % 4 == 0, "令和予算書").when(k % 4 == 1, "決算").when(k % 4 == 2, "地図").otherwise("財政と歳出")
    org = F.concat(F.lit("t"), F.lpad((k % 50).cast("string"), 6, "0"))
    datasets = table(spark, sf_dir, "pages").select("page_id", org.alias("organization"), formats.alias("format"), F.concat(titles, k.cast("string")).alias("title"))
    registry = spark.range(30).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("code"))
    return profile.candidates(datasets, registry).select("page_id", "code")


@query("""
SELECT regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin, string_agg(CAST(page_id AS VARCHAR), ',' ORDER BY CAST(page_id AS VARCHAR)) AS codes FROM pages GROUP BY 1""")
def origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("code", F.col("page_id").cast("string"))
    return profile.by_origin(pages, "url").select("origin", F.array_join("codes", ",").alias("codes"))


# --- graph ---------------------------------------------------------------------------------------------------------

EDGES = [("raw", "stg"), ("stg", "core"), ("rules", "core"), ("core", "pkg"), ("stg", "canon"), ("pkg", "report"), ("report", "core"), ("canon", "csv")]


@query(
    "WITH RECURSIVE edges(src, dst) AS (VALUES "
    + ", ".join(f"('{a}', '{b}')" for a, b in EDGES)
    + """), marked(id) AS (SELECT 'rules' UNION SELECT dst FROM marked JOIN edges ON src = id),
nodes AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)
SELECT id, id IN (SELECT id FROM marked) AS contains_judgment FROM nodes"""
)
def judgment_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct().withColumn("introduces_judgment", F.col("id") == "rules")
    return lineage.contains_judgment(nodes, edges).select("id", "contains_judgment")


@query(" UNION ALL ".join(f"SELECT '{t}' AS node, count(*) AS rows FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")))
def batched_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.row_counts({t: table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")})


# --- sources and sinks ---------------------------------------------------------------------------------------------


def _shared(spark: SparkSession, name: str) -> str:
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        root = "file://" + tempfile.mkdtemp(prefix="tallywright-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN '' END AS blank_or_null FROM nation")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV and read back with declared types; '' and null stay apart."""
    given = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, "").alias("blank_or_null"))
    path = _shared(spark, "csv")
    sources.write_csv(given, path, ["n_nationkey"])
    return sources.read_csv(spark, path, given.schema)


@query("SELECT o_orderkey AS source_row, o_orderstatus AS jurisdiction, CAST(year(o_orderdate) AS VARCHAR) AS year, 'approved' AS phase, CASE WHEN o_custkey % 2 = 0 THEN 'expenditure' ELSE 'revenue' END AS direction, o_orderpriority AS cell FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 2 = 0")
def hive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by partition and read back with filters that prune directories."""
    path = _shared(spark, "hive")
    side = F.when(F.col("o_custkey") % 2 == 0, "expenditure").otherwise("revenue")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_row"), F.col("o_orderpriority").alias("cell"), F.col("o_orderstatus").alias("jurisdiction"), F.year("o_orderdate").cast("string").alias("year"), F.lit("approved").alias("phase"), side.alias("direction"))
    orders.repartition(*PARTITIONS).sortWithinPartitions("source_row").write.partitionBy(*PARTITIONS).parquet(path)
    return raw.read_raw(spark, path, orders.select("source_row", "cell").schema, jurisdiction="O", direction="expenditure")
