"""Profiles of published files: how fine they are, whether they keep to a column standard, whether years agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.text import any_within, column_name, is_html, is_whole_number, origin_of
from tallywright.operators.compare import set_diff

# The words that decide how fine a budget file is.
STATUTORY = ("款", "項", "目", "節")
ACTIVITY_COLUMNS = {"132047": ("事項",), "132195": ("大事業", "中事業", "小事業")}
ACTIVITY_HINTS = ("事業", "事項", "施策")
NOT_ACTIVITY = ("事業者", "事業所", "事業年度")
CATEGORY_AXES = ("目的別", "性質別")
INDICATORS = ("比率", "指標", "財政力", "経常収支", "将来負担")
AMOUNTS = ("予算額", "決算額", "金額", "予算計", "予算現額", "執行累計", "支出済額")
RELEVANT_TITLE_WORDS = ("予算", "決算", "歳出", "財政")
RANKS = {"project": 4, "account-item": 3, "category": 2, "indicator": 1}

# The columns of a bulletin list, in order, and their other spellings.
BULLETIN_COLUMNS = (
    "全国地方公共団体コード",
    "ID",
    "地方公共団体名",
    "名称",
    "号数",
    "発行年月",
    "発行元",
    "町字ID",
    "発行元所在地_都道府県",
    "発行元所在地_市区町村",
    "発行元所在地_町字",
    "発行元所在地_番地以下",
    "発行元所在地_建物名等(方書)",
    "発行元連絡先（電話番号）",
    "発行元連絡先（メールアドレス）",
    "URL",
)
BULLETIN_ALIASES = {
    "発行元所在地_建物名等_方書_": "発行元所在地_建物名等(方書)",
    "発行元連絡先_電話番号_": "発行元連絡先（電話番号）",
    "発行元連絡先_メールアドレス_": "発行元連絡先（メールアドレス）",
    "発行元所在地_建物名等（方書）": "発行元所在地_建物名等(方書)",
    "発行元連絡先(電話番号)": "発行元連絡先（電話番号）",
    "発行元連絡先(メールアドレス)": "発行元連絡先（メールアドレス）",
}
IGNORED_COLUMNS = ("_id", "")
BULLETIN_FIELDS = {"code": "全国地方公共団体コード", "body": "地方公共団体名", "title": "名称", "number": "号数", "issued": "発行年月", "publisher": "発行元", "url": "URL"}


def _texts(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def granularity(df: DataFrame, header: str = "header", code: str = "code") -> DataFrame:
    """Adds granularity, basis and hits. Declared activity columns of a jurisdiction count where there are any, else hint words."""
    out = df.withColumn("__cols", F.transform(header, column_name)).withColumn("__all", F.array_join("__cols", "|"))
    declared = F.lit(None).cast("array<string>")
    for k, names in ACTIVITY_COLUMNS.items():
        declared = F.when(F.col(code) == k, _texts(names)).otherwise(declared)
    out = out.withColumn("__declared", declared)
    hinted = F.filter("__cols", lambda c: any_within(c, ACTIVITY_HINTS) & ~any_within(c, NOT_ACTIVITY))
    named = F.filter("__cols", lambda c: F.array_contains(F.col("__declared"), c))
    out = out.withColumn("__activity", F.when(F.col("__declared").isNotNull(), named).otherwise(hinted))
    out = out.withColumn("__levels", F.filter(_texts(STATUTORY), lambda x: F.array_contains(F.col("__cols"), x)))
    amount, item = any_within(F.col("__all"), AMOUNTS), F.array_contains("__levels", "目")
    found = F.filter(_texts(INDICATORS), lambda x: F.contains(F.col("__all"), x))
    case = [
        ("project", (F.size("__activity") > 0) & item & amount, F.concat("__activity", "__levels")),
        ("account-item", item & amount, F.col("__levels")),
        ("category", ((F.size("__levels") > 0) | any_within(F.col("__all"), CATEGORY_AXES)) & amount, F.col("__levels")),
        ("indicator", F.size(found) > 0, found),
    ]
    name, hits = F.lit("unchecked"), _texts(())
    for label, holds, what in reversed(case):
        name, hits = F.when(holds, label).otherwise(name), F.when(holds, what).otherwise(hits.cast("array<string>"))
    out = out.withColumn("granularity", name).withColumn("basis", F.when(F.col("__declared").isNotNull(), "declared").otherwise("inferred")).withColumn("hits", hits)
    return out.drop("__cols", "__all", "__declared", "__activity", "__levels")


def rank_of(granularity_: Column) -> Column:
    return reduce(lambda a, kv: F.when(granularity_ == kv[0], kv[1]).otherwise(a), RANKS.items(), F.lit(0))


def best_files(profiles: DataFrame) -> DataFrame:
    """Of each jurisdiction (code) the finest checked file that isn't revenue; on a tie the first by ``position``."""
    from tallywright.operators.aggregate import best_per_group

    kept = profiles.where("direction <> 'revenue' AND granularity <> 'unchecked'")
    return best_per_group(kept.withColumn("__rank", rank_of(F.col("granularity"))), "code", "__rank", "position").drop("__rank")


def candidates(datasets: DataFrame, registry: DataFrame) -> DataFrame:
    """datasets (organization, title, format, ...): CSV files of registered bodies with a relevant title; adds ``code``."""
    return coded_candidates(datasets, r"^t([0-9]{6})\z", "CSV", RELEVANT_TITLE_WORDS).join(registry.select("code"), "code", "left_semi")


def coded_candidates(datasets: DataFrame, pattern: str, kind: str, words) -> DataFrame:
    """Datasets whose organization holds a code, of one format, with one of the words in the title."""
    coded = datasets.withColumn("code", F.regexp_extract("organization", pattern, 1)).where("code <> ''")
    return coded.where((F.upper("format") == kind) & any_within(F.col("title"), words))


def bulletin_column(name: Column) -> Column:
    bare = F.trim(F.regexp_replace(name, "^﻿", ""))
    pairs = [x for k, v in BULLETIN_ALIASES.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), bare), bare)


def conformance(df: DataFrame, header: str = "header", wanted=BULLETIN_COLUMNS, rename=bulletin_column, ignored=IGNORED_COLUMNS) -> DataFrame:
    """Adds conformance (broken: columns are missing; variant: others are there, or the order differs), missing, extra, columns."""
    standard = _texts(wanted)
    out = df.withColumn("__cols", F.filter(F.transform(header, rename), lambda c: ~c.isin(*ignored)))
    out = out.withColumn("missing", F.array_except(standard, "__cols"))
    out = out.withColumn("extra", F.filter("__cols", lambda c: ~F.array_contains(standard, c)))
    out = out.withColumn("__known", F.filter("__cols", lambda c: F.array_contains(standard, c)))
    in_order = F.col("__known") == F.slice(standard, F.lit(1), F.size("__known"))
    out = out.withColumn("conformance", F.when(F.size("missing") > 0, "broken").when((F.size("extra") == 0) & in_order, "conformant").otherwise("variant"))
    return out.withColumn("columns", F.size("__cols")).drop("__cols", "__known")


def bulletin_rows(df: DataFrame, header: str = "header", cells: str = "cells") -> DataFrame:
    """The seven fields of each row (blank or absent: null) and ``problems``, empty for a valid row."""
    out = df.withColumn("__cols", F.transform(header, bulletin_column))
    for name, column in BULLETIN_FIELDS.items():
        at = F.array_position("__cols", F.lit(column)).cast("int")
        out = out.withColumn(name, F.when(at > 0, F.nullif(F.trim(F.try_element_at(cells, at)), F.lit(""))))
    rules = [("code", ~F.coalesce(F.col("code").rlike(r"^[0-9]{6}\z"), F.lit(False))), ("url", F.col("url").isNotNull() & ~F.col("url").rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:\S+\z"))]
    return out.withColumn("problems", F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules)))).drop("__cols")


def file_conformance(rows: DataFrame, key: str = "file") -> DataFrame:
    """file, rows, invalid, conformance: one invalid row breaks a file."""
    bad = F.count_if(F.size("problems") > 0)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), bad.alias("invalid")).withColumn("conformance", F.when(F.col("invalid") > 0, "broken").otherwise("conformant"))


#: Rows at fault that a verdict shows.
SHOWN = 3


def file_verdicts(files: DataFrame, rows: DataFrame) -> DataFrame:
    """files (file, header, content: the bytes, null if they couldn't be fetched) and ``bulletin_rows`` with ``row``, to one verdict a
    file: conformance, rows, columns, missing, extra, the first three rows at fault as ``row_failures``, and ``note``."""
    judged = conformance(files.select("file", "header", "content").withColumn("header", F.coalesce("header", F.array().cast("array<string>"))))
    per = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("problems") > 0).alias("invalid"))
    # A rank per file, cut to the first few before the shuffle; never all failures of a file in one array.
    rank = F.row_number().over(Window.partitionBy("file").orderBy("row"))
    few = rows.where(F.size("problems") > 0).withColumn("__n", rank).where(F.col("__n") <= SHOWN)
    first = few.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("row", F.array_join("problems", "/").alias("problems")))).alias("first"))
    both = judged.join(per, "file", "left").join(first, "file", "left")
    reasons = [
        ("can't be fetched", F.col("content").isNull()),
        ("HTML, not CSV", is_html(F.col("content"))),
        ("rows at fault", F.coalesce(F.col("invalid") > 0, F.lit(False))),
    ]
    note = F.when(F.col("conformance") == "conformant", F.lit(None).cast("string")).otherwise(F.concat(F.lit("missing "), F.array_join("missing", "/"), F.lit("; extra "), F.array_join("extra", "/")))
    worst = F.col("conformance")
    for text, holds in reversed(reasons):
        note, worst = F.when(holds, text).otherwise(note), F.when(holds, "broken").otherwise(worst)
    readable = F.col("content").isNotNull() & ~is_html(F.col("content"))
    return both.select(
        "file",
        worst.alias("conformance"),
        F.when(readable, F.coalesce("rows", F.lit(0))).alias("rows"),
        F.when(readable, F.col("columns")).alias("columns"),
        F.when(readable, F.col("missing")).alias("missing"),
        F.when(readable, F.col("extra")).alias("extra"),
        F.transform("first", lambda x: F.concat(x["row"].cast("string"), F.lit(": "), x["problems"])).alias("row_failures"),
        note.alias("note"),
    )


def year_compatibility(rows: DataFrame, header: list[str]) -> DataFrame:
    """rows (year, direction, header, fund, amount, raw_line): by year and direction whether the header is as expected, all
    amounts are whole numbers, how many lines are quoted, which funds there are, and the total."""
    whole = is_whole_number(F.col("amount"))
    return rows.groupBy("year", "direction").agg(
        F.bool_and(F.col("header") == _texts(header)).alias("same_header"),
        F.bool_and(F.coalesce(whole, F.lit(False))).alias("whole_amounts"),
        F.count_if(F.instr("raw_line", '"') > 0).alias("quoted_rows"),
        F.array_sort(F.collect_set("fund")).alias("funds"),
        F.sum(F.when(whole, F.col("amount").cast("bigint"))).alias("total"),
        F.count(F.lit(1)).alias("rows"),
    )


def year_verdicts(found: DataFrame, expected: list[tuple[int, str]]) -> DataFrame:
    """``year_compatibility`` against the years and directions that there should be: compatible (null where there is no file), basis."""
    wanted = found.sparkSession.createDataFrame(expected, "year int, direction string")
    both = wanted.join(found, ["year", "direction"], "left")
    reasons = F.array_compact(
        F.array(
            F.when(~F.col("same_header"), "other columns than expected"),
            F.when(~F.col("whole_amounts"), "amounts that aren't whole numbers"),
            F.when(F.col("quoted_rows") > 0, F.concat(F.col("quoted_rows").cast("string"), F.lit(" rows with quoted cells"))),
        )
    )
    fine = F.concat(F.lit("columns as expected, whole amounts, no quotes, "), F.size("funds").cast("string"), F.lit(" funds"))
    basis = F.when(F.col("rows").isNull(), "no file").when(F.size(reasons) == 0, fine).otherwise(F.array_join(reasons, "; "))
    return both.withColumn("compatible", F.when(F.col("rows").isNotNull(), F.size(reasons) == 0)).withColumn("basis", basis)


BLOCKING = ("rep-path-disallowed", "rep-render-still-disallowed", "publisher-ai-opt-out", "technical-block", "no-source")
UNVERIFIED = ("copyright-unverified", "terms-unverified")


def gate_errors(gates: DataFrame, known_constraints: list[str], policy_version: str) -> DataFrame:
    """gates (code, name, ocd_id, system_family, transcript_url, tenant, tenant_id, ai_crawler, fetch, redistribute, constraints,
    policy_version) to code, error; one row per broken rule."""
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    allowed, held = F.col("fetch") == "allow", F.coalesce("constraints", F.array().cast("array<string>"))
    rules = [
        ("the identifier doesn't end in the code", has("ocd_id") & ~F.endswith(F.col("ocd_id"), F.concat(F.lit("city:"), F.col("code")))),
        ("no system but an address", (F.col("system_family") == "none") & has("transcript_url")),
        ("fetch is allowed without an address", allowed & ~has("transcript_url")),
        ("the hosted system needs a tenant", (F.col("system_family") == "dnp") & ~has("tenant")),
        ("fetch is allowed without a tenant id", (F.col("system_family") == "dnp") & allowed & F.col("tenant_id").isNull()),
        ("fetch is allowed against a constraint", allowed & F.arrays_overlap(held, _texts(BLOCKING))),
        ("fetch isn't allowed and no reason is given", ~allowed & (F.size(held) == 0)),
        ("redistribution is allowed with rights unverified", (F.col("redistribute") == "allow") & F.arrays_overlap(held, _texts(UNVERIFIED))),
        ("crawlers are refused but fetch is allowed", (F.col("ai_crawler") == "disallowed") & allowed),
        ("another policy version", ~F.col("policy_version").eqNullSafe(F.lit(policy_version))),
    ]
    found = [F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for text, bad in rules]
    unknown = F.transform(F.array_except(held, _texts(known_constraints)), lambda c: F.concat(F.lit("unknown constraint "), c))
    return gates.select("code", F.explode(F.concat(F.array_compact(F.array(*found)), unknown)).alias("error"))


def registry_errors(gates: DataFrame, registry: DataFrame) -> DataFrame:
    """Codes that only one of the two has."""
    return set_diff(gates, registry, ["code"]).select("code", F.when(F.col("side") == "a", "not in the registry").otherwise("not in the gates").alias("error"))


def fetch_targets(gates: DataFrame) -> DataFrame:
    return gates.where("fetch = 'allow' AND transcript_url IS NOT NULL")


def by_origin(gates: DataFrame, url: str = "transcript_url") -> DataFrame:
    """origin, codes: one robots request serves all bodies of an origin."""
    return gates.where(F.col(url).isNotNull()).groupBy(origin_of(F.col(url)).alias("origin")).agg(F.array_sort(F.collect_set("code")).alias("codes"))


def robots(answers: DataFrame) -> DataFrame:
    """answers (origin, status, content_type, content) with ``found`` and ``rules``: the text of a good answer that isn't HTML. A page
    sent in place of the file means that there is none."""
    html = is_html(F.col("content")) | F.coalesce(F.contains("content_type", F.lit("text/html")), F.lit(False))
    found = F.coalesce(F.col("status").between(200, 299) & ~html, F.lit(False))
    return answers.withColumn("found", found).withColumn("rules", F.when(found, F.decode("content", "UTF-8")))


def expand_ranges(df: DataFrame, column: str) -> DataFrame:
    """Each row of a template with one {a..b} becomes a row per number; others stay."""
    low, high = (F.regexp_extract(column, r"\{([0-9]+)\.\.([0-9]+)\}", i) for i in (1, 2))
    numbers = F.when(low != "", F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array(F.lit(None).cast("int")))
    each = df.withColumn("__n", F.explode(numbers))
    filled = F.when(F.col("__n").isNull(), F.col(column)).otherwise(F.regexp_replace(F.col(column), F.lit(r"\{[0-9]+\.\.[0-9]+\}"), F.col("__n").cast("string")))
    return each.withColumn(column, filled).drop("__n")
