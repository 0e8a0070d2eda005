from __future__ import annotations

import json

import budget
import pytest
from pyspark.sql import functions as F

from tallywright.model import EXPENDITURE, PARTITIONS, REVENUE
from tallywright.operators import aggregate, compare, consolidate, lineage, rules
from tallywright.operators.staging import canonical, stage
from tallywright.plans import checks, package
from tallywright.plans.pipeline import Engine, run
from tallywright.sources import raw as raw_source
from tallywright.sources import tables


@pytest.fixture(scope="module")
def world(spark):
    raw = {d: budget.raw(spark, d) for d in (EXPENDITURE, REVENUE)}
    staged = {d: stage(raw[d], d, budget.LAYOUT).persist() for d in raw}
    core = {EXPENDITURE: rules.classify(staged[EXPENDITURE], budget.rules(spark)).persist(), REVENUE: consolidate.judge_revenue(staged[REVENUE]).persist()}
    return raw, staged, core


def test_staging_splits_and_identifies(world):
    _, staged, _ = world
    row = staged[EXPENDITURE].where("fiscal_year = 2024 AND source_row = 2").first()
    assert (row.fund_code, row.fund_label, row.kan_label, row.source_amount) == ("01", "一般会計", "議会費", 300)
    assert row.budget_line_id.startswith("132047:2024:expenditure:approved:") and len(row.budget_line_id.split(":")[-1]) == 16
    assert staged[EXPENDITURE].select("budget_line_id").distinct().count() == 22


def test_all_rows_at_fault_are_counted(spark):
    assert [r.failures for r in checks.run([checks.Check("many", spark.range(2500))])] == [2500]


def test_trim_documented_and_as_typed(spark):
    df = spark.createDataFrame([("\t 01x\n　", "tnr郵便料nt")], "a string, b string")
    from tallywright.functions.text import trim_cell

    r = df.select(trim_cell(F.col("a")).alias("a"), trim_cell(F.col("b")).alias("b"), trim_cell(F.col("b"), as_typed=True).alias("c")).first()
    assert tuple(r) == ("01x", "tnr郵便料nt", "郵便料")


def naive(line: dict, table: list[tuple]) -> str | None:
    for r in sorted(table):
        _, rule_id, city, fund, kan, kou, moku, mode, setsu, *_ = r
        ok = (not city or city == line["jurisdiction_code"]) and (not fund or fund == line["fund_label"]) and (not kan or kan == line["kan_label"])
        ok = ok and (not kou or line["kou_label"] in kou.split("|")) and (not setsu or setsu == line["setsu_label"])
        if ok and moku:
            ok = moku in line["moku_label"] if mode == "contains" else line["moku_label"] in moku.split("|")
        if ok:
            return rule_id
    return None


def test_rules_equal_naive_first_match(spark, world):
    _, staged, core = world
    want = {r.budget_line_id: naive(r.asDict(), budget.RULES) for r in staged[EXPENDITURE].collect()}
    for plan in (rules.classify_join, rules.classify_compiled):
        got = {r.budget_line_id: r.cofog_rule_id for r in plan(staged[EXPENDITURE], budget.rules(spark)).collect()}
        assert got == want
    odd = core[EXPENDITURE].where("cofog_rule_id IS NULL").first()
    assert (odd.cofog_status, odd.cofog_division, odd.cofog_consolidation, odd.cofog_decided_at_level) == ("unclassifiable", "", "retained", "（規則なし）")


def test_compiled_rules_need_no_shuffle(spark, world):
    plan = rules.classify_compiled(budget.raw(spark, EXPENDITURE).transform(lambda r: stage(r, EXPENDITURE, budget.LAYOUT)), budget.rules(spark))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_random_rules_agree(spark):
    import random

    rng = random.Random(3)
    words = ["a", "b", "ab", "a_", "%", "", None]
    lines = [(str(i), *(rng.choice(["a", "b", "ab", "ba", "axb"]) for _ in range(6))) for i in range(60)]
    names = ["jurisdiction_code", "fund_label", "kan_label", "kou_label", "moku_label", "setsu_label"]
    df = spark.createDataFrame(lines, "budget_line_id string, " + ", ".join(f"{n} string" for n in names)).selectExpr("*", "2024 fiscal_year", "'expenditure' direction", "1L source_row")
    table = [(i, f"r{i}", *(rng.choice(words) for _ in range(3)), rng.choice([None, "a|b", "ab"]), rng.choice([None, "a", "b|ab", "a_"]), rng.choice(["eq", "contains", None]), rng.choice([None, "a"]), "assigned", "01", "retained", "x", None, "y") for i in range(25)]
    t = spark.createDataFrame(table, budget.RULES_DDL)
    a = {tuple(r) for r in rules.classify_join(df, t).collect()}
    assert a == {tuple(r) for r in rules.classify_compiled(df, t).collect()}


def test_all_checks_pass(spark, world):
    raw, staged, core = world
    found = [c for d in raw for c in checks.of_staging(raw[d], staged[d], d, budget.LAYOUT)]
    found += checks.of_rules(budget.rules(spark)) + checks.of_core(staged[EXPENDITURE], staged[REVENUE], core[EXPENDITURE], core[REVENUE])
    results = checks.run(found)
    assert [r.name for r in results if r.status != "pass"] == []
    assert checks.summary(results)["pass"] == len(found)


def _fails(df) -> bool:
    return df.limit(1).count() > 0


def test_mutations_trip_checks(spark, world):
    raw, staged, core = world
    d, spent = EXPENDITURE, staged[EXPENDITURE]
    one = spent.where("NOT (fiscal_year = 2024 AND source_row = 3)")
    assert _fails(checks.canonical_preserves_source(raw[d], one, d, budget.LAYOUT)) and _fails(checks.staging_is_one_to_one(raw[d], one)) and _fails(checks.core_covers_staging(one, core[d]))
    swapped = one.unionByName(spent.where("fiscal_year = 2024 AND source_row = 2"))
    assert _fails(checks.canonical_preserves_source(raw[d], swapped, d, budget.LAYOUT)) and _fails(checks.composite_key_is_unique(swapped, d))
    renamed = budget.raw(spark, d, change=lambda rows: [[*r[:2], "01議会経費", *r[3:]] if r[0] == 2 and r[9] == CITY_ and r[10] == "2024" else r for r in rows] + [list(r) for r in rows if r[0] == 2 and r[10] == "2024"])
    assert _fails(checks.code_determines_label(stage(renamed, d, budget.LAYOUT), d))
    bare = budget.raw(spark, d, change=lambda rows: [[r[0], "一般会計", *r[2:]] for r in rows[:1]])
    assert _fails(checks.code_label_reconstructs_source(stage(bare, d, budget.LAYOUT), d, budget.LAYOUT))
    lost = spent.withColumn("moku_label", F.lit(None).cast("string"))
    assert _fails(checks.code_label_reconstructs_source(lost, d, budget.LAYOUT))
    for change in ({"cofog_division": F.lit("11")}, {"cofog_status": F.lit("out-of-scope")}, {"cofog_consolidation": F.lit("eliminated"), "cofog_counterpart_fund": F.lit(None).cast("string")}):
        assert _fails(checks.judgment_invariants(core[d].withColumns(change), spent))
    paid, got = consolidate.paid_by_pair(core[d], spent), consolidate.received_by_pair(core[REVENUE], staged[REVENUE])
    assert _fails(checks.consolidation_pairs_balance(paid.withColumn("paid", F.col("paid") + 1), got))
    assert _fails(checks.consolidation_pairs_balance(paid.where("false"), got.where("false")))
    assert _fails(checks.funds_balance(spent.withColumn("source_amount", F.col("source_amount") + 1), staged[REVENUE]))
    derived = core[d].select("budget_line_id", "cofog_status", "cofog_division", "cofog_consolidation")
    assert not _fails(checks.derived_covers_core(derived, core[d])) and _fails(checks.derived_covers_core(derived.limit(3), core[d])) and _fails(checks.derived_covers_core(derived.where("false"), core[d].where("false")))
    only = raw[d].select("jurisdiction", "direction")
    assert _fails(checks.inputs_are_not_empty(spark, [(budget.CITY, EXPENDITURE), (budget.CITY, REVENUE)], only))
    blank = budget.raw(spark, d, change=lambda rows: [[r[0], "　" + r[1], *r[2:]] for r in rows])
    assert _fails(checks.surrounding_whitespace(blank, d, budget.LAYOUT))
    assert _fails(checks.amount_normalization(canonical(spent, d).withColumn("value", F.col("value") + 1)))


CITY_ = budget.CITY


def test_published_totals(spark, world):
    _, staged, _ = world
    keys = "jurisdiction_code string, fiscal_year int, direction string, kan_label string, amount_thousand_yen bigint"
    sums = {}
    for r in budget.SPENT:
        if r[0] == budget.GENERAL:
            sums[r[1][2:]] = sums.get(r[1][2:], 0) + r[-1]
    published = spark.createDataFrame([(budget.CITY, 2024, EXPENDITURE, k, v) for k, v in sums.items()] + [(budget.CITY, 2024, REVENUE, "市税", 820)], keys)
    meta = spark.createDataFrame([(budget.CITY, 2024, budget.GENERAL, "approved", 820)], "jurisdiction_code string, fiscal_year int, fund string, phase string, total_thousand_yen bigint")
    assert not _fails(checks.published_adds_up(published, meta)) and not _fails(checks.published_matches(published, meta, staged))
    wrong = published.withColumn("amount_thousand_yen", F.col("amount_thousand_yen") + F.when(F.col("kan_label") == "議会費", 1).otherwise(0))
    assert _fails(checks.published_adds_up(wrong, meta)) and _fails(checks.published_matches(wrong, meta, staged))


def test_report(spark, world):
    _, staged, core = world
    spent, judged = staged[EXPENDITURE], core[EXPENDITURE]
    states = {(r.status, r.division): (r["count"], r["sum"]) for r in aggregate.by_state(judged, spent).collect()}
    assert states[("assigned", "01")] == (2, 600_000) and states[("unclassifiable", "")] == (4, 180_000)
    head = aggregate.headline(judged, spent).first()
    assert head.total == 2 * 1020 * 1000 and head.eliminated == 400_000
    pairs = consolidate.pairs(consolidate.paid_by_pair(judged, spent), consolidate.received_by_pair(core[REVENUE], staged[REVENUE])).collect()
    assert len(pairs) == 4 and all(p.ok for p in pairs)
    levels = {r.level: (r.distinct_codes, r.distinct_paths, r.reused) for r in aggregate.level_profile(spent, [("fund_code", "fund_source"), ("kan_code", "kan_source")]).collect()}
    assert levels["fund_code"] == (3, 3, False) and levels["kan_code"] == (7, 9, True)
    lines = aggregate.detail(canonical(spent, EXPENDITURE), judged, budget.rules(spark), EXPENDITURE)
    assert len(set(lines.columns)) == len(lines.columns) and lines.count() == 22
    top = aggregate.drilldown(lines.withColumnRenamed("cofog_division_code", "cofog_division"), ["fund_label", "kan_label"], ["一般会計"]).collect()
    assert [r.name for r in top[:2]] == ["議会費", "民生費"] and top[1].sum == 400_000 and top[1].by_division == {"07": 240_000, "10": 160_000}
    found = aggregate.drilldown(lines.withColumnRenamed("cofog_division_code", "cofog_division"), ["fund_label", "kan_label"], [], "議会").collect()
    assert [(r.name, r["count"]) for r in found] == [("一般会計", 2)]


def test_pipeline_end_to_end(spark, tmp_path):
    root = str(tmp_path / "raw")
    for d in (EXPENDITURE, REVENUE):
        budget.raw(spark, d).write.partitionBy(*PARTITIONS).mode("append").parquet(f"{root}/{d}_part")
    for d in (EXPENDITURE, REVENUE):
        budget.raw(spark, d).repartition(1).write.partitionBy(*PARTITIONS).mode("append").parquet(root + "_all")
    results = run(spark, root + "_all", budget.rules(spark), budget.CITY, str(tmp_path / "out"), "2024-01-01")
    assert all(r.status == "pass" for r in results)
    told = json.loads((tmp_path / "out/packages/132047/datapackage.json").read_text())
    assert {r["name"] for r in told["resources"]} == {EXPENDITURE, REVENUE}
    staged = stage(budget.raw(spark, EXPENDITURE), EXPENDITURE, budget.LAYOUT)
    back = tables.read_csv_text(spark, str(tmp_path / "out/packages/132047/expenditure.csv"))
    assert not _fails(checks.package_preserves_source(back, staged, EXPENDITURE, budget.CITY))
    changed = back.withColumn("kan_label", F.concat("kan_label", F.lit("x")))
    assert _fails(checks.package_preserves_source(changed, staged, EXPENDITURE, budget.CITY))
    report = json.loads((tmp_path / "out/report/pipeline.json").read_text())
    assert report["byState"] and report["levels_expenditure"]
    engine = Engine(spark, root + "_all", budget.rules(spark), budget.CITY).build()
    assert engine.sql("SELECT count(*) n FROM staging_expenditure").first().n == 22
    assert engine.row_counts().where("node = 'core_revenue'").first().rows == 6
    plan = raw_source.read_raw(spark, root + "_all", budget.LAYOUT.raw_schema(EXPENDITURE), direction=EXPENDITURE)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(direction" in plan
    table = canonical(staged, EXPENDITURE)
    with pytest.raises(ValueError, match="no meaning"):
        package.schema_of(staged, ["budget_line_id"])
    with pytest.raises(ValueError, match="neither a type"):
        package.schema_of(table, ["budget_line_id"], ["value"])
    with pytest.raises(ValueError, match="key's columns"):
        package.schema_of(table, ["other"])
    standard = {t for f in package.declared().values() if (t := f.get("columnType")) and not t.startswith("tallywright:")}
    fields = {f["name"]: f for f in package.schema_of(table, ["budget_line_id"], standard)["fields"]}
    assert fields["fund_code"]["columnType"] == "tallywright:fund:code" and fields["kan_label"] == {"name": "kan_label", "type": "string", "title": "款名", "columnType": "functional-classification:generic:level1:label", "labelOf": "functional-classification:generic:level1:code"}
    assert fields["source_row"]["type"] == "integer" and told["profile"] == "tabular-data-package" and {r["profile"] for r in told["resources"]} == {"tabular-data-resource"}
    detail = spark.read.json(str(tmp_path / "out/report/detail-expenditure")).collect()
    assert len(detail) == 22 and json.loads((tmp_path / "out/report/preview/core_revenue.json").read_text())["rows"]
    broken = tmp_path / "out/packages/derived/cofog.csv"
    broken.write_text("\n".join(broken.read_text().splitlines()[:-2]) + "\n")
    assert [r.name for r in checks.run(engine.package_checks(str(tmp_path / "out/packages"))) if r.status == "fail"] == ["derived_covers_core"]
    engine.materialise(str(tmp_path / "tables"))
    assert engine.core[EXPENDITURE].count() == 22 and "tables/core_expenditure" in engine.core[EXPENDITURE].inputFiles()[0]


def test_set_differences_take_null_for_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (None, "x"), (2, "y")], "k int, v string")
    assert compare.set_diff(a, a, ["k", "v"]).count() == 0
    b = spark.createDataFrame([(1, None), (3, None)], "k int, v string")
    assert sorted(map(str, map(tuple, compare.set_diff(a, b, ["k", "v"]).collect()))) == sorted(map(str, [(None, "x", "a"), (2, "y", "a"), (3, None, "b")]))


def test_large_rule_tables_meet_kinds_by_hash(spark, world):
    """Beyond the compiled plan's limit: the same rows, and no line meets every rule."""
    _, staged, _ = world
    rare = [(100 + i, f"rare{i}", None, None, f"kan{i}", None, None, None, None, "assigned", "01", "retained", "款", None, "x") for i in range(600)]
    table = spark.createDataFrame(budget.RULES + rare, budget.RULES_DDL)
    got = rules.classify(staged[EXPENDITURE], table)
    want = {r.budget_line_id: naive(r.asDict(), budget.RULES + rare) for r in staged[EXPENDITURE].collect()}
    assert {r.budget_line_id: r.cofog_rule_id for r in got.collect()} == want
    twice = staged[EXPENDITURE].unionByName(staged[EXPENDITURE])
    assert rules.classify_join(twice, table).count() == 2 * staged[EXPENDITURE].count()
    nulls = staged[EXPENDITURE].withColumn("moku_label", F.lit(None).cast("string"))
    a, b = (sorted(map(str, map(tuple, f(nulls, budget.rules(spark)).collect()))) for f in (rules.classify_join, rules.classify_compiled))
    assert a == b


def test_lineage(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("x", "y")], "src string, dst string")
    nodes = spark.createDataFrame([(n, n == "a") for n in "abcxy"], "id string, introduces_judgment boolean")
    assert {r.id for r in lineage.contains_judgment(nodes, edges).where("contains_judgment").collect()} == {"a", "b", "c"}
    assert lineage.known_edges(edges, nodes.where("id <> 'y'")).count() == 3
    checks_ = spark.createDataFrame([("t1", ["a", "b"]), ("t2", []), ("t3", ["a"])], "name string, binds array<string>")
    assert {r.node: r.checks for r in lineage.checks_by_node(checks_).collect()} == {"a": ["t1", "t3"], "b": ["t1"]} and lineage.unbound(checks_).count() == 1
    assert lineage.stage_of("models/core/x.sql", {"models/": "m", "models/core": "core"}) == "core"
    with pytest.raises(ValueError):
        lineage.stage_of("other", {"models": "m"})
    for entry in ({"name": "x", "resource_type": "seed"}, {"name": "x", "resource_type": "model", "path": "elsewhere/x.sql"}):
        with pytest.raises(ValueError):
            lineage.topology(spark, {"nodes": {"n": entry}})


def test_check_results(spark):
    tests_ = spark.createDataFrame([("1", "b", " x ", ["n"]), ("2", "a", None, ["n", "m"]), ("3", "c", "", None)], "id string, name string, description string, binds array<string>")
    results = spark.createDataFrame([("1", "pass", 0, None), ("2", "warn", 3, "three")], "id string, status string, failures int, message string")
    bound = lineage.bind_results(tests_, results)
    assert [(r.name, r.ok, r.severity, r.status) for r in bound.collect()] == [("a", False, "warn", "warn"), ("c", False, "error", "not run"), ("b", True, "error", "pass")]
    assert tuple(lineage.summarise_results(bound).first()) == (1, 1, 1)
    assert [r.name for r in lineage.of_node(bound, "n", failed_only=True).collect()] == ["a"]


def test_command_line(spark, tmp_path, capsys):
    from tallywright.__main__ import main

    root = str(tmp_path / "raw")
    for d in (EXPENDITURE, REVENUE):
        budget.raw(spark, d).repartition(1).write.partitionBy(*PARTITIONS).mode("append").parquet(root)
    with open(tmp_path / "rules.csv", "w") as f:
        f.write(",".join(c.split()[0] for c in budget.RULES_DDL.split(", ")) + "\r\n")
        f.writelines(",".join("" if v is None else str(v) for v in r) + "\r\n" for r in budget.RULES)
    assert main(["checks", "--raw", root, "--rules", str(tmp_path / "rules.csv"), "--jurisdiction", budget.CITY]) == 0
    assert "pass  consolidation_pairs_balance" in capsys.readouterr().out
