"""The whole run: raw, staging, judgment, checks, packages, report."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.model import DERIVED, EXPENDITURE, LAYOUTS, LEVELS, REVENUE, Layout
from tallywright.operators import aggregate, consolidate, lineage, rules
from tallywright.operators.staging import canonical, stage
from tallywright.plans import checks, package
from tallywright.sources.catalog import Source
from tallywright.sources.raw import latest_fetch, read_provenance, read_raw
from tallywright.sources.tables import read_csv, write_json

TITLES = {EXPENDITURE: "歳出", REVENUE: "歳入"}


@dataclass
class Engine:
    """Tables of one jurisdiction. Staging is kept in memory, as checks, packages and reports all read it."""

    spark: SparkSession
    raw_root: str
    rule_table: DataFrame
    jurisdiction: str
    layout: Layout | None = None
    raw: dict[str, DataFrame] = field(default_factory=dict)
    staged: dict[str, DataFrame] = field(default_factory=dict)
    core: dict[str, DataFrame] = field(default_factory=dict)

    def provenance(self) -> DataFrame:
        """The records beside the raw files."""
        found = [str(p) for p in Path(self.raw_root).glob(f"jurisdiction={self.jurisdiction}/**/provenance.json")]
        if not found:
            raise ValueError(f"no provenance below {self.raw_root}")
        return read_provenance(self.spark, found)

    def materialise(self, folder: str) -> Engine:
        """Staging and core as Parquet tables below ``folder``, read again from there: built once, whatever is asked of them."""
        for kind, tables in (("staging", self.staged), ("core", self.core)):
            for direction, df in tables.items():
                path = f"{folder}/{kind}_{direction}"
                df.write.mode("overwrite").parquet(path)
                tables[direction] = self.spark.read.schema(df.schema).parquet(path)
        return self

    def build(self) -> Engine:
        layout = self.layout or LAYOUTS[self.jurisdiction]
        for direction in (EXPENDITURE, REVENUE):
            self.raw[direction] = read_raw(self.spark, self.raw_root, layout.raw_schema(direction), jurisdiction=self.jurisdiction, direction=direction)
            self.staged[direction] = stage(self.raw[direction], direction, layout).persist()
        self.core = {EXPENDITURE: rules.classify(self.staged[EXPENDITURE], self.rule_table), REVENUE: consolidate.judge_revenue(self.staged[REVENUE])}
        return self

    def checks(self, published: DataFrame | None = None, meta: DataFrame | None = None) -> list[checks.Check]:
        layout = self.layout or LAYOUTS[self.jurisdiction]
        out = [c for d in self.staged for c in checks.of_staging(self.raw[d], self.staged[d], d, layout)]
        out += checks.of_rules(self.rule_table) + checks.of_core(self.staged[EXPENDITURE], self.staged[REVENUE], self.core[EXPENDITURE], self.core[REVENUE])
        raw = self.raw[EXPENDITURE].select("jurisdiction", "direction").unionByName(self.raw[REVENUE].select("jurisdiction", "direction"))
        out.append(checks.Check("inputs_are_not_empty", checks.inputs_are_not_empty(self.spark, [(self.jurisdiction, d) for d in self.staged], raw)))
        for d, df in self.staged.items():
            out.append(checks.Check(f"amount_normalization_{d}", checks.amount_normalization(canonical(df, d))))
        if published is not None and meta is not None:
            out += [checks.Check("published_adds_up", checks.published_adds_up(published, meta)), checks.Check("published_matches", checks.published_matches(published, meta, self.staged))]
        return out

    def derived(self) -> DataFrame:
        """Judgments alone, both directions; facts stay in the canonical tables."""
        return self.core[EXPENDITURE].select(*DERIVED).unionByName(self.core[REVENUE].select(*DERIVED))

    def write_packages(self, folder: str, created: str | None = None, sources: list[Source] | None = None, standard: Iterable[str] | None = None) -> dict[str, dict]:
        """Facts and judgments in packages of their own. ``created`` is the newest source's time of fetching, if not given."""
        created = created or latest_fetch(self.provenance())
        order = ["fiscal_year", "phase_id", "source_row", "budget_line_id"]
        facts = {d: (canonical(df, d), TITLES[d], ["budget_line_id"], order) for d, df in self.staged.items()}
        judged = {
            "cofog": (self.derived(), "COFOG", ["budget_line_id"], ["direction", "fiscal_year", "budget_line_id"]),
            "cofog_rules": (self.rule_table, "COFOG rules", ["rule_id"], ["priority"]),
        }
        about = package.about_sources(sources) if sources else {"constants": {"jurisdictionCode": self.jurisdiction}}
        if sources:
            about["provenance"] = [json.loads(x) for x in self.provenance().orderBy("fiscal_year", "direction").toJSON().toLocalIterator()]
        return {
            self.jurisdiction: package.write_package(f"{folder}/{self.jurisdiction}", self.jurisdiction, facts, created, about, standard),
            "derived": package.write_package(f"{folder}/derived", "derived", judged, created, None, standard),
        }

    def package_checks(self, folder: str) -> list[checks.Check]:
        """The packages as written, read back and held against the tables that they were made of."""
        out = []
        for d, df in self.staged.items():
            back = read_csv(self.spark, f"{folder}/{self.jurisdiction}/{d}.csv", canonical(df, d).schema)
            out.append(checks.Check(f"package_preserves_source_{d}", checks.package_preserves_source(back, df, d, self.jurisdiction)))
        derived = read_csv(self.spark, f"{folder}/derived/cofog.csv", self.derived().schema)
        return [*out, checks.Check("derived_covers_core", checks.derived_covers_core(derived, self.derived()))]

    def report(self) -> dict[str, DataFrame]:
        spent, core = self.staged[EXPENDITURE], self.core[EXPENDITURE]
        paid, got = consolidate.paid_by_pair(core, spent), consolidate.received_by_pair(self.core[REVENUE], self.staged[REVENUE])
        out = {
            "byState": aggregate.by_state(core, spent),
            "byKan": aggregate.by_kan(core, spent, self.rule_table),
            "byLevel": aggregate.by_level(core, spent),
            "notAssigned": aggregate.not_assigned(core, spent, self.rule_table),
            "consolidationPairs": consolidate.pairs(paid, got).orderBy(F.desc("paid"), "from", "to"),
            "headline": aggregate.headline(core, spent),
        }
        for d, df in self.staged.items():
            out[f"levels_{d}"] = aggregate.level_profile(df, [(f"{x}_code", f"{x}_source") for x in LEVELS[d]])
        return out

    def detail(self, direction: str) -> DataFrame:
        return aggregate.detail(canonical(self.staged[direction], direction), self.derived(), self.rule_table, direction)

    def write_report(self, folder: str, preview: int = 20) -> None:
        """pipeline.json (aggregates, some hundred rows), a folder detail-* of JSON lines in order for each direction, and the first rows
        of each table as a column table. Only aggregates and previews pass through the driver."""
        root = Path(folder)
        (root / "preview").mkdir(parents=True, exist_ok=True)
        rows = {name: [json.loads(x) for x in df.toJSON().toLocalIterator()] for name, df in self.report().items()}
        (root / "pipeline.json").write_text(json.dumps(rows, ensure_ascii=False, indent=1))
        for d in self.staged:
            write_json(self.detail(d), f"{folder}/detail-{d}", [F.col("source_row").cast("long")])
        for name, df in self.tables().items():
            order = [c for c in ("fiscal_year", "year", "source_row", "priority") if c in df.columns]
            (root / "preview" / f"{name}.json").write_text(json.dumps(aggregate.as_column_table(df.orderBy(*order).limit(preview)), ensure_ascii=False))

    def tables(self) -> dict[str, DataFrame]:
        """Every table of the run, by name."""
        kinds = (("raw", self.raw), ("staging", self.staged), ("core", self.core))
        return {f"{kind}_{d}": df for kind, tables in kinds for d, df in tables.items()} | {"cofog_rules": self.rule_table}

    def row_counts(self) -> DataFrame:
        return lineage.row_counts(self.tables())

    def sql(self, query: str) -> DataFrame:
        """Ad-hoc SQL over the tables (staging_*, core_*, cofog_rules)."""
        for d in self.staged:
            self.staged[d].createOrReplaceTempView(f"staging_{d}")
            self.core[d].createOrReplaceTempView(f"core_{d}")
        self.rule_table.createOrReplaceTempView("cofog_rules")
        return self.spark.sql(query)


def run(spark: SparkSession, raw_root: str, rule_table: DataFrame, jurisdiction: str, out: str, created: str | None = None, sources: list[Source] | None = None) -> list[checks.Result]:
    """Build and check; packages are written only if no check fails, and the report only if the packages read back as they should."""
    engine = Engine(spark, raw_root, rule_table, jurisdiction).build()
    results = checks.run(engine.checks())
    checks.gate(results)
    engine.write_packages(f"{out}/packages", created, sources)
    written = checks.run(engine.package_checks(f"{out}/packages"))
    checks.gate(written)
    engine.write_report(f"{out}/report")
    return results + written
