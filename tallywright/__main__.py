"""python -m tallywright ingest|run|checks|sql|graph|survey|granularity|bulletins|gates|robots ...: the engine from the command line."""

from __future__ import annotations

import argparse

from tallywright.model import EXPENDITURE, LAYOUTS, REVENUE, RULES_DDL
from tallywright.operators import profile
from tallywright.plans import checks, pipeline, surveys
from tallywright.session import build_session
from tallywright.sources import http
from tallywright.sources.catalog import load_sources, packages_of, resolve
from tallywright.sources.raw import ingest_source
from tallywright.sources.tables import read_csv, write_json


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallywright")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, what in (("run", "build, check, and write packages and report"), ("checks", "build and check"), ("sql", "build and run a query")):
        p = commands.add_parser(name, help=what)
        p.add_argument("--raw", required=True)
        p.add_argument("--rules", required=True, help="CSV of the rule table")
        p.add_argument("--jurisdiction", required=True)
        if name == "run":
            p.add_argument("--out", required=True)
            p.add_argument("--created", help="if not the newest source's time of fetching")
            p.add_argument("--sources", help="TOML registry of sources, for the packages' descriptors")
        if name == "sql":
            p.add_argument("query")
    for name, what in (("survey", "whether files of other years can be taken"), ("granularity", "how fine files are"), ("bulletins", "whether files keep to the column standard")):
        p = commands.add_parser(name, help=what)
        p.add_argument("--files", required=True, help="folder of the files")
        if name == "survey":
            p.add_argument("--jurisdiction", required=True)
            p.add_argument("--years", required=True, help="first-last")
    for name, what in (("gates", "whether gates and registry are valid and agree"), ("robots", "what each publisher's robots.txt says")):
        p = commands.add_parser(name, help=what)
        p.add_argument("--gates", required=True)
        p.add_argument("--registry", required=True)
    p = commands.add_parser("graph", help="tables, what they're made from, what contains a judgment, and the checks of a build")
    p.add_argument("--manifest", required=True)
    p.add_argument("--results", required=True)
    p = commands.add_parser("ingest", help="get a source's files, verify them and put them below the raw folder")
    p.add_argument("--sources", required=True, help="TOML registry of sources")
    p.add_argument("--key", required=True, help="code:year")
    p.add_argument("--raw", required=True)
    for p in commands.choices.values():
        p.add_argument("--master")
        p.add_argument("--write", help="folder for the result as JSON lines")
    return parser


def _show(results: dict, folder: str | None) -> None:
    for name, (df, order) in results.items():
        df.show(1000, truncate=False)
        if folder:
            write_json(df, f"{folder}/{name}", order)


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = build_session(a.master)
    if a.command == "ingest":
        source = resolve(load_sources(a.sources), a.key)
        packages = packages_of(spark, http.search(source.catalog, source.dataset_title))
        for direction, new in ingest_source(spark, source, packages, http.body_of, a.raw).items():
            print(f"{direction}: {'written' if new else 'there already'}")
        return 0
    if a.command == "robots":
        _show({"robots": (surveys.robots(spark, a.gates, a.registry, http.get), ["origin"])}, a.write)
        return 0
    if a.command == "survey":
        first, last = (int(x) for x in a.years.split("-"))
        headers = {d: list(LAYOUTS[a.jurisdiction].columns[d]) for d in (EXPENDITURE, REVENUE)}
        _show({"years": (surveys.years(spark, a.files, headers, list(range(first, last + 1))), ["year", "direction"])}, a.write)
        return 0
    if a.command == "granularity":
        found = surveys.granularity(spark, a.files)
        best = profile.best_files(found.withColumn("position", found["file"]))
        _show({"granularity": (found, ["file"]), "best": (best, ["code"])}, a.write)
        return 0
    if a.command == "bulletins":
        _show({"bulletins": (surveys.bulletins(spark, a.files), ["file"])}, a.write)
        return 0
    if a.command == "graph":
        found = surveys.graph(spark, a.manifest, a.results)
        _show({"nodes": (found["nodes"], ["stage", "label"]), "edges": (found["edges"], ["src", "dst"]), "checks": (found["checks"], ["ok", "name"]), "summary": (found["summary"], ["passed"])}, a.write)
        return int(found["summary"].first()["failed"] > 0)
    if a.command == "gates":
        found = surveys.gates(spark, a.gates, a.registry)
        _show({"errors": (found["errors"], ["code", "error"]), "counts": (found["counts"], ["kind", "cell"]), "targets": (found["targets"], ["code"])}, a.write)
        return int(not found["errors"].isEmpty())
    rules = read_csv(spark, a.rules, RULES_DDL, blank_is_null=True)
    if a.command == "run":
        sources = [s for s in load_sources(a.sources).values() if s.jurisdiction_code == a.jurisdiction] if a.sources else None
        results = pipeline.run(spark, a.raw, rules, a.jurisdiction, a.out, a.created, sources)
    else:
        engine = pipeline.Engine(spark, a.raw, rules, a.jurisdiction).build()
        if a.command == "sql":
            engine.sql(a.query).show(100, truncate=False)
            return 0
        results = checks.run(engine.checks())
    for r in results:
        print(f"{r.status:5} {r.name} {r.failures or ''}".rstrip())
    return int(any(r.status == "fail" for r in results))


if __name__ == "__main__":
    raise SystemExit(main())
