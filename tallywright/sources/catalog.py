"""The registry of sources (TOML) and the resolver of catalogue entries (JSON). Where something must be got over the
network, a function is passed in (``http`` has one)."""

from __future__ import annotations

import tomllib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of a catalogue asked for at once.
PAGE = 300


@dataclass(frozen=True)
class Catalog:
    """Where datasets are searched, and what an organization's name has before its code."""

    endpoint: str
    org_prefix: str


@dataclass(frozen=True)
class Resource:
    direction: str
    resource_name: str


@dataclass(frozen=True)
class Source:
    key: str
    catalog: Catalog
    jurisdiction_code: str
    jurisdiction_name: str
    fiscal_year: int
    fiscal_year_label: str
    phase_id: str
    phase_label: str
    dataset_title: str
    encoding: str
    redistribute: str
    redistribute_basis: str
    license_id: str
    attribution: str
    landing_page: str
    resources: tuple[Resource, ...]

    @property
    def organization(self) -> str:
        return self.catalog.org_prefix + self.jurisdiction_code


def load_sources(path: str) -> dict[str, Source]:
    """Tables [catalog.<name>], and one table a source, named ``code:year``, with its resources as an array of tables."""
    spec = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    catalogs = {name: Catalog(**c) for name, c in spec.pop("catalog", {}).items()}
    known = {f.name for f in fields(Source)} - {"key"}
    found = {}
    for key, entry in spec.items():
        if strange := sorted(entry.keys() ^ known):
            raise ValueError(f"{key}: missing or unknown entries: {', '.join(strange)}")
        if entry["catalog"] not in catalogs:
            raise KeyError(f"{key}: catalog {entry['catalog']} isn't defined")
        if not entry["resources"]:
            raise ValueError(f"{key}: no resource")
        found[key] = Source(key, **entry | {"catalog": catalogs[entry["catalog"]], "resources": tuple(Resource(**r) for r in entry["resources"])})
    if not found:
        raise ValueError(f"{path} defines no source")
    return found


def resolve(sources: dict[str, Source], key: str) -> Source:
    if key not in sources:
        raise KeyError(f"unknown source {key}; known are {', '.join(sorted(sources))}")
    return sources[key]


def may_publish(source: Source) -> bool:
    """Only a decision that says so; one still under review, like one against it, does not."""
    return source.redistribute == "allow"


def check_publishable(source: Source, resource: Resource) -> None:
    """An error unless the source may be given on and the resource's name states the year, which nothing else in the file does."""
    if not may_publish(source):
        raise PermissionError(f"{source.key}: redistribution is {source.redistribute!r}, not allowed")
    if source.fiscal_year_label not in resource.resource_name:
        raise ValueError(f"{source.key}: {resource.resource_name!r} doesn't name the year {source.fiscal_year_label!r}")


def all_results(fetch: Callable[[int], dict]) -> Iterator[dict]:
    """The entries of all pages; ``fetch`` gets the first entry's position and gives ``count`` and ``results``. A catalogue that
    stops before its count is an error, as what is missing would look like what isn't there."""
    start = 0
    while True:
        page = fetch(start)
        yield from page["results"]
        start += len(page["results"])
        if start >= page["count"]:
            return
        if not page["results"]:
            raise ValueError(f"the catalogue gave {start} of {page['count']} entries")


PACKAGES_DDL = "organization string, name string, title string, resources array<struct<name:string,url:string,format:string>>"


def packages_of(spark: SparkSession, found: list[dict]) -> DataFrame:
    """A catalogue's answer as packages; of entries with one name the last."""
    last = {p.get("name"): p for p in found}
    rows = [((p.get("organization") or {}).get("name"), p.get("name"), p.get("title"), [(r.get("name"), r.get("url"), r.get("format")) for r in p.get("resources") or []]) for p in last.values()]
    return spark.createDataFrame(rows, PACKAGES_DDL)


def resolve_resource(packages: DataFrame, organization: str, title: str, name: str) -> DataFrame:
    """packages (organization, title, resources array of struct(name, url)): the resources of that name, in catalogue order."""
    own = packages.where((F.col("organization") == organization) & (F.col("title") == title))
    return own.select(F.posexplode("resources").alias("position", "r")).where(F.col("r.name") == name).select("position", "r.*").orderBy("position")


def resource_url(packages: DataFrame, organization: str, title: str, name: str) -> str:
    """The address of the first of them; an error that says what there is instead if there is none."""
    own = packages.where((F.col("organization") == organization) & (F.col("title") == title))
    if own.isEmpty():
        raise LookupError(f"{organization} has no dataset {title!r}")
    first = resolve_resource(packages, organization, title, name).first()
    if first is None:
        there = [r[0] for r in own.select(F.explode("resources.name")).limit(20).collect()]
        raise LookupError(f"{title!r} has no resource {name!r} but {there}")
    return first["url"]
