"""Schema validation: what each field of a document must be, as predicates; the result is the fields at fault."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.sources.tables import exploded_map

# The words that each field of a gate may hold.
SYSTEM_FAMILIES = ("dnp", "db-search", "voices", "kensakusystem", "own-site", "none")
ROBOTS_VERDICTS = ("allowed", "partial", "disallow-all", "none", "unknown")
CRAWLER_STANCES = ("disallowed", "unspecified", "unchecked")
DECISIONS = ("allow", "deny", "review")
CONSTRAINTS = ("rep-path-disallowed", "rep-render-still-disallowed", "terms-unverified", "copyright-unverified", "publisher-ai-opt-out", "technical-block", "no-source")
RECORD_TYPES = ("full", "summary")
CONFIDENCES = ("confirmed", "probable", "unverified", "failed")
DRIVERS = ("not-started", "in-progress", "implemented")
CONFORMANCES = ("conformant", "variant", "broken", "unchecked")

CODE = r"^[0-9]{6}\z"
DIVISION_ID = r"^ocd-division/country:jp/prefecture:[0-9]{2}/city:[0-9]{6}\z"
URL = r"^[a-zA-Z][a-zA-Z0-9+.-]*:[^\s]+\z"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?Z\z"

Field = tuple[str, Column]


def one_of(path: str, words: Sequence[str], optional: bool = False) -> Field:
    return path, _needed(F.col(path).isin(*words), path, optional)


def like(path: str, pattern: str, optional: bool = False) -> Field:
    return path, _needed(F.col(path).rlike(pattern), path, optional)


def date(path: str, optional: bool = False) -> Field:
    """A day that there is, written as year, month and day."""
    return path, _needed(F.col(path).rlike(DATE) & F.try_to_timestamp(F.col(path), F.lit("yyyy-MM-dd")).isNotNull(), path, optional)


def there(path: str) -> Field:
    return path, F.col(path).isNotNull()


def at_least(path: str, least: int, optional: bool = False) -> Field:
    return path, _needed(F.col(path) >= least, path, optional)


def all_of(path: str, words: Sequence[str]) -> Field:
    return path, F.col(path).isNotNull() & F.forall(path, lambda x: F.coalesce(x.isin(*words), F.lit(False)))


def _needed(holds: Column, path: str, optional: bool) -> Column:
    return F.col(path).isNull() | holds if optional else holds


def schema_errors(df: DataFrame, key: str, fields: Sequence[Field]) -> DataFrame:
    """key, path: one row per field at fault."""
    found = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(path)) for path, ok in fields)))
    return df.select(key, F.explode(found).alias("path"))


def registry_fields() -> list[Field]:
    return [like("code", CODE), there("name"), like("ocdId", DIVISION_ID), at_least("tokyoCatalogDatasets", 0, optional=True)]


def gate_fields() -> list[Field]:
    return [
        like("code", CODE),
        one_of("transcript.systemFamily", SYSTEM_FAMILIES),
        like("transcript.transcriptUrl", URL, optional=True),
        one_of("transcript.robots.verdict", ROBOTS_VERDICTS),
        one_of("transcript.robots.aiCrawler", CRAWLER_STANCES),
        ("transcript.robots.observation", F.col("transcript.robots.observation").isNull() | (F.coalesce(F.col("transcript.robots.observation.requestUrl").rlike(URL), F.lit(False)) & F.coalesce(F.col("transcript.robots.observation.fetchedAt").rlike(TIME), F.lit(False)))),
        one_of("transcript.gate.fetch", DECISIONS),
        one_of("transcript.gate.redistribute", DECISIONS),
        all_of("transcript.gate.constraints", CONSTRAINTS),
        there("transcript.gate.policyVersion"),
        date("transcript.gate.evaluatedAt"),
        one_of("transcript.recordType", RECORD_TYPES, optional=True),
        one_of("transcript.confidence", CONFIDENCES),
        date("transcript.verifiedAt", optional=True),
        ("transcript.evidenceUrls", F.col("transcript.evidenceUrls").isNull() | F.forall("transcript.evidenceUrls", lambda x: F.coalesce(x.rlike(URL), F.lit(False)))),
        like("transcript.entryUrl", URL, optional=True),
        one_of("status.driver", DRIVERS),
        there("status.ingestValidated"),
        there("status.published"),
        ("memberRoster", F.col("memberRoster").isNull() | (F.col("memberRoster.title").isNotNull() & F.col("memberRoster.formats").isNotNull() & F.coalesce(F.col("memberRoster.count") > 0, F.lit(False)))),
    ]


def bulletin_fields() -> list[Field]:
    return [
        like("code", CODE),
        there("title"),
        there("formats"),
        like("url", URL, optional=True),
        at_least("count", 1),
        ("schemaCheck", F.col("schemaCheck").isNull() | F.coalesce(F.col("schemaCheck.conformance").isin(*CONFORMANCES), F.lit(False))),
        ("schemaCheck.checkedAt", F.col("schemaCheck.checkedAt").isNull() | F.col("schemaCheck.checkedAt").rlike(DATE)),
    ]


def gate_rows(document: DataFrame, registry: DataFrame) -> DataFrame:
    """A gates document and the registry's to the flat rows that the consistency rules read."""
    each = exploded_map(document, "jurisdictions")
    names = exploded_map(registry, "jurisdictions").select("code", "name", F.col("ocdId").alias("ocd_id"))
    t = "transcript"
    flat = each.select(
        "code",
        F.col(f"{t}.systemFamily").alias("system_family"),
        F.col(f"{t}.transcriptUrl").alias("transcript_url"),
        F.col(f"{t}.tenant").alias("tenant"),
        F.col(f"{t}.tenantId").alias("tenant_id"),
        F.col(f"{t}.robots.verdict").alias("robots"),
        F.col(f"{t}.robots.aiCrawler").alias("ai_crawler"),
        F.col(f"{t}.gate.fetch").alias("fetch"),
        F.col(f"{t}.gate.redistribute").alias("redistribute"),
        F.col(f"{t}.gate.constraints").alias("constraints"),
        F.col(f"{t}.gate.policyVersion").alias("policy_version"),
    )
    return flat.join(names, "code", "left")
