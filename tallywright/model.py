"""The data model: levels of both directions, raw column names, schemas, divisions.

A line of a budget has seven levels. Source columns are named as published; what a jurisdiction calls them is
configuration, so a second one needs no code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

EXPENDITURE, REVENUE = "expenditure", "revenue"

# Levels by direction, in order.
LEVELS = {
    EXPENDITURE: ("fund", "kan", "kou", "moku", "jikou", "setsu", "saisaisetsu"),
    REVENUE: ("fund", "kan", "kou", "moku", "setsu", "saisetsu", "saisaisetsu"),
}
# Level names as shown.
LEVEL_NAMES = {"fund": "会計", "kan": "款", "kou": "項", "moku": "目", "jikou": "事項", "setsu": "節", "saisetsu": "細節", "saisaisetsu": "細々節"}
# The ten divisions of the functional classification.
DIVISIONS = {
    "01": "一般公共サービス",
    "02": "防衛",
    "03": "公共の秩序及び安全",
    "04": "経済業務",
    "05": "環境保護",
    "06": "住宅及び地域アメニティ",
    "07": "保健",
    "08": "娯楽、文化及び宗教",
    "09": "教育",
    "10": "社会保護",
}
STATUSES = ("assigned", "unclassifiable", "out-of-scope")
CONSOLIDATIONS = ("retained", "eliminated")
NO_RULE = "（規則なし）"
# The reasons given where no rule is.
NO_RULE_BASIS = "どの規則にも当たらなかった。捨てずに分類不能として残す"
INTERFUND_BASIS = "会計間の繰入。歳出側の繰出金と対になるので、連結時に両側を消去する"
REVENUE_BASIS = "歳入に COFOG の分類の軸は無い。連結の対象でもない"
GENERAL_FUND = "一般会計"
UNIT = 1000


@dataclass(frozen=True)
class Layout:
    """How one jurisdiction publishes: its columns by direction (seven levels, then the amount) and its marker of levels that don't exist."""

    columns: dict[str, tuple[str, ...]]
    absent: tuple[str, ...] = ("0",)
    phase: str = "approved"

    def raw_schema(self, direction: str) -> T.StructType:
        cells = [T.StructField(c, T.StringType()) for c in self.columns[direction]]
        return T.StructType([T.StructField("source_row", T.LongType()), *cells])


# The published column names of jurisdiction 132047.
LAYOUTS = {
    "132047": Layout(
        {
            EXPENDITURE: ("01会計", "02款", "03項", "04目", "05事項", "06節", "07細々節", "08予算額"),
            REVENUE: ("01会計", "02款", "03項", "04目", "05節", "06細節", "07細々節", "08予算額"),
        }
    )
}

PARTITIONS = ("jurisdiction", "year", "phase", "direction")
RULES_DDL = "priority int, rule_id string, applies_to string, match_fund string, match_kan string, match_kou string, match_moku string, moku_mode string, match_setsu string, status string, division string, consolidation string, decided_at_level string, counterpart_fund string, basis string"
PUBLISHED_DDL = "jurisdiction_code string, fiscal_year int, direction string, kan_label string, amount_thousand_yen bigint"
PUBLISHED_META_DDL = "jurisdiction_code string, fiscal_year int, fund string, phase string, unit string, total_thousand_yen bigint, title string, publisher string, document_url string, sha256 string, bytes bigint, retrieved_at string, expenditure_location string, revenue_location string"
PROVENANCE_DDL = "jurisdiction_code string, fiscal_year int, direction string, dataset_title string, resource_name string, fiscal_year_basis string, request_url string, status int, bytes bigint, sha256 string, fetched_at string, encoding string, header array<string>, rows bigint, roundtrip_verified boolean, license_id string, attribution string"
# Schemas of the JSON documents that the engine reads; fields that no operator uses are left out.
MANIFEST_NODE = "struct<name:string, resource_type:string, path:string, description:string, config:struct<location:string>, depends_on:struct<nodes:array<string>>, meta:struct<role:string>>"
MANIFEST_DDL = f"nodes map<string, {MANIFEST_NODE}>, sources map<string, {MANIFEST_NODE}>"
RESULTS_DDL = "results array<struct<unique_id:string, status:string, failures:bigint, message:string>>"
REGISTRY_DDL = "note string, generatedAt string, jurisdictions map<string, struct<name:string, ocdId:string, tokyoCatalogDatasets:bigint>>"
GATES_DDL = (
    "generatedAt string, note string, sources map<string, string>, policy struct<version:string, decidedAt:string, rule:string, constraints:map<string, string>>, "
    "jurisdictions map<string, struct<transcript:struct<systemFamily:string, transcriptUrl:string, robots:struct<verdict:string, aiCrawler:string, "
    "observation:struct<requestUrl:string, status:int, sha256:string, fetchedAt:string>, host:string>, gate:struct<fetch:string, redistribute:string, constraints:array<string>, "
    "policyVersion:string, evaluatedAt:string, note:string>, hasCommittee:boolean, recordType:string, confidence:string, verifiedAt:string, evidenceUrls:array<string>, notes:string, "
    "tenant:string, tenantId:int, entryUrl:string, host:string>, status:struct<driver:string, ingestValidated:boolean, published:boolean>, "
    "memberRoster:struct<title:string, formats:array<string>, url:string, license:string, count:bigint>>>"
)
BULLETINS_DDL = (
    "note string, datasets map<string, struct<title:string, formats:array<string>, url:string, license:string, count:bigint, "
    "schemaCheck:struct<standard:string, conformance:string, columns:bigint, extraColumns:array<string>, checkedAt:string, note:string>>>"
)
DERIVED = ("jurisdiction_code", "fiscal_year", "direction", "budget_line_id", "cofog_status", "cofog_division", "cofog_consolidation", "cofog_decided_at_level", "cofog_rule_id", "cofog_counterpart_fund")


def canonical_columns(direction: str) -> list[str]:
    levels = [f"{level}_{part}" for level in LEVELS[direction] for part in ("code", "label")]
    return ["budget_line_id", "fiscal_year", "phase_id", "source_row", *levels, "value", "source_amount"]
