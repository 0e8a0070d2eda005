"""The graph of tables: what contains a judgment, which check stands for what."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The stages, in order, and whether they add judgments.
STAGES = {"ingestion": False, "staging": False, "core": True, "package": False}
ROLES = {"judgment-rule": True, "external-reference": False}


def known_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (src, dst) between nodes (id) that exist."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def reachable(edges: DataFrame, start: DataFrame, key: str = "id") -> DataFrame:
    """All nodes that ``start`` leads to, itself included. Only new nodes are followed, so cycles end and any depth is reached;
    each round's lineage is cut where ``spark.checkpoint.dir`` names a folder, else (tests, local mode) its rows are kept in memory."""
    seen = _cut(start.select(F.col(key).alias("id")).distinct())
    frontier = seen
    while True:
        found = _cut(frontier.join(edges, F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct().join(seen, "id", "left_anti"))
        if found.isEmpty():
            return seen
        # A plain union of earlier rounds would double the plan with each round.
        seen, frontier = _cut(seen.unionByName(found)), found


def _cut(df: DataFrame) -> DataFrame:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            return df.persist()
        context.setCheckpointDir(folder)
    return df.checkpoint()


def contains_judgment(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (id, introduces_judgment) with ``contains_judgment``: it introduces one or is made from a table that contains one."""
    marked = reachable(edges, nodes.where("introduces_judgment")).withColumn("__in", F.lit(True))
    return nodes.join(marked, "id", "left").withColumn("contains_judgment", F.coalesce("__in", F.lit(False))).drop("__in")


def checks_by_node(checks: DataFrame) -> DataFrame:
    """checks (name, binds array, ...) to node, checks."""
    return checks.select("name", F.explode("binds").alias("node")).groupBy("node").agg(F.array_sort(F.collect_set("name")).alias("checks"))


def unbound(checks: DataFrame) -> DataFrame:
    return checks.where(F.size("binds") == 0)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """node, rows: all counts in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("node"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def stage_of(path: str, stages: dict[str, str]) -> str:
    """The stage whose path prefix a file lies under; the longest wins, an unknown path is an error."""
    hits = [p for p in stages if path.startswith(p)]
    if not hits:
        raise ValueError(f"no stage is declared for {path}")
    return stages[max(hits, key=len)]


def _entry(key: str, given: dict) -> dict:
    kind, role = given["resource_type"], (given.get("meta") or {}).get("role")
    if kind == "source":
        stage = "ingestion"
    elif kind == "seed":
        stage = "core"
        if role not in ROLES:
            raise ValueError(f"seed {given['name']} doesn't declare its role")
    else:
        stage = stage_of(given.get("path") or "", {f"{s}/": s for s in STAGES})
    judges = ROLES[role] if kind == "seed" else STAGES[stage]
    return {"id": key, "label": given["name"], "kind": kind, "stage": stage, "description": (given.get("description") or "").strip(), "introduces_judgment": judges, "artifact": (given.get("config") or {}).get("location")}


NODE_DDL = "id string, label string, kind string, stage string, description string, introduces_judgment boolean, artifact string"


def topology(spark: SparkSession, manifest: dict) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``contains_judgment``, edges src, dst) of a manifest's models, sources and seeds, in a fixed order: nodes by
    stage and label, edges by their ends. A path outside the stages, or a seed without a role, is an error."""
    given = (manifest.get("nodes") or {}) | (manifest.get("sources") or {})
    kept = {k: v for k, v in given.items() if v["resource_type"] in ("model", "source", "seed")}
    nodes = spark.createDataFrame([tuple(_entry(k, v).values()) for k, v in kept.items()], NODE_DDL)
    pairs = [(src, k) for k, v in kept.items() for src in (v.get("depends_on") or {}).get("nodes") or []]
    edges = known_edges(spark.createDataFrame(pairs, "src string, dst string"), nodes)
    order = F.array_position(F.array(*(F.lit(s) for s in STAGES)), F.col("stage"))
    return contains_judgment(nodes, edges).orderBy(order, "label", "id"), edges.orderBy("src", "dst")


def tests_of(manifest: dict) -> list[tuple[str, str, str, list[str]]]:
    """(id, name, description, binds) of a manifest's tests, for ``bind_results``."""
    tests = ((k, v) for k, v in (manifest.get("nodes") or {}).items() if v["resource_type"] == "test")
    return [(k, v["name"], v.get("description") or "", (v.get("depends_on") or {}).get("nodes") or []) for k, v in tests]


TEST_DDL = "id string, name string, description string, binds array<string>"


def bind_results(tests: DataFrame, results: DataFrame) -> DataFrame:
    """tests (id, name, description, binds) with results (id, status, failures, message): failed ones first. A test without a
    result hasn't run, and so isn't ok."""
    both = tests.join(results, "id", "left")
    ok = F.coalesce(F.col("status") == "pass", F.lit(False))
    return both.select(
        "name",
        F.trim(F.coalesce("description", F.lit(""))).alias("description"),
        F.coalesce("binds", F.array().cast("array<string>")).alias("binds"),
        ok.alias("ok"),
        F.when(F.col("status") == "warn", "warn").otherwise("error").alias("severity"),
        F.coalesce("status", F.lit("not run")).alias("status"),
        "failures",
        F.coalesce("message", F.lit("")).alias("detail"),
    ).orderBy("ok", "name")


def summarise_results(checks: DataFrame) -> DataFrame:
    """passed, failed, warned over ``bind_results``."""
    return checks.agg(
        F.count_if("ok").alias("passed"),
        F.count_if(~F.col("ok") & (F.col("severity") == "error")).alias("failed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
    )


def of_node(checks: DataFrame, node: str, failed_only: bool = False) -> DataFrame:
    """The checks that stand for one node."""
    kept = checks.where(F.array_contains("binds", node))
    return kept.where(~F.col("ok")) if failed_only else kept
