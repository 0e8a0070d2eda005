"""Places for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()
#: Tables written by this process, in order.
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset (tests, local mode) one of our own. On a cluster that is an error,
    as executors would write to disks of their own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        app = spark.sparkContext.applicationId
        found = _LOCAL.setdefault(app, "file://" + tempfile.mkdtemp(prefix="tallywright-"))
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tallywright/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallywright-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    spark.sparkContext.addPyFile(str(archive))


def small_batches(spark: SparkSession, rows: int = 1000, megabytes: int = 32) -> None:
    """Bound what a Python worker holds at once, in rows and in bytes (a longer text is a batch by itself). Plans read these settings
    when they run, after this returns, so they stay set; lower ones of the caller's are kept."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", megabytes << 20)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


@contextmanager
def swept(spark: SparkSession) -> Iterator[Callable[[DataFrame], None]]:
    """Within it, a call with a table deletes all that ``materialise`` has written since the beginning, but that table."""
    first = len(_MADE)

    def sweep(kept: DataFrame) -> None:
        held = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in kept.inputFiles()}
        for path in _MADE[first:]:
            if path.rsplit("/", 1)[-1] not in held:
                _delete(spark, path)
                _MADE.remove(path)

    yield sweep


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by ``materialise``."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tallywright/" in folder:
            _delete(df.sparkSession, folder)
