"""Column types out of the Markdown text of a specification.

A definition is a fifth-level heading with the name in backticks, then list items ``- _key_: value``. A name may hold a range
of levels ({1..8}); it stands for one type per level, and what it refers to is moved to the same level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.operators.profile import expand_ranges


def _item(section: Column, key: str) -> Column:
    found = F.trim(F.regexp_extract(section, rf"(?m)^-\s+_{key}_:\s*`?([^`\n]+)`?\s*$", 1))
    return F.nullif(found, F.lit(""))


def _same_level(reference: Column, level: Column) -> Column:
    moved = F.regexp_replace(reference, F.lit(r":level(?:[0-9]+|\{[0-9]+\.\.[0-9]+\}):"), F.concat(F.lit(":level"), level, F.lit(":")))
    return F.when(level == "", reference).otherwise(moved)


def column_types(markdown: DataFrame, text: str = "value") -> DataFrame:
    """name, dataType, unique, labelOf, prior, in the order of the text; headings without a data type are no definitions."""
    sections = markdown.select(F.posexplode(F.split(F.concat(F.lit("\n"), F.col(text)), r"\n#####\s+")).alias("at", "s")).where("at > 0")
    own = sections.select("at", F.regexp_extract("s", r"^`([^`]+)`", 1).alias("name"), F.regexp_extract("s", r"(?s)^(.*?)(?:\n#|\z)", 1).alias("body"))
    found = own.select("at", "name", _item(F.col("body"), "dataType").alias("dataType"), (F.lower(_item(F.col("body"), "unique")) == "true").alias("unique"), _item(F.col("body"), "labelOf").alias("labelOf"), _item(F.col("body"), "prior").alias("prior"))
    each = expand_ranges(found.where("name <> '' AND dataType IS NOT NULL"), "name")
    level = F.regexp_extract("name", r":level([0-9]+):", 1)
    out = each.select("at", "name", "dataType", F.coalesce("unique", F.lit(False)).alias("unique"), _same_level(F.col("labelOf"), level).alias("labelOf"), _same_level(F.col("prior"), level).alias("prior"), level.cast("string").alias("__level"))
    return out.orderBy("at", F.expr("try_cast(__level AS int)")).drop("at", "__level")
