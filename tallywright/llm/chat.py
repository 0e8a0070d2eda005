"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only that
reply is trainable. A conversation that ends on another role, or has no assistant turn, also gives one
example without a trainable part, so that no turn is lost.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline. In texts and roles a backslash is
doubled and ``<|`` becomes ``<\\|``; in roles a newline gets a backslash before it. So no control string
can arise from content, and removing one backslash from each pair restores it.

Defined cases: a null text or role is empty; rows are ordered by turn (null first), then role, then
text, so ties and repeated rows keep all their rows in one fixed order; a row whose conversation id is null is a
conversation of its own, told apart by ``part`` (0 for all others), so such rows never meet in one task; a very long text is part
of every example that follows it in its conversation, as the method asks; an empty table gives no example; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ROLE_AND_TEXT = r"(?s)^<\|im_start\|>([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)$"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))


def format_examples(conversations: DataFrame, trainable_role: str = "assistant") -> DataFrame:
    """conv_id, part, example, formatted, loss_start, loss_end (code points, end exclusive; equal: nothing to train)."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    part = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long"))
    told = conversations.select("conv_id", part.alias("part"), "turn", "role", "text")
    turns = told.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    turns = turns.withColumn("marked", F.transform("turns", lambda t: F.concat(_head(t["role"]), escape(t["text"]), F.lit(CLOSE))))
    numbered = F.transform("turns", lambda t, i: F.struct((i + 1).alias("at"), (t["role"] == trainable_role).alias("trained"), t["role"].alias("role"), t["text"].alias("text")))
    wanted = F.filter(numbered, lambda t: t["trained"] | (t["at"] == F.size("turns")))
    each = turns.select("conv_id", "part", "marked", F.explode(wanted).alias("t")).select("conv_id", "part", "marked", "t.*")
    context = F.array_join(F.slice("marked", F.lit(1), F.col("at") - 1), "")
    each = each.select("conv_id", "part", F.col("at").cast("long").alias("example"), "trained", context.alias("context"), _head(F.col("role")).alias("head"), escape(F.col("text")).alias("reply"))
    start = F.length("context") + F.length("head")
    return each.select(
        "conv_id",
        "part",
        "example",
        F.concat("context", "head", "reply", F.lit(CLOSE)).alias("formatted"),
        start.cast("long").alias("loss_start"),
        (start + F.when(F.col("trained"), F.length("reply")).otherwise(0)).cast("long").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(unescape(F.regexp_extract(p, ROLE_AND_TEXT, 1)).alias("role"), unescape(F.regexp_extract(p, ROLE_AND_TEXT, 2)).alias("text")))


def summarise(examples: DataFrame) -> DataFrame:
    """What the examples say of each conversation, read back from the formatted texts and loss spans."""
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = examples.select("conv_id", "part", "example", "formatted", loss.alias("loss"))
    whole = per.groupBy("conv_id", "part").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("parts"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    whole = whole.select("conv_id", "formatted_chars", read_turns(F.col("formatted")).alias("turns"), F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
