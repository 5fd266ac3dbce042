"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only
its text is under the loss mask. What follows the last assistant turn is one more example
without a target, so that nothing of a conversation is lost.

A turn is written ``### role: text </turn>`` and a line break. In texts ``\\``, ``#`` and ``<``
are preceded by ``\\`` (in roles also ``:``), so that neither mark can occur inside one; the way
back drops the ``\\`` before any character.

Turns are ordered by ``turn`` (null first), then role and text; a row that occurs twice is two
turns. Null roles and texts are empty. Rows without ``conv_id`` are one conversation. Other
columns are not read. An empty table gives an empty result.

The examples of a conversation hold each prefix anew, so their size is quadratic in the number
of its turns; that is what the expansion is. A conversation is the unit of work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\#<:])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand(turns: DataFrame) -> DataFrame:
    """Examples: conv_id, example (from 0), target_turn (position, null without target), text, loss_start, loss_chars.

    ``loss_start`` counts code points from 0; the mask is ``text[loss_start : loss_start + loss_chars]``.
    """
    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    conversations = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    parts = conversations.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform("turns", lambda t: F.concat(F.lit(HEAD), escape_role(t["role"]), F.lit(COLON))).alias("heads"),
        F.transform("turns", lambda t: escape(t["text"])).alias("bodies"),
    )
    written = parts.withColumn("written", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(TAIL))))
    targets = F.filter(F.sequence(F.lit(1), F.size("roles")), lambda i: (F.element_at("roles", i) == ASSISTANT) | (i == F.size("roles")))
    one = written.select("conv_id", "roles", "heads", "bodies", "written", F.posexplode(targets).alias("example", "at"))
    head, body, has_target = F.element_at("heads", F.col("at")), F.element_at("bodies", F.col("at")), F.element_at("roles", F.col("at")) == ASSISTANT
    context = F.array_join(F.slice("written", F.lit(1), F.col("at") - 1), "")
    return one.select(
        "conv_id", F.col("example").cast("long").alias("example"), F.when(has_target, F.col("at") - 1).cast("long").alias("target_turn"),
        F.concat(context, F.element_at("written", F.col("at"))).alias("text"),
        F.when(has_target, F.length(context) + F.length(head)).cast("long").alias("loss_start"),
        F.when(has_target, F.length(body)).otherwise(0).cast("long").alias("loss_chars"),
    )


def trained_text(example: Column, start: Column, chars: Column) -> Column:
    """The text under the loss mask, unescaped; empty without a target."""
    return F.when(start.isNull(), F.lit("")).otherwise(unescape(F.substring(example, (start + 1).cast("int"), chars.cast("int"))))


def turns_of(text: Column) -> Column:
    """The turns that a formatted text holds, as an array of (role, text)."""
    pieces = F.filter(F.split(text, TAIL, -1), lambda p: p != "")
    pattern = r"(?s)^### ((?:[^\\:]++|\\.)*+): (.*)$"  # possessive: a role of any length needs no stack
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))
