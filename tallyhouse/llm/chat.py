r"""Chat formatting with prefix-target expansion: every assistant turn becomes an example of its own.

A turn is written as ``### role: text </turn>`` and a newline. Inside roles and texts ``\``, ``#``, ``<`` and ``:`` (in roles) are replaced by ``\b``, ``\h``, ``\l`` and ``\c``, so no text can hold a mark
and every text comes back exactly. The example of an assistant turn has all turns before it as context and only that reply
under the loss mask.

An example is a prefix of its formatted conversation. It is kept as a number of context turns and the loss mask, the bytes
of the formatted conversation where the reply begins and ends, not as a copy: a conversation of n turns takes space in
proportion to n, not to its square. Trainable text is cut out by the mask; ``materialise`` builds examples in full.
Everything is built from DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.session import workspace

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
_ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c")]


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in _ESCAPES if role else _ESCAPES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    # the backslash comes last: until then every backslash still opens a code
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


@dataclass(frozen=True)
class ChatFiles:
    """Folders of the written tables: one row per conversation, one row per example."""

    conversations: str
    examples: str


def write(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> ChatFiles:
    """Format conversations and expand them into examples, both written as Parquet.

    Turns are ordered by number (NULL first), then role, then text, so ties and repeated rows have one order and each stays.
    A NULL role or text counts as empty, rows with a NULL conversation key form one conversation, other columns are not read.
    A conversation without a target turn has no example; an empty table gives empty files. One conversation is one string,
    as trainers and digests need it whole.
    """
    spark, folder = turns.sparkSession, workspace(turns.sparkSession, "chat")
    one = F.struct(F.col(turn).alias("n"), F.coalesce(role, F.lit("")).alias("r"), F.coalesce(text, F.lit("")).alias("x"))
    grouped = turns.select(F.col(conv).alias("conv_key"), one.alias("one")).groupBy("conv_key").agg(F.sort_array(F.collect_list("one")).alias("all"))

    def line(o: Column) -> Column:
        return F.concat(F.lit(OPEN), escape(o["r"], role=True), F.lit(MIDDLE), escape(o["x"]), F.lit(CLOSE))

    formatted = grouped.select("conv_key", F.size("all").cast("long").alias("n_turns"), F.array_join(F.transform("all", line), "").alias("formatted"))
    formatted.write.parquet(f"{folder}/conversations")
    files = ChatFiles(f"{folder}/conversations", f"{folder}/examples")
    examples(conversations(spark, files), target).write.parquet(files.examples)
    return files


def conversations(spark: SparkSession, files: ChatFiles) -> DataFrame:
    return spark.read.parquet(files.conversations)


def parsed(formatted: str = "formatted") -> Column:
    """Turns of a formatted conversation as an array of (role, text), still escaped."""
    lines = F.slice(F.split(formatted, CLOSE.replace("/", "\\/")), 1, F.size(F.split(formatted, CLOSE.replace("/", "\\/"))) - 1)
    body = F.transform(lines, lambda x: F.substr(x, F.lit(len(OPEN) + 1)))
    return F.transform(body, lambda b: F.struct(
        F.substring_index(b, MIDDLE, 1).alias("role"),
        F.substr(b, F.length(F.substring_index(b, MIDDLE, 1)) + len(MIDDLE) + 1).alias("text"),
    ))


def examples(rows: DataFrame, target: str = "assistant") -> DataFrame:
    """One row per target turn: ``conv_key``, ``context_turns`` (turns before it), ``loss_start`` and ``loss_end`` (bytes of the
    UTF-8 formatted conversation under the mask)."""
    head = F.octet_length("one.role") + len(OPEN + MIDDLE)
    size = F.octet_length("one.text")
    turns = rows.select("conv_key", F.posexplode(parsed()).alias("context_turns", "one")).select(
        "conv_key", "context_turns", head.cast("long").alias("head"), size.cast("long").alias("size"), (unescape(F.col("one.role")) == target).alias("aimed")
    )
    # only lengths are dealt out, no text
    end = F.sum(F.col("head") + F.col("size") + len(CLOSE)).over(Window.partitionBy("conv_key").orderBy("context_turns")) - len(CLOSE)
    masked = turns.withColumn("loss_end", end).where("aimed")
    return masked.select("conv_key", "context_turns", (F.col("loss_end") - F.col("size")).alias("loss_start"), "loss_end")


def _cut(raw: Column, start: Column | int, stop: Column) -> Column:
    """Text between two byte positions."""
    start = start if isinstance(start, Column) else F.lit(start)
    return F.substr(raw, (start + 1).cast("int"), (stop - start).cast("int")).cast("string")


def materialise(spark: SparkSession, files: ChatFiles) -> DataFrame:
    """Examples in full: ``conv_key``, ``context_turns``, ``example`` text, ``loss_start`` and ``loss_end`` (characters under the mask)."""
    rows = spark.read.parquet(files.examples).join(conversations(spark, files).withColumnRenamed("conv_key", "same"), F.col("conv_key").eqNullSafe(F.col("same")))
    raw, start, stop = F.col("formatted").cast("binary"), F.col("loss_start"), F.col("loss_end")
    return rows.select(
        "conv_key", "context_turns", _cut(raw, 0, stop + len(CLOSE)).alias("example"),
        F.length(_cut(raw, 0, start)).alias("loss_start"), F.length(_cut(raw, 0, stop)).alias("loss_end"),
    )


def digest(spark: SparkSession, files: ChatFiles, conv: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the files: turns and their digest, trainable characters and their digest.

    Trainable text is what the masks of the examples leave of the formatted conversation.
    """
    whole = conversations(spark, files).select(
        "conv_key", "n_turns", F.col("formatted").cast("binary").alias("raw"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.sha2(F.array_join(F.transform(parsed(), lambda o: F.concat(unescape(o["role"]), F.lit("\n"), unescape(o["text"]), F.lit("\n"))), ""), 256).alias("turns_sha256"),
    )
    found = spark.read.parquet(files.examples).groupBy(F.col("conv_key").alias("same")).agg(
        F.sort_array(F.collect_list(F.struct("context_turns", "loss_start", "loss_end"))).alias("all")
    )
    joined = whole.join(found, F.col("conv_key").eqNullSafe(F.col("same")), "left")
    # raw is a variable of the outer function, so that a conversation is read once and not once a turn
    texts = F.flatten(F.transform(F.array("raw"), lambda raw: F.transform("all", lambda o: unescape(_cut(raw, o["loss_start"], o["loss_end"])))))
    joined = joined.withColumn("loss", F.coalesce(F.array_join(texts, ""), F.lit("")))
    return joined.select(
        F.col("conv_key").alias(conv), "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
