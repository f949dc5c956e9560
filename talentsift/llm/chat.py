"""Chat formatting in budgeted windows, with built-in functions only.

Prefix sums of turn tokens place every turn in one window. The grid step is
half of what the budget leaves after the system turn and the repeated
history, so turns up to that size never push a window over the budget, and no
window depends on where an earlier one ended: the sums are one pass. A longer
turn stays whole and its window exceeds the budget. Later windows start with
the system turn and with the turns that fit into ``history`` tokens before
them; both lie outside the loss mask there.

A conversation is ordered by ``turn``, then role and text, so ties and
repeated rows have one result. Null roles and texts are empty, a null id is
a conversation of its own, an empty table gives no rows, and other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT, SYSTEM = "assistant", "system"
OPEN, NAMED, CLOSE = "<s>[", "]", "</s>"
TOKEN = r"[0-9A-Za-z]+|[^0-9A-Za-z \t\n\r]"
MARK_TOKENS = 4
# The backslash goes first when escaping and last when reading back.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))


def escape(text: Column) -> Column:
    """Text without any character that a mark contains; a backslash starts each replacement."""
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[0]), F.lit(pair[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[1]), F.lit(pair[0])), reversed(ESCAPES), text)


def place_turns(turns: DataFrame, *, budget: int, history: int) -> DataFrame:
    """One row per turn and window it appears in: ``conv_id, window, ordinal, role, text, fresh``."""
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    rows = (
        turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("ordinal", F.row_number().over(ordered))
        .withColumn("cost", (F.regexp_count("text", F.lit(TOKEN)) + MARK_TOKENS).cast("long"))
        .withColumn("is_system", (F.col("ordinal") == 1) & (F.col("role") == SYSTEM))
        .withColumn("system_cost", F.max(F.when(F.col("is_system"), F.col("cost")).otherwise(0)).over(whole))
        .withColumn("step", F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("system_cost")) / 2)))
        .withColumn("end", F.sum(F.when(~F.col("is_system"), F.col("cost")).otherwise(0)).over(ordered))
        .withColumn("begin", F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("end") - F.col("cost")))
        .withColumn("cell", F.floor(F.col("begin") / F.col("step")))
        .withColumn("window", F.dense_rank().over(Window.partitionBy("conv_id").orderBy("cell")))
        .withColumn("windows", F.max("window").over(whole))
        .withColumn("window_end", F.max("end").over(Window.partitionBy("conv_id", "window")))
    )
    again = F.when(F.col("is_system") & (F.col("windows") > 1), F.sequence(F.lit(2), F.col("windows")))
    again = again.when(
        ~F.col("is_system") & (F.col("window") < F.col("windows")) & (F.col("window_end") - F.col("begin") <= history),
        F.array(F.col("window") + 1),
    ).otherwise(F.array().cast("array<int>"))
    return rows.select(
        "conv_id", "ordinal", "role", "text", F.col("window").alias("own"), F.explode(F.concat(F.array("window"), again)).alias("window")
    ).withColumn("fresh", F.col("own") == F.col("window")).drop("own")


def format_chats(turns: DataFrame, *, budget: int = 1024, history: int = 128) -> DataFrame:
    """Training windows: ``conv_id, window, formatted, n_repeated, loss``.

    ``loss`` lists the code point ranges of ``formatted`` that count as
    targets: each assistant text, in the window where it first appears.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(NAMED))
    before = Window.partitionBy("conv_id", "window").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        place_turns(turns, budget=budget, history=history)
        .withColumn("head", head)
        .withColumn("body", escape(F.col("text")))
        .withColumn("segment", F.concat("head", "body", F.lit(CLOSE)))
        .withColumn("at", F.coalesce(F.sum(F.length("segment")).over(before), F.lit(0)) + F.length("head"))
        .withColumn("target", F.col("fresh") & (F.col("role") == ASSISTANT) & (F.length("body") > 0))
    )
    parts = F.array_sort(F.collect_list(F.struct("ordinal", "segment")))
    spans = F.collect_list(F.when(F.col("target"), F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end"))))
    return (
        rows.groupBy("conv_id", "window")
        .agg(parts.alias("parts"), F.array_sort(spans).alias("loss"), F.sum(F.when(F.col("fresh"), 0).otherwise(1)).alias("n_repeated"))
        .select("conv_id", "window", F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("formatted"), "n_repeated", "loss")
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of what the windows hold, from their text and mask alone."""
    segments = F.split("formatted", CLOSE, -1)
    kept = F.slice(segments, F.col("n_repeated").cast("int") + 1, F.size(segments) - 1 - F.col("n_repeated").cast("int"))

    def turn_text(segment: Column) -> Column:
        named = F.substring_index(segment, NAMED, 1)
        role = F.substring(named, F.lit(len(OPEN) + 1), F.length(named))
        text = F.substring(segment, F.length(named) + len(NAMED) + 1, F.length(segment))
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    def loss_text(span: Column) -> Column:
        start, end = span["start"].cast("int"), span["end"].cast("int")
        return unescape(F.substring(F.col("formatted"), start + 1, end - start))

    per_window = windows.select(
        "conv_id",
        "window",
        F.size(kept).cast("long").alias("n"),
        F.array_join(F.transform(kept, turn_text), "").alias("turns"),
        F.array_join(F.transform("loss", loss_text), "").alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )

    def joined(field: str) -> Column:
        return F.array_join(F.transform("parts", lambda p: p[field]), "")

    return (
        per_window.groupBy("conv_id")
        .agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts"))
        .select(
            "conv_id",
            "n_turns",
            F.sha2(joined("turns").cast("binary"), 256).alias("turns_sha256"),
            F.length(joined("loss")).cast("long").alias("loss_chars"),
            F.sha2(joined("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
