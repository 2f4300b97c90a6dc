"""Preference pairs of conversations as a shared prompt and two masked completions.

Works turn by turn: the turns of a pair's two conversations are matched, the first mismatch
ends the common prefix, and every turn becomes one rendered row.  No conversation is gathered
in one place, so a conversation of any length is dealt out over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Marks around a rendered turn.
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"
#: Turns of this role are trained on; all others are masked.
TRAINED = "assistant"


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each turn of each pair: pair_id, part (``prompt``, ``chosen``,
    ``rejected``), turn, tie, role, rendered text, trained (0 or 1), n_chars, paired.

    ``turns`` holds conv_id, turn, role, text; ``pairs`` holds pair_id, chosen, rejected
    (conversation ids).  The prompt is the longest run of turns, from the first on, in which
    both conversations have the same role and text; it appears once and is masked whole.
    Turns are matched by number; a number that only one side has ends the prompt.  Repeated
    rows of a conversation count once; several texts of one number are ordered by role and
    text (``tie``).  Null role or text renders as nothing and equals only null; a null turn
    comes first.  Rows with a null conv_id belong to no pair.  A side without turns leaves the
    other whole, with ``paired`` false.
    """
    once = turns.select("conv_id", "turn", "role", "text").filter(
        F.col("conv_id").isNotNull()).distinct()
    among = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    once = once.withColumn("tie", F.row_number().over(among) - 1)
    place = F.struct(F.col("turn").alias("turn"), F.col("tie").alias("tie"))
    sided = once.select("conv_id", place.alias("at"), F.struct("role", "text").alias("said"))

    def side(name: str) -> DataFrame:
        return (pairs.select("pair_id", F.col(name).alias("conv_id")).join(sided, "conv_id")
                .select("pair_id", "at", F.col("said").alias(name)))

    both = (side("chosen").alias("c").join(
        side("rejected").alias("r"),
        (F.col("c.pair_id") == F.col("r.pair_id")) & F.col("c.at").eqNullSafe(F.col("r.at")), "full")
        .select(F.coalesce("c.pair_id", "r.pair_id").alias("pair_id"),
                F.coalesce("c.at", "r.at").alias("at"), "chosen", "rejected"))
    same = F.col("chosen").eqNullSafe(F.col("rejected"))
    ends = both.groupBy("pair_id").agg(
        F.min(F.when(~same, F.col("at"))).alias("end"),
        (F.bool_or(F.col("chosen").isNotNull()) & F.bool_or(F.col("rejected").isNotNull())
         ).alias("paired"))
    joined = both.join(ends, "pair_id")
    common = F.col("end").isNull() | (F.col("at") < F.col("end"))

    def part(name: str, value: str):
        return F.when(F.col(value).isNotNull(), F.struct(F.lit(name).alias("part"),
                                                         F.col(value).alias("said")))

    parts = F.when(common, F.array(part("prompt", "chosen"))).otherwise(
        F.array(part("chosen", "chosen"), part("rejected", "rejected")))
    rows = joined.select("pair_id", "at", "paired", F.explode(
        F.filter(parts, lambda x: x.isNotNull())).alias("p"))
    blank = F.lit("")
    role, text = F.coalesce("p.said.role", blank), F.coalesce("p.said.text", blank)
    return rows.select(
        "pair_id", "p.part", "at.turn", "at.tie", "p.said.role",
        F.concat(F.lit(OPEN), role, F.lit(AFTER_ROLE), text, F.lit(CLOSE)).alias("rendered"),
        F.when((role == TRAINED) & (F.col("p.part") != "prompt"), 1).otherwise(0).alias("trained"),
        F.length(text).cast("long").alias("n_chars"), "paired")


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2k (chosen) and 2k + 1 (rejected)."""
    half = F.floor(F.col("conv_id") / 2).cast("long")
    ids = turns.filter(F.col("conv_id").isNotNull()).select(half.alias("pair_id")).distinct()
    return ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen"),
                      (F.col("pair_id") * 2 + 1).alias("rejected"))


def swapped(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and pairs in which every conversation (chosen) meets itself with another answer.

    The rejected side is the conversation up to its last turn of ``TRAINED``, whose text is
    replaced by the last such text of the conversation with the neighbouring id (2k and 2k + 1
    are neighbours); all before is common to both.  Conversation c becomes 2c (chosen) and 2c + 1
    (rejected), the pair c.  Where either conversation has no such turn there is no rejected side.
    A null id belongs to no pair; of several last texts of one number the greatest counts.
    """
    known = turns.select("conv_id", "turn", "role", "text").filter(F.col("conv_id").isNotNull())
    last = known.filter((F.col("role") == TRAINED) & F.col("turn").isNotNull()).groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("last"))
    neighbour = F.col("conv_id") + 1 - 2 * F.pmod("conv_id", F.lit(2))
    answers = last.select(neighbour.alias("conv_id"), F.col("last.text").alias("other")).join(
        last.select("conv_id", F.col("last.turn").alias("at")), "conv_id")
    rejected = known.join(answers, "conv_id").filter(F.col("turn").isNull() | (F.col("turn") <= F.col("at")))
    ends = (F.col("turn") == F.col("at")) & (F.col("role") == TRAINED)
    both = known.withColumn("conv_id", F.col("conv_id") * 2).unionByName(rejected.select(
        (F.col("conv_id") * 2 + 1).alias("conv_id"), "turn", "role",
        F.when(ends, F.col("other")).otherwise(F.col("text")).alias("text")))
    ids = known.select("conv_id").distinct()
    return both, ids.select(F.col("conv_id").alias("pair_id"), (F.col("conv_id") * 2).alias("chosen"),
                            (F.col("conv_id") * 2 + 1).alias("rejected"))
