"""Chat formatting: logged snapshots collapse into the conversation they grew into.

Chat services log a conversation again after every turn, so one table holds
many prefixes of one talk. Turns are ranged over (conversation, turn, role, text),
so a long conversation spreads over tasks. Each turn's role and text are hashed with
their place, and the exclusive or of these hashes rolls on from turn to turn, so
every turn carries the hash of its prefix; two seeds give 128 bits. A conversation
whose whole hash is another one's shorter prefix is a snapshot: an anti-join drops it.
Equal conversations leave the one with the smallest id. Only what remains is gathered,
one row per conversation, and rendered with role markers.

Edge cases: turns are put in order of (turn, role, text), NULLs first, and
counted from zero, so gaps and repeated turn numbers are harmless; a NULL role
is written as ``unknown`` and a NULL text as empty, but neither equals an empty
string when prefixes are compared; a row without a conv_id is a conversation of
one turn by itself, however many such rows there are; fully repeated rows count
once; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketpulse.llm.common import Scratch

START, END = "<|im_start|>", "<|im_end|>"


#: Characters of a text that take part in the range bounds, which are sampled to the driver.
BOUND_CHARS = 64


def _prefix_hashes(ranged: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(ha, hb) of every shorter prefix, and (talk, ha, hb) of every whole conversation.

    A conversation's rows lie in consecutive parts; each part is numbered and hashed by itself, and what earlier parts
    hold of the conversation, a count and two hashes, is added."""
    said = [F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    slim = ranged.select("talk", "part", "pos", F.col("turn").isNull().alias("no_turn"), "turn",
                         F.xxhash64(F.lit(1), *said).alias("a"), F.xxhash64(F.lit(2), *said).alias("b"))
    here = Window.partitionBy("part", "talk").orderBy("pos")
    row = F.struct("no_turn", "turn", "a", "b")
    fresh = (slim.withColumn("again", F.coalesce(row.eqNullSafe(F.lag(row).over(here)), F.lit(False))).filter("NOT again")
             .select("talk", "part", "pos", "a", "b", F.row_number().over(here).alias("place")))
    earlier = Window.partitionBy("talk").orderBy("part")
    counts = fresh.groupBy("part", "talk").agg(F.count("*").alias("n")).select(
        "part", "talk", (F.sum("n").over(earlier) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("talk")).alias("n_turns"))
    place = F.col("place") + F.col("before")
    placed = scratch.save(fresh.join(counts, ["part", "talk"]).select(
        "talk", "part", "pos", (place == F.col("n_turns")).alias("last"),
        F.xxhash64(place, "a").alias("a"), F.xxhash64(place, "b").alias("b")), "placed")
    sums = placed.groupBy("part", "talk").agg(F.bit_xor("a").alias("sa"), F.bit_xor("b").alias("sb"))
    carried = sums.select("part", "talk", *[F.bit_xor(c).over(earlier).bitwiseXOR(F.col(c)).alias(f"c{c}") for c in ("sa", "sb")])
    rolled = (placed.filter("NOT last")
              .select("talk", "part", F.bit_xor("a").over(here).alias("ra"), F.bit_xor("b").over(here).alias("rb"))
              .join(carried, ["part", "talk"])
              .select(F.col("ra").bitwiseXOR(F.col("csa")).alias("ha"), F.col("rb").bitwiseXOR(F.col("csb")).alias("hb")))
    whole = sums.groupBy("talk").agg(F.bit_xor("sa").alias("ha"), F.bit_xor("sb").alias("hb"))
    return rolled.distinct(), whole


def _rendered() -> Column:
    # A text cannot forge a marker: the bar inside its markers is doubled.
    safe = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"<\|(im_start|im_end)\|>", r"<||$1||>")
    return F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(START), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"), safe(t["text"]), F.lit(END))), "\n")


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                          text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, turns): conversations that no longer one begins with.

    Runs jobs while it is called: the ranged turns and their hashes are written to the shared folder."""
    spark = turns.sparkSession
    scratch = Scratch(spark, "chat")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    conv = turns[conv_col]
    rows = turns.select(
        F.struct(conv.isNull().alias("unnamed"), conv.alias("conv_id"),
                 F.when(conv.isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long")).alias("row")).alias("talk"),
        turns[turn_col].alias("turn"), turns[role_col].alias("role"), turns[text_col].alias("text"))
    # monotonically_increasing_id after the sort follows the order; its upper bits are the part.
    ranged = scratch.save(
        rows.repartitionByRange(parts, "talk", "turn", "role", F.substring("text", 1, BOUND_CHARS))
        .sortWithinPartitions("talk", "turn", "role", "text")
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "ranged")
    prefixes, whole = _prefix_hashes(ranged, scratch)
    kept = whole.groupBy("ha", "hb").agg(F.min("talk").alias("talk")).join(prefixes, ["ha", "hb"], "left_anti").select("talk")
    return (ranged.select("talk", F.struct("turn", "role", "text").alias("t")).join(kept, "talk", "left_semi")
            .groupBy("talk").agg(F.array_sort(F.collect_set("t")).alias("turns"))
            .select("talk.conv_id", F.size("turns").cast("long").alias("n_turns"), "turns"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, text): one rendered text per maximal conversation."""
    return maximal_conversations(turns, conv_col, turn_col, role_col, text_col).select(
        "conv_id", "n_turns", _rendered().alias("text"))
