"""Chat logs: conversations that a longer one continues go, the rest are rendered."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns in one row of rendered text, and in one step of the rolling hash.
PART = 256


def prefixes(conversations: DataFrame, part: int = PART) -> DataFrame:
    """Each turn with its place ``i`` (from 1), the number ``n`` of turns, and ``h1``, ``h2``: the hash of all turns up to it.

    Turns are in order of turn (null first), role and text; null role and text count as empty,
    a turn that is repeated in all of these counts once, and rows without conv_id belong to no
    conversation. Long conversations are cut by turn number into parts: places and
    hashes come from sums within a part and over the parts before it, so no task holds more of
    a conversation than a part.
    """
    turns = (conversations.where("conv_id is not null")
             .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
             .distinct().withColumn("chunk", F.coalesce(F.floor(F.col("turn") / part), F.lit(-(2**62)))))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "text")
    numbered = turns.withColumn("at", F.row_number().over(inside))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    sizes = (turns.groupBy("conv_id", "chunk").agg(F.count("*").alias("size"))
             .withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
             .withColumn("n", F.sum("size").over(whole)))
    placed = (numbered.join(sizes.select("conv_id", "chunk", "offset", "n"), ["conv_id", "chunk"])
              .withColumn("i", F.col("offset") + F.col("at")))
    for k in (1, 2):
        placed = placed.withColumn(f"g{k}", F.xxhash64(F.lit(k), "i", "role", "text"))
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.withColumns({f"r{k}": F.bit_xor(f"g{k}").over(so_far) for k in (1, 2)})
    totals = (placed.groupBy("conv_id", "chunk").agg(*[F.bit_xor(f"g{k}").alias(f"t{k}") for k in (1, 2)])
              .select("conv_id", "chunk", *[F.coalesce(F.bit_xor(f"t{k}").over(before), F.lit(0).cast("long")).alias(f"t{k}") for k in (1, 2)]))
    return (rolled.join(totals, ["conv_id", "chunk"])
            .select("conv_id", "i", "n", "role", "text", *[F.col(f"r{k}").bitwiseXOR(F.col(f"t{k}")).alias(f"h{k}") for k in (1, 2)]))


def collapse(hashed: DataFrame) -> DataFrame:
    """conv_id, n and ``n_same`` of the conversations that no other one continues.

    Of equal conversations the smallest conv_id stays, with their number. Both sides of the
    anti join hold each prefix once, however many conversations begin with it.
    """
    last = (hashed.where("i = n").groupBy("n", "h1", "h2")
            .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same")))
    continued = hashed.where("i < n").select(F.col("i").alias("n"), "h1", "h2").distinct()
    return last.join(continued, ["n", "h1", "h2"], "left_anti").select("conv_id", "n", "n_same")


def render(conversations: DataFrame, part: int = PART) -> DataFrame:
    """The conversations that stay, as text: conv_id, n_turns, n_same, part (from 0) and text.

    A part holds at most ``part`` turns, so a conversation of up to that many turns is one row.
    """
    hashed = prefixes(conversations, part)
    turn = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n"))
    kept = hashed.select("conv_id", "i", turn.alias("turn")).join(collapse(hashed), "conv_id")
    return (kept.groupBy("conv_id", F.floor((F.col("i") - 1) / part).alias("part"))
            .agg(F.first("n").alias("n_turns"), F.first("n_same").alias("n_same"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "turn"))), lambda x: x["turn"]), "").alias("text"))
            .select("conv_id", "n_turns", "n_same", "part", "text"))
