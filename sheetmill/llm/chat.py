"""Chat formatting with cumulative-snapshot collapse (native).

Loggers write a conversation again after every turn, so most logged conversations are
prefixes of longer ones.  Each turn hashes (turn number, role, text); a rolling prefix hash is
the running sum of these (two 64-bit hashes in 32-bit halves, so sums cannot overflow).  A
conversation that equals a proper prefix of another one has the same (turns, hash) as one of
that one's prefixes: one anti-join drops it.  Of equal conversations the smallest id stays.
What remains is rendered.

Running sums use two levels: within (conversation, block of ``BLOCK`` turn numbers), then over
the block totals.  So a conversation that holds a third of all rows spreads over many tasks.
Prefix keys and conversation keys are pre-aggregated before they are shuffled (a first turn
shared by millions is one row per task).  Texts are gathered in parts of at most ``BLOCK``
turns; an ordinary conversation is one part.

Defined results: rows without a conversation id belong to none and take no part; a NULL turn
counts as turn -1, a NULL role as "unknown", a NULL text as empty; repeated rows of a
conversation count once; several different rows of one turn are rendered by role and text,
and a prefix ends only between turn numbers; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheetmill.session import materialize

BLOCK = 1024
SUMS = ("n", "a", "b", "c", "d")


def logged_turns(conversations: DataFrame) -> DataFrame:
    """Distinct turns with their block and the four hash parts."""
    t = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    t = t.distinct().withColumn("block", F.floor(F.col("turn") / BLOCK))
    x, y = F.xxhash64("turn", "role", "text"), F.xxhash64(F.lit("second"), "text", "role", "turn")
    low, high = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF)), lambda h: F.shiftrightunsigned(h, 32)
    return t.select("*", F.lit(1).cast("long").alias("n"), low(x).alias("a"), high(x).alias("b"), low(y).alias("c"), high(y).alias("d"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per (conversation, turn): count and hash of the turns up to it, and of all."""
    totals = turns.groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in SUMS])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    offsets = totals.select("conv_id", "block", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}0") for s in SUMS], F.sum("n").over(whole).alias("turns"))
    per_turn = turns.groupBy("conv_id", "block", "turn").agg(*[F.sum(s).alias(s) for s in SUMS])
    running = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    local = per_turn.select("conv_id", "block", *[F.sum(s).over(running).alias(s) for s in SUMS])
    return local.join(offsets, ["conv_id", "block"]).select("conv_id", "turns", *[(F.col(s) + F.col(f"{s}0")).alias(s) for s in SUMS])


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_copies): the smallest id of each conversation that no longer one begins with."""
    inner = prefixes.filter("n < turns").select(*SUMS).distinct()
    complete = prefixes.filter("n = turns").groupBy(*SUMS).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    return complete.join(inner, list(SUMS), "left_anti").select("conv_id", "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per (conversation, part): the turns in order, each with its role and end mark."""
    place = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
    rows = turns.join(kept, "conv_id").withColumn("part", F.floor((place - 1) / BLOCK))
    line = lambda x: F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("<|end|>\n"))
    parts = rows.groupBy("conv_id", "block", "part", "n_copies").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))  # at most BLOCK turns
    return parts.select("conv_id", "block", "part", F.size("t").cast("long").alias("n_turns"), "n_copies", F.array_join(F.transform("t", line), "").alias("text"))


def format_chats(conversations: DataFrame) -> DataFrame:
    turns = logged_turns(conversations)
    kept = materialize(maximal_conversations(prefix_hashes(turns)), "chat-kept")
    return render(turns.select("conv_id", "block", "turn", "role", "text"), kept)
