"""Preference pairs as text: the shared turns once as prompt, then both completions with masks.

DataFrame functions only. Turns are matched by position with a join, so no conversation is
gathered before its rendered pieces are, and those hold a bounded number of turns.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.workspace import stage

TURNS_PER_PIECE = 1024
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = ("assistant",)


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), role, text and their digest; rows with the same turn are ordered by role and text."""
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    return turns.where("conv_id is not null").select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), F.col("role").cast("string"), F.col("text").cast("string"),
    ).withColumn("digest", F.sha2(F.to_json(F.struct("role", "text")), 256))


def common_prefix(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, n_prompt): with how many equal turns both conversations begin; digests are compared."""
    side = lambda key, name: pairs.select("pair_id", F.col(key).alias("conv_id")).join(
        turns.select("conv_id", "pos", F.col("digest").alias(name)), "conv_id").drop("conv_id")
    both = side("chosen_id", "a").join(side("rejected_id", "b"), ["pair_id", "pos"], "full")
    differs = F.col("a").isNull() | F.col("b").isNull() | (F.col("a") != F.col("b"))
    return both.groupBy("pair_id").agg(F.coalesce(F.min(F.when(differs, F.col("pos"))), F.max("pos") + 1).alias("n_prompt"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(CLOSE))


def _rendered(parts: Column) -> tuple[Column, Column]:
    """(text, mask) of ordered (pos, head, body, trained) structs; mask: begin and end of each trained run."""
    text = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"])), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("mask"))
    mask = F.aggregate(parts, start, lambda s, p: F.struct(
        (s["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
        F.when(p["trained"], F.concat(s["mask"], F.array(s["at"] + F.length(p["head"]), s["at"] + F.length(p["head"]) + F.length(p["body"]))))
        .otherwise(s["mask"]).alias("mask"),
    ), lambda s: s["mask"])
    return text, mask


def format_preferences(
    turns: DataFrame, pairs: DataFrame, trained: tuple[str, ...] = TRAINED, turns_per_piece: int = TURNS_PER_PIECE
) -> DataFrame:
    """pair_id, piece, n_prompt, prompt, chosen, chosen_mask, rejected, rejected_mask.

    ``turns``: conv_id, turn, role, text. ``pairs``: pair_id, chosen_id, rejected_id, one row per
    pair. A turn is its role in a header line, its text and an end mark; the prompt is the longest
    run of equal turns (role and text, nulls equal) with which both begin, rendered from one of
    them. Masks are character ranges of a completion that are trained on: text and end mark of
    ``trained`` roles. A null role or text is empty. Conversations of more than
    ``turns_per_piece`` turns go on in further pieces of the same pair, so no row grows without
    bound; a pair of equal conversations has empty completions. A pair of which a conversation has
    no turns has no prompt and an empty completion; without any turns, or with a null id, it is
    left out, as are turns without conv_id. Repeated turn rows are turns of their own.
    """
    pairs = pairs.select("pair_id", "chosen_id", "rejected_id").where("pair_id is not null")
    turns = stage(numbered(turns), "numbered-turns")
    prefix = common_prefix(turns, pairs)
    side = lambda key, name: pairs.select("pair_id", F.col(key).alias("conv_id")).join(turns, "conv_id").select(
        "pair_id", "pos", "role", "text", F.lit(name).alias("side"))
    # The shared turns of the rejected conversation are left behind before texts move by pair.
    rows = side("chosen_id", "a").unionByName(side("rejected_id", "b")).join(prefix, "pair_id")
    rows = rows.where((F.col("side") == "a") | (F.col("pos") >= F.col("n_prompt")))
    part = F.struct(
        F.col("pos").alias("pos"), _head(F.col("role")).alias("head"), F.concat(F.coalesce("text", F.lit("")), F.lit(END)).alias("body"),
        F.coalesce(F.col("role").isin(*trained), F.lit(False)).alias("trained"))
    listed = lambda wanted: F.sort_array(F.collect_list(F.when(wanted, part)))
    shared = F.col("pos") < F.col("n_prompt")
    rows = rows.groupBy("pair_id", "n_prompt", F.floor(F.col("pos") / turns_per_piece).alias("piece")).agg(
        listed(shared).alias("p"), listed(~shared & (F.col("side") == "a")).alias("a"), listed(F.col("side") == "b").alias("b"))
    prompt, _ = _rendered(F.col("p"))
    chosen, chosen_mask = _rendered(F.col("a"))
    rejected, rejected_mask = _rendered(F.col("b"))
    return rows.select(
        "pair_id", "piece", "n_prompt", prompt.alias("prompt"), chosen.alias("chosen"), chosen_mask.alias("chosen_mask"),
        rejected.alias("rejected"), rejected_mask.alias("rejected_mask"),
    )


def cut_short(turns: DataFrame, role: str = "assistant") -> DataFrame:
    """Each conversation with its last reply cut to half its characters, what follows it left out:
    a worse conversation to prefer the given one to. ``conv_id`` becomes ``-1 - conv_id``.
    A conversation without a reply is kept as it is.
    """
    last = turns.where(F.col("role") == role).groupBy("conv_id").agg(F.max("turn").alias("last"))
    marked = turns.join(last, "conv_id", "left").where(F.col("last").isNull() | (F.col("turn") <= F.col("last")))
    cut = (F.col("turn") == F.col("last")) & (F.col("role") == role)
    half = F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    return marked.select((-1 - F.col("conv_id")).alias("conv_id"), "turn", "role", F.when(cut, half).otherwise(F.col("text")).alias("text"))
