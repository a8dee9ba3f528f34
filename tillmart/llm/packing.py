"""Packing documents into sequences: shortest-pack-first over the histogram of lengths."""

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, give_back
from tillmart.llm.token_ids import BLOCK_BYTES, encoder
from tillmart.workspace import stage

SEQUENCE = 2048
BROADCAST_BYTES = 32 * 1024 * 1024
_PIECES = "doc_id long, doc_tokens long, start long, length int, ids binary, part int, place long"


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns of lengths and how often each is used, ``[(count, lengths), ...]``.

    Lengths are placed longest first. A length goes to the packs that are shortest so far, as
    often as it fits into each, and opens new ones only when no open pack has room for it; the
    packs of a pattern are moved together, so the work goes with the number of patterns and not
    of pieces.
    """
    open_ = {}  # room left -> [(count, lengths)]
    rooms, done = [], []

    def put(room, count, lengths):
        if room == 0:
            done.append((count, lengths))
            return
        if room not in open_:
            open_[room] = []
            heapq.heappush(rooms, -room)
        open_[room].append((count, lengths))

    def fill(room, count, lengths, length, left):
        """Up to ``left`` pieces into ``count`` packs of a pattern, full packs first; what is left, and the packs made."""
        fits = room // length
        full = min(count, left // fits)
        rest = left - full * fits if full < count else 0
        made = [(room - fits * length, full, lengths + (length,) * fits)] if full else []
        if rest:
            made.append((room - rest * length, 1, lengths + (length,) * rest))
        untouched = count - full - bool(rest)
        if untouched and lengths:
            made.append((room, untouched, lengths))
        return left - full * fits - rest, made

    for length in sorted(histogram, reverse=True):
        left, made = histogram[length], []
        while left:
            while rooms and not open_.get(-rooms[0]):
                open_.pop(-heapq.heappop(rooms), None)
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                count, lengths = open_[room].pop()
            else:
                room, count, lengths = size, left, ()
            left, now = fill(room, count, lengths, length, left)
            made += now
        for pack in made:
            put(*pack)
    return done + [pack for packs in open_.values() for pack in packs]


def _pieces(path: str, end_id: int, size: int):
    def cut(batches):
        part, places = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        coder = encoder(path)
        for batch in bounded(batches, "text", BLOCK_BYTES):
            ids, bounds = coder.encode(batch.column("text"))
            lengths = np.diff(bounds) + 1
            whole = np.full(len(ids) + len(lengths), end_id, np.uint32)
            at = np.cumsum(lengths) - 1
            keep = np.ones(len(whole), bool)
            keep[at] = False
            whole[keep] = ids
            counts = -(-lengths // size)
            row = np.repeat(np.arange(len(lengths)), counts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * size
            length = np.minimum(lengths[row] - start, size)
            offsets = 4 * np.append(np.cumsum(length) - length, length.sum())
            held = pa.Array.from_buffers(pa.large_binary(), len(row), [
                None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole.astype("<u4"))
            ])
            # The how-manieth piece of its length in this task.
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            first = np.searchsorted(sorted_, sorted_)
            place = np.empty(len(row), np.int64)
            place[order] = np.arange(len(row)) - first
            place += places[length]
            places += np.bincount(length, minlength=size + 1)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()).take(pa.array(row)), pa.array(lengths[row]), pa.array(start),
                pa.array(length.astype(np.int32)), held.cast(pa.binary()), pa.array(np.full(len(row), part, np.int32)), pa.array(place),
            ], ["doc_id", "doc_tokens", "start", "length", "ids", "part", "place"])
        coder.forget()
        give_back()
    return cut


def _if_small(table: DataFrame, row_bytes: int, rows: int) -> DataFrame:
    return F.broadcast(table) if rows * row_bytes <= BROADCAST_BYTES else table


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, size: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``size`` tokens.

    Returns doc_id, doc_tokens (with ``end_id``, which follows each document), start, length,
    ids (little-endian unsigned 32-bit), sequence_id (from 0 without gaps), offset. Documents
    longer than a sequence are cut into full ones and a rest. Null text is the empty text, one
    piece of one token; null doc_ids and repeated rows are documents of their own; other columns
    are left out; no rows give none.

    The pieces are written once. A task numbers its pieces of each length; the counts by task
    and length give every piece its rank among all of its length, and the patterns say which
    sequence that rank fills. Only the histogram, at most ``size`` rows, reaches the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = stage(arrow_map(rows, _pieces(vocabulary, end_id, size), _PIECES), "pieces")
    counts = stage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(spark, shortest_pack_first(histogram, size))
    of_length = W.partitionBy("length").orderBy("part")
    before = counts.select("part", "length", (F.sum("n").over(of_length) - F.col("n")).alias("before"))
    ranked = pieces.join(_if_small(before, 24, counts.count()), ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    # One row per length and pattern that holds it.
    placed = ranked.join(F.broadcast(slots), "length").where(
        (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    ).withColumn("nth", F.col("rank") - F.col("from_rank"))
    return placed.select(
        "doc_id", "doc_tokens", "start", F.col("length").cast("long"), "ids",
        (F.col("first_sequence") + F.expr("nth div times")).alias("sequence_id"),
        (F.col("slot_offset") + F.col("nth") % F.col("times") * F.col("length")).alias("offset"),
    )


def _slots(spark: SparkSession, patterns: list) -> DataFrame:
    """For each length the ranges of ranks, the sequences they fill, ``times`` ranks each, and the first one's offset."""
    taken, rows, sequence = {}, [], 0
    for count, lengths in patterns:
        offset = 0
        for length, same in groupby(lengths):
            times, rank = len([*same]), taken.get(length, 0)
            rows.append((length, rank, rank + count * times, sequence, times, offset))
            taken[length] = rank + count * times
            offset += length * times
        sequence += count
    return spark.createDataFrame(rows, "length int, from_rank long, to_rank long, first_sequence long, times long, slot_offset long")
