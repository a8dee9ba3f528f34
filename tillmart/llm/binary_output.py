"""Token ids as binary shards, each with a minimal perfect hash index from key to ids.

Format: a Parquet table, one row per shard. ``payload`` holds the ids of its documents one after
the other, little-endian, ``width`` bytes each. Documents stand in ascending key order over all
shards, ordered by (part, shard). ``starts`` (little-endian int64, one more than documents) are
offsets into the payload in ids. ``levels``, ``slots`` and ``prints`` are the index: a key's slot
(constant time, no key stored) gives its fingerprint, its first document and how many follow.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, give_back
from tillmart.llm.token_ids import BLOCK_BYTES, crc_of, encoder

SHARD_IDS = 2_000_000
SCHEMA = (
    "part int, shard int, first_key long, last_key long, n_docs int, n_ids long, width int, payload binary, "
    "keys binary, null_keys int, starts binary, level_bits array<int>, levels binary, slots binary, prints binary"
)
_BATCH = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()),
    ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()), ("payload", pa.binary()),
    ("keys", pa.binary()), ("null_keys", pa.int32()), ("starts", pa.binary()), ("level_bits", pa.list_(pa.int32())),
    ("levels", pa.binary()), ("slots", pa.binary()), ("prints", pa.binary()),
])
# Fixed values of the splitmix64 finaliser.
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of int64 keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(_MIX[0] * (seed + 1) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
        return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Minimal perfect hash of distinct keys: a cascade of bit tables.

    On each level a key alone in its place sets the place's bit; the others go on to the next
    level. A key's slot is the number of bits set before its own.
    """

    sizes: list[int]
    bits: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, spread: int = 2) -> "PerfectHash":
        left, sizes, tables = keys, [], []
        while len(left):
            size = max(8, spread * len(left))
            place = mix(left, len(sizes)) % np.uint64(size)
            held = np.bincount(place.astype(np.int64), minlength=size)
            tables.append(held == 1)
            sizes.append(size)
            left = left[held[place.astype(np.int64)] > 1]
        return cls(sizes, np.concatenate(tables) if tables else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; for a key it wasn't built from some slot, or -1."""
        rank = np.cumsum(self.bits) - 1
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = base + (mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[place]
            out[open_[hit]] = rank[place[hit]]
            open_, base = open_[~hit], base + size
        return out


def _prints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def _shard(part: int, shard: int, keys: list, lengths: list, ids: np.ndarray, width: int) -> dict:
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], np.int64)
    distinct, first, count = np.unique(known, return_index=True, return_counts=True)
    index = PerfectHash.build(distinct)
    at = index.slots(distinct)
    slots = np.zeros((len(distinct), 2), np.int32)
    slots[at] = np.stack([first + nulls, count], 1)
    prints = np.zeros(len(distinct), np.uint32)
    prints[at] = _prints(distinct)
    return {
        "part": part, "shard": shard,
        "first_key": int(known[0]) if len(known) else None, "last_key": int(known[-1]) if len(known) else None,
        "n_docs": len(keys), "n_ids": len(ids), "width": width, "payload": ids.astype(f"<u{width}").tobytes(),
        "keys": known.astype("<i8").tobytes(), "null_keys": nulls,
        "starts": np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes(),
        "level_bits": index.sizes, "levels": np.packbits(index.bits).tobytes(),
        "slots": slots.astype("<i4").tobytes(), "prints": prints.astype("<u4").tobytes(),
    }


def _shards_of(path: str, end_id: int, shard_ids: int):
    def make(batches):
        part, shard = TaskContext.get().partitionId(), 0
        coder = encoder(path)
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        keys, lengths, held, n = [], [], [], 0
        for batch in bounded(batches, "text", BLOCK_BYTES):
            ids, starts = coder.encode(batch.column("text"))
            for i, key in enumerate(batch.column("doc_id").to_pylist()):
                own = ids[starts[i]:starts[i + 1]]
                keys.append(key)
                lengths.append(len(own) + 1)
                held += [own.astype(np.uint32), np.array([end_id], np.uint32)]
                n += len(own) + 1
                if n >= shard_ids:
                    yield pa.RecordBatch.from_pylist([_shard(part, shard, keys, lengths, np.concatenate(held), width)], _BATCH)
                    keys, lengths, held, n, shard = [], [], [], 0, shard + 1
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, shard, keys, lengths, np.concatenate(held), width)], _BATCH)
        coder.forget()
        give_back()
    return make


def write_token_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text; other columns are left out) and write the shards to ``folder``.

    One shuffle by ranges of doc_id. Null doc_ids come first and are not in the index; rows with
    the same doc_id are kept, in the order of their texts, and found together. Null text is the
    empty text. ``end_id`` follows each document. A shard holds ``shard_ids`` ids, or one longer
    document. No rows: an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    arrow_map(ordered, _shards_of(vocabulary, end_id, shard_ids), SCHEMA).write.parquet(folder)


def read_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


class Shard:
    """One row of the table, for reading by key or in order."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")
        self.starts = np.frombuffer(row["starts"], "<i8")
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.null_keys = row["null_keys"]
        sizes = list(row["level_bits"])
        bits = np.unpackbits(np.frombuffer(row["levels"], np.uint8))[:sum(sizes)].astype(bool)
        self.index = PerfectHash(sizes, bits)
        self.slots = np.frombuffer(row["slots"], "<i4").reshape(-1, 2)
        self.prints = np.frombuffer(row["prints"], "<u4")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; (-1, 0) for a key that isn't here.

        A key that isn't here passes for another with a chance of one in 2**32.
        """
        at = self.index.slots(keys)
        here = at >= 0
        here[here] = self.prints[at[here]] == _prints(keys[here])
        first, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        first[here], count[here] = self.slots[at[here]].T
        return first, count

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.starts[i]:self.starts[i + 1]]


def _found_by(keys: np.ndarray):
    def look(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                first, count = shard.find(keys)
                out = [(int(k), shard.document(i).tolist()) for k, f, c in zip(keys, first, count) for i in range(f, f + c)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in out], pa.int64()), pa.array([v for _, v in out], pa.list_(pa.int64()))], ["doc_id", "ids"]
                )
    return look


def lookup_ids(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """The ids of a list of keys: only shards whose key range holds one are read, each key in constant time."""
    wanted = np.unique(np.array(keys, np.int64))
    shards = read_token_shards(spark, folder)
    listed = F.array(*[F.lit(int(k)) for k in wanted]).cast("array<bigint>")
    shards = shards.where(F.exists(listed, lambda k: k.between(F.col("first_key"), F.col("last_key"))))
    return arrow_map(shards, _found_by(wanted), "doc_id long, ids array<bigint>")


def _digests(batches):
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row)
            n = len(shard.starts) - 1
            first, count = shard.find(shard.keys)
            ordinal = np.arange(shard.null_keys, n)
            # Each document is reached through the index; rows with one key are a run from its first.
            reached = first + (ordinal - np.searchsorted(shard.keys, shard.keys) - shard.null_keys)
            if (reached != ordinal).any() or (count < 1).any():
                raise ValueError("index and payload disagree")
            where = np.concatenate([np.arange(shard.null_keys), reached])
            keys = pa.array([None] * shard.null_keys + shard.keys.tolist(), pa.int64())
            lengths = np.diff(shard.starts)
            yield pa.RecordBatch.from_arrays([
                keys, pa.array(row["before"] + shard.starts[:-1][where], pa.int64()), pa.array(lengths[where], pa.int64()),
                pa.array([crc_of(shard.document(i)) for i in where.tolist()], pa.int64()),
            ], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, read back through the index: doc_id, start over all shards, n_tokens, ids_crc32."""
    shards = read_token_shards(spark, folder)
    # A row per part, then a running sum within each part: no window holds all shards.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    parts = parts.select("part", (F.sum("part_ids").over(W.orderBy("part")) - F.col("part_ids")).alias("parts_before"))
    within = W.partitionBy("part").orderBy("shard")
    begun = shards.select("part", "shard", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("shards_before"))
    begun = begun.join(parts, "part").select("part", "shard", (F.col("parts_before") + F.col("shards_before")).alias("before"))
    # A few numbers per shard of two million ids.
    whole = shards.join(begun, ["part", "shard"])
    return arrow_map(whole, _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
