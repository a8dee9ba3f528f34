"""Which tokens of two vocabularies cover the same bytes of a text.

Both token streams spell the same bytes, a blank and the text. For the tokens of a block of texts,
``merge_asof`` keyed by document finds, from each token's first byte, the other side's token that
covers it; the two directions together are all overlaps. Overlapping tokens that end on the same
byte close a group. How often two ids are linked is counted over all documents.
"""

import hashlib
import re
from collections import namedtuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, plain_text
from tillmart.llm.plain_ids import PieceEncoder, PlainEncoder, plain_encoder, taken
from tillmart.workspace import stage

BLOCK_BYTES = 512 * 1024
PAIR_TABLE_BYTES = 32 * 1024 * 1024
# Both vocabularies begin a token at a blank between two letters.
_BETWEEN_WORDS = re.compile(rb"(?<=[A-Za-z])(?= [A-Za-z])")

#: a, b: token of each link; a_last, b_last: of each group
Links = namedtuple("Links", "a b a_last b_last")


def overlaps(a_text: np.ndarray, a_end: np.ndarray, b_text: np.ndarray, b_end: np.ndarray) -> Links:
    """Links and groups of the tokens of some texts, one text after the other.

    ``a_text``, ``b_text``: the text of each token; ``a_end``, ``b_end``: its end, in bytes from the
    first text's begin. Links by A token come first, then those by B token that aren't among them.
    """
    a_start, b_start = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (a_end, b_end))
    a, b = (pd.DataFrame({"text": text, "byte": start}, copy=False) for text, start in ((a_text, a_start), (b_text, b_start)))
    over = pd.merge_asof(a, b.assign(b=np.arange(len(b))), on="byte", by="text")["b"].to_numpy(np.int64)
    back = pd.merge_asof(b, a.assign(a=np.arange(len(a))), on="byte", by="text")["a"].to_numpy(np.int64)
    new = np.flatnonzero(a_start[back] != b_start)
    of_a, of_b = np.concatenate([np.arange(len(a)), back[new]]), np.concatenate([over, new])
    closing = a_end[of_a] == b_end[of_b]
    return Links(of_a, of_b, np.sort(of_a[closing]), np.sort(of_b[closing]))


def decimals(most: int) -> pa.Array:
    """All ids as decimal digits with a comma behind them, then all with a bar, then all with a semicolon."""
    return pa.array([f"{i}{sign}".encode() for sign in ",|;" for i in range(most)], pa.large_binary())


def write_groups(a_ids, b_ids, links: Links, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes ``a1,a2|b1;a3|b2,b3;`` of all groups, and where each group ends. ``names``: as of ``decimals``."""
    n_a, n_b = np.diff(links.a_last, prepend=-1), np.diff(links.b_last, prepend=-1)
    at_a = np.arange(len(a_ids)) + np.repeat(links.b_last + 1 - n_b, n_a)
    at_b = np.arange(len(b_ids)) + np.repeat(links.a_last + 1, n_b)
    ids = np.empty(len(at_a) + len(at_b), np.int64)
    ids[at_a], ids[at_b] = a_ids, b_ids
    ids[at_a[links.a_last]] += len(names) // 3
    ids[at_b[links.b_last]] += 2 * (len(names) // 3)
    written, ends = taken(names, ids)
    return written, ends[at_b[links.b_last]]


def _rows_of(batch, cuts: bool = True):
    """(texts, last): the blocks of a batch; of a very long text, if both vocabularies let it be cut, a part each."""
    texts = plain_text(batch.column("text"))
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()),
                        pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
    if not cuts or len(spaced) > 1 or not len(spaced) or len(raw := spaced[0].as_py().encode()) <= 2 * BLOCK_BYTES:
        return [(spaced, True)]
    parts, begin = [], 0
    while begin < len(raw):
        cut = _BETWEEN_WORDS.search(raw, begin + BLOCK_BYTES)
        end = cut.start() if cut else len(raw)
        parts.append((pa.array([raw[begin:end].decode()], pa.large_string()), end == len(raw)))
        begin = end
    return parts


def _blocks(byte_bpe, pieces, keep_groups):
    def run(batches):
        a_side, b_side = plain_encoder(PlainEncoder, byte_bpe), plain_encoder(PieceEncoder, pieces)
        names = decimals(max(len(a_side.pieces), len(b_side.pieces)))
        number = TaskContext.get().partitionId() << 32
        for batch in bounded(batches, "text", BLOCK_BYTES):
            parts = _rows_of(batch, b_side.cuts)
            if len(parts) > 1 and not all(side.encode_checked(t)[2].all() for t, _ in parts for side in (a_side, b_side)):
                parts = [(pa.array([""], pa.large_string()), True)]
            digest = hashlib.sha256()
            for texts, last in parts:
                a_ids, a_at, a_same = a_side.encode_checked(texts)
                b_ids, b_at, b_same = b_side.encode_checked(texts)
                if not (same := a_same & b_same).all():
                    texts = pc.if_else(pa.array(same), texts, pa.scalar("", pa.large_string()))
                    (a_ids, a_at), (b_ids, b_at) = a_side.encode(texts), b_side.encode(texts)
                n_a, n_b, n = np.diff(a_at), np.diff(b_at), len(texts)
                a_text, b_text = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
                a_end, b_end = np.cumsum(a_side.sizes[a_ids]), np.cumsum(b_side.sizes[b_ids])
                links = overlaps(a_text, a_end, b_text, b_end)
                code, pairs = pd.factorize(a_ids[links.a].astype(np.int64) << 32 | b_ids[links.b].astype(np.int64))
                groups = np.concatenate([[0], np.cumsum(np.bincount(a_text[links.a_last], minlength=n))])
                written, ends = write_groups(a_ids, b_ids, links, names)
                edge = np.concatenate([[0], ends])[groups]
                named, spelled = [], []
                for i in range(n):
                    whole = written[edge[i]:edge[i + 1]].tobytes()
                    if keep_groups:
                        spelled.append(whole.decode())
                    # A text that goes on keeps the sign after its last group.
                    digest.update(whole[:-1] if last else whole)
                    named.append(digest.hexdigest() if last and n_a[i] else "" if last else None)
                    digest = hashlib.sha256() if last else digest
                columns = {
                    "block": pa.array([number], pa.int64()),
                    **{k: pa.array([batch.column(k).to_pylist()], pa.list_(batch.column(k).type)) for k in ("row", "doc_id")},
                    **{k: pa.array([v], pa.list_(pa.int64())) for k, v in (("n_a", n_a), ("n_b", n_b), ("n_groups", np.diff(groups)))},
                    "digest": pa.array([named], pa.list_(pa.string())),
                    "pairs": pa.array([pairs], pa.list_(pa.int64())),
                    "times": pa.array([np.bincount(code, minlength=len(pairs))], pa.list_(pa.int64())),
                    "links": pa.array([code.astype("<u2" if len(pairs) <= 1 << 16 else "<u4").tobytes()], pa.binary()),
                }
                if keep_groups:
                    columns["groups"] = pa.array([spelled], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])
                number += 1
        a_side.forget()
        b_side.forget()
    return run


def align_blocks(docs: DataFrame, byte_bpe: str, pieces: str, keep_groups: bool = False) -> DataFrame:
    """One row per block of texts, written: its rows' token counts and digests, the distinct id pairs
    ``a << 32 | b`` with the number of links that have each, and the pair of every link."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, row array<long>, doc_id array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, "
        "digest array<string>, pairs array<long>, times array<long>, links binary" + (", groups array<string>" if keep_groups else "")
    )
    return stage(arrow_map(rows, _blocks(byte_bpe, pieces, keep_groups), schema), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, a_id, b_id, times (links over all blocks that have it) and best: no other pair of its B id has more.

    The highest count of each B id is a table no larger than the vocabulary.
    """
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    counts = counts.agg(F.sum("x.times").alias("times")).select(
        "pair", F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id"), "times")
    counts = stage(counts, "pair-counts")
    most = counts.groupBy("b_id").agg(F.max("times").alias("most"))
    return counts.join(F.broadcast(most), "b_id").select("pair", "a_id", "b_id", "times", (F.col("times") == F.col("most")).alias("best"))


def _sums(table):
    """table: (sorted pairs, values) or None if each block brings the values of its pairs. A value is twice the count, and one if it is best."""
    def run(batches):
        known = table.value if table is not None else None
        for batch in batches:
            for r in batch.to_pylist():
                pairs = np.array(r["pairs"], np.int64)
                value = np.array(r["value"], np.int64) if known is None else known[1][np.searchsorted(known[0], pairs)]
                code = np.frombuffer(r["links"], "<u2" if len(pairs) <= 1 << 16 else "<u4")
                n_a, n_b, n_groups = (np.array(r[k], np.int64) for k in ("n_a", "n_b", "n_groups"))
                half, out = int(n_a.sum()), {}
                for name, of_pair in (("n_best", value & 1), ("count_sum", value >> 1)):
                    of_link, total = of_pair[code], 0
                    for part, sizes in ((of_link[:half], n_a), (of_link[half:], n_b - n_groups)):
                        run_ = np.concatenate([[0], np.cumsum(part)])[np.concatenate([[0], np.cumsum(sizes)])]
                        total = total + np.diff(run_)
                    out[name] = pa.array(total, pa.int64())
                columns = {k: batch.schema.field(k).type.value_type for k in ("row", "doc_id", "digest")}
                columns = {k: pa.array(r[k], kind) for k, kind in columns.items()}
                columns |= {"n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_a + n_b - n_groups)}
                columns = {"block": pa.array([r["block"]] * len(n_a), pa.int64())} | columns | out
                if "groups" in r:
                    columns["groups"] = pa.array(r["groups"], pa.string())
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])
    return run


def align_tokens(
    docs: DataFrame, byte_bpe: str, pieces: str, keep_groups: bool = False, pair_table_bytes: int = PAIR_TABLE_BYTES
) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_bpe``: a byte-level vocabulary of the tokenizers library (A); ``pieces``: a model of the
    sentencepiece library (B). A link is a pair of an A and a B token that share a byte; its count
    is how many links of all rows have its two ids. ``n_best``: links whose count is the highest of
    their B id, ties included; ``count_sum``: over a row's links. ``groups_sha256``: of the groups
    written as ``a1,a2|b1;a3|b2,b3``, which ``keep_groups`` adds as ``groups``.

    A null or empty text, or one that a vocabulary can't spell (U+2581, which B takes for a blank),
    has no tokens: zeros and an empty digest. Repeated rows count each time; other columns are left
    out; no rows give none. A text of any length is aligned in parts of about ``BLOCK_BYTES``.

    Up to ``pair_table_bytes`` of pair counts go to all tasks; beyond that each block's distinct
    pairs are joined with them.
    """
    blocks = align_blocks(docs, byte_bpe, pieces, keep_groups)
    value = (F.col("times") * 2 + F.col("best").cast("long")).alias("value")
    counts = stage(pair_counts(blocks).select("pair", value), "pair-values")
    needed = blocks.drop("times")
    if counts.count() * 16 <= pair_table_bytes:
        known = counts.toArrow()
        pair, value = (known[k].to_numpy() for k in ("pair", "value"))
        order = np.argsort(pair)
        table = docs.sparkSession.sparkContext.broadcast((pair[order], value[order]))
    else:
        table = None
        seen = blocks.select("block", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
        seen = seen.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("seen"))
        needed = needed.join(seen.select("block", F.col("seen.value").alias("value")), "block", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, row long, doc_id {kind}, digest string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
    parts = arrow_map(needed, _sums(table), schema + (", groups string" if keep_groups else ""))
    total = parts.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.max("digest").alias("groups_sha256"),
        *([F.array_join(F.array_sort(F.collect_list(F.struct("block", "groups")))["groups"], "").alias("groups")] if keep_groups else []),
    )
    if keep_groups:
        total = total.withColumn("groups", F.substring("groups", F.lit(1), F.length("groups") - 1))
    return total.drop("row")
