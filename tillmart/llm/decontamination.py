"""Benchmark passages in training documents, found in a positional inverted index.

The index is a written table: one row per shard of documents, with the ascending positions of
every test term. A search takes a phrase's postings from its rarest term on, shifts each list by
the term's place in the phrase and keeps the places where all lists meet: exactly, or each within
a few words (proximity).
"""

from collections import namedtuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, give_back, text_buffers
from tillmart.llm.frames import named_columns, numbered_columns
from tillmart.llm.words import LETTERS_AND_DIGITS
from tillmart.workspace import stage

WINDOW = 13
SLOP = 2
TEST_BYTES = 32 * 1024 * 1024
SHARD_BYTES = 2 * 1024 * 1024
_CANDIDATES = 500_000

#: words: distinct test words; windows: their numbers, -1 after the end of a short phrase; items: of each window
TestSet = namedtuple("TestSet", "words windows items window slop")


def words_of(text: str | None) -> list[str]:
    """Maximal runs of ASCII letters and digits and of whatever lies beyond ASCII; A-Z lower-cased."""
    return (text or "").encode().translate(LETTERS_AND_DIGITS).decode().split(" ") if text else []


def test_set(rows, window: int = WINDOW, slop: int = SLOP) -> TestSet:
    """From (item_id, text) rows: all runs of ``window`` words of each item, or the whole shorter item."""
    numbers, windows, items = {}, [], []
    for item, text in rows:
        words = [numbers.setdefault(w, len(numbers)) for w in words_of(text) if w]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i:i + window]
            windows.append(part + [-1] * (window - len(part)))
            items.append(None if item is None else str(item))
    shape = np.array(windows, np.int32).reshape(-1, window)
    return TestSet(list(numbers), shape, items, window, slop)


def _gap(test: TestSet) -> int:
    return test.window + 2 * test.slop + 1


def _index(test):
    def build(batches):
        known, gap = pa.array(test.value.words, pa.large_string()), _gap(test.value)
        for batch in bounded(batches, "text", SHARD_BYTES):
            offsets, data = text_buffers(batch.column("text"))
            lowered = pa.py_buffer(data.to_pybytes().translate(LETTERS_AND_DIGITS))
            texts = pa.Array.from_buffers(pa.large_string(), batch.num_rows, [None, pa.py_buffer(np.ascontiguousarray(offsets)), lowered])
            split = pc.split_pattern(texts, " ")
            bounds = split.offsets.to_numpy().astype(np.int64)
            values = split.flatten()
            word = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
            count = np.concatenate([[0], np.cumsum(word)])
            n_words = np.diff(count[bounds])
            # Positions run through the shard, with a gap after each document.
            code = pc.fill_null(pc.index_in(values, value_set=known), -1).to_numpy()
            used = np.flatnonzero(word & (code >= 0))
            document = np.searchsorted(bounds, used, "right") - 1
            position = count[used] + document * gap
            span = int(count[-1]) + gap * (batch.num_rows + 1)
            postings = np.sort(code[used].astype(np.int64) * span + position)
            terms, counts = np.unique(postings // span, return_counts=True)
            digest = batch.column("digest") if "digest" in batch.schema.names else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(batch.column("doc_id").type)),
                pa.array([digest.to_pylist()], pa.list_(pa.string())),
                pa.array([n_words.astype("<i4").tobytes()]), pa.array([span], pa.int64()),
                pa.array([terms.astype("<i4").tobytes()]), pa.array([counts.astype("<i4").tobytes()]),
                pa.array([np.diff(postings % span, prepend=0).astype("<i4").tobytes()]),
            ], ["doc_ids", "digests", "n_words", "span", "terms", "counts", "positions"])
    return build


def matches(postings: np.ndarray, span: int, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, start, exact) of each place where all words of a window stand, at most ``slop`` off.

    ``postings``: ascending ``word * span + position``.
    """
    held = np.diff(np.searchsorted(postings, np.arange(len(test.words) + 1) * span))
    inside = test.windows >= 0
    frequency = np.where(inside, held[test.windows], np.iinfo(np.int64).max) if len(held) else np.zeros(test.windows.shape, np.int64)
    open_ = np.flatnonzero((frequency > 0).all(1))
    order = np.argsort(frequency[open_], axis=1, kind="stable")
    rarest = frequency[open_, order[:, 0]] if len(open_) else np.zeros(0, np.int64)
    group = (np.cumsum(rarest) - rarest) // _CANDIDATES
    found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)]
    for g in np.unique(group):
        mine = np.flatnonzero(group == g)
        found.append(_meet(postings, span, test, open_[mine], order[mine], rarest[mine]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _meet(postings, span, test, windows, order, rarest):
    first = np.searchsorted(postings, test.windows[windows, order[:, 0]].astype(np.int64) * span)
    ends = np.cumsum(rarest)
    row = np.repeat(np.arange(len(windows)), rarest)
    at = np.arange(len(row)) - np.repeat(ends - rarest, rarest) + first[row]
    start = postings[at] % span - order[row, 0]
    ok = start >= 0
    row, start = row[ok], start[ok]

    def stands(row, start, j, slop):
        """Does the j-th rarest word stand in its place? Yes past the end of a short window."""
        place = order[row, j]
        word = test.windows[windows[row], place].astype(np.int64)
        low = np.maximum(start + place - slop, 0) + word * span
        after = np.searchsorted(postings, low)
        hit = np.zeros(len(row), bool)
        real = after < len(postings)
        hit[real] = postings[after[real]] <= (start + place + slop + word * span)[real]
        return hit | (word < 0)

    for j in range(1, test.window):
        ok = stands(row, start, j, test.slop)
        row, start = row[ok], start[ok]
    exact = np.ones(len(row), bool)
    for j in range(1, test.window):
        exact &= stands(row, start, j, 0)
    return windows[row], start, exact


def _search(test, kind):
    def search(batches):
        spec = test.value
        sizes = (spec.windows >= 0).sum(1)
        names = np.array([x or "" for x in spec.items], object)
        named = np.array([x is not None for x in spec.items], bool)
        for batch in batches:
            for row in batch.to_pylist():
                span, n_words = row["span"], np.frombuffer(row["n_words"], "<i4").astype(np.int64)
                n = len(n_words)
                terms, counts = (np.frombuffer(row[x], "<i4").astype(np.int64) for x in ("terms", "counts"))
                position = np.cumsum(np.frombuffer(row["positions"], "<i4").astype(np.int64))
                window, start, exact = matches(np.repeat(terms * span, counts) + position, span, spec)
                base = np.cumsum(n_words) - n_words + _gap(spec) * np.arange(n)
                document = np.searchsorted(base, start, "right") - 1
                near = np.bincount(document, minlength=n)
                window, start, document = window[exact], start[exact], document[exact]
                edge = np.bincount(start, minlength=span + 1) - np.bincount(start + sizes[window], minlength=span + 1)
                hit = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0)
                begin, end = np.flatnonzero(hit > 0), np.flatnonzero(hit < 0)
                of = np.searchsorted(base, begin, "right") - 1
                flat = np.stack([begin - base[of], end - base[of]], 1).ravel().astype(np.int32)
                spans = pa.ListArray.from_arrays(pa.array(2 * np.searchsorted(of, np.arange(n + 1)), pa.int32()), pa.array(flat))
                keep = named[window]
                pairs = sorted({*zip(document[keep].tolist(), names[window[keep]].tolist())})
                owner = np.array([d for d, _ in pairs], np.int64)
                items = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array([i for _, i in pairs], pa.string())
                )
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], kind), pa.array(row["digests"], pa.string()), pa.array(n_words), spans, items, pa.array(near.astype(np.int64)),
                ], ["doc_id", "digest", "n_words", "spans", "items", "n_near"])
        give_back()
    return search


def _against(docs: DataFrame, rows, window: int, slop: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType
    test = docs.sparkSession.sparkContext.broadcast(test_set(rows, window, slop))
    index = stage(arrow_map(docs, 
        _index(test), f"doc_ids array<{kind.simpleString()}>, digests array<string>, n_words binary, span long, terms binary, counts binary, positions binary"
    ), "postings")
    arrow = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}[kind.simpleString()]
    return arrow_map(index, 
        _search(test, arrow), f"doc_id {kind.simpleString()}, digest string, n_words long, spans array<int>, items array<string>, n_near long"
    )


def find_passages(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP, test_bytes: int = TEST_BYTES
) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, spans, items, n_near.

    ``spans``: begin and end (exclusive) of each run of hit words, one after the other.
    ``items``: sorted ids, as strings, of the items of which a window occurs; a null item_id hits
    but isn't listed, a null or empty item text has no window. ``n_near``: places where a window's
    words stand at most ``slop`` words out of place, exact places included. Null text has no
    words. Repeated rows, null doc_ids and empty tables need no care; other columns are left out.

    Up to ``test_bytes`` of test text go to every executor at once. A larger test set is taken in
    blocks, each of them against all documents, and the blocks' spans are united.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // test_bytes) or 1
    if blocks == 1:
        return _against(rows, items.collect(), window, slop).drop("digest")
    rows = rows.withColumn("digest", F.md5("text"))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for b in range(blocks):
        part = _against(rows, items.where(block == b).collect(), window, slop).withColumn("block", F.lit(b))
        found = part if found is None else found.unionByName(part)
    # Rows with equal doc_id and text have equal results: they are united as one and repeated.
    united = found.groupBy("doc_id", "digest").agg(
        F.count_if(F.col("block") == 0).alias("copies"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.sum("n_near").alias("near"),
    )
    at = F.when(F.size("spans") > 0, F.sequence(F.lit(1), F.size("spans"), F.lit(2))).otherwise(F.array().cast("array<int>"))
    pairs = F.array_sort(F.transform(at, lambda i: F.named_struct(
        F.lit("a"), F.element_at("spans", i), F.lit("b"), F.element_at("spans", i + 1))))
    joined = F.aggregate(pairs, F.array().cast("array<int>"), lambda out, p: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1) >= p["a"]),
        F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(F.element_at(out, -1), p["b"]))),
    ).otherwise(F.concat(out, F.array(p["a"], p["b"]))))
    return united.select(
        "doc_id", "n_words", joined.alias("spans"), "items", (F.col("near") / F.col("copies")).cast("long").alias("n_near"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def judge_passages(found: DataFrame, share: int = 20) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated: a ``share``-th of the words or more is hit."""
    n_hit = F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda s, x: s + x
    )
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "n_near",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, share: int = 20, broadcast_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    The verdict depends on the text alone, so texts are named by their digests.
    """
    inner, names = numbered_columns(docs)
    text = F.col(names["text"]).cast("string")
    found = find_passages(inner.select(F.md5(text).alias("doc_id"), text.alias("text")), items)
    bad = stage(judge_passages(found, share).where("contaminated").select(F.col("doc_id").alias("digest")).distinct(), "contaminated")
    bad = F.broadcast(bad) if bad.count() * 64 <= broadcast_bytes else bad
    clean = inner.withColumn("digest", F.md5(text)).join(bad, "digest", "left_anti")
    return named_columns(clean, names)
