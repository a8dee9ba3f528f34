"""Near-duplicate documents by 64-bit SimHash fingerprints and multi-index hashing."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, bounded, plain_text
from tillmart.llm.frames import named_columns, numbered_columns
from tillmart.workspace import stage

DISTANCE = 3
BUCKET_ROWS = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ROWS = 1 << 17


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text: a bit is set if more than half of the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = len(words) - shingle + 1
    # A few shingles at a time, so that a very long text takes no more memory than others.
    counts, total = np.zeros(64, np.int64), max(n, 1)
    for a in range(0, total, _ROWS):
        if n <= 1:
            parts = [words]
        else:
            part = words[a:min(a + _ROWS, n) + shingle - 1]
            parts = zip(*(part[i:len(part) - shingle + 1 + i] for i in range(shingle)))
        hashes = np.array([xxh64_intdigest(b" ".join(p), 42) for p in parts], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in bounded(batches, "text"):
        texts = plain_text(batch.column("text")).to_pylist()
        found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [c for n, c in zip(batch.schema.names, batch.columns) if n != "text"] + [pa.array(found)],
            [n for n in batch.schema.names if n != "text"] + ["fp"],
        )


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of each row and ``fp``, the fingerprint's bits as a long. Null text has no words."""
    rows = docs.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return arrow_map(rows, _fingerprints, f"{kinds}, fp long")


def _probes(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(home, guest) rows of the two tables of 32-bit segments.

    Three differing bits leave at most one in one of the two segments, so a segment's ball of
    radius one finds every link. Of two segments that differ in one bit, one lacks it: setting
    each missing bit enumerates enough of the ball.
    """
    low, high = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("fp", 32)
    segments = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), low.alias("value")), F.struct(F.lit(1).alias("side"), high.alias("value"))
    )).alias("s")).select("fp", (F.col("s.side") * F.lit(1 << 32) + F.col("s.value")).alias("bucket"))
    bits = F.array(*[F.lit(1 << b) for b in range(32)])
    unset = F.filter(bits, lambda b: F.col("bucket").bitwiseAND(b) == 0)
    guests = segments.select("fp", "bucket", F.explode(unset).alias("bit")).select("fp", (F.col("bucket") + F.col("bit")).alias("bucket"))
    return segments, guests


def spanning_links(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the graph "at most ``distance`` differing bits" joins, one less than
    members in each component. A member takes all that it reaches out of the search at once."""
    left, a, b = np.unique(fps), [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(left ^ front[0]) <= distance
            reached = left[near]
            a.append(np.full(len(reached), front[0]))
            b.append(reached)
            left, front = left[~near], np.concatenate([front[1:], reached])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, fps.dtype)
    return join(a), join(b)


def _link_buckets(distance):
    def link(batches):
        """Rows come ordered by bucket and cell; a bucket's rows may run over batches."""
        held, last = [], None

        def out(parts):
            a, b = spanning_links(np.concatenate(parts).view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(n).to_numpy() for n in ("bucket", "cell")], 1)
            fps = batch.column("fp").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
            a, b = [], []
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                key = tuple(keys[i].tolist())
                if key != last and held:
                    yield out(held)
                    held = []
                last = key
                if i == 0 or j == len(keys):
                    held.append(fps[i:j])
                elif j - i == 2:
                    a.append(fps[i:i + 1])
                    b.append(fps[i + 1:j])
                else:
                    x, y = spanning_links(fps[i:j].view(np.uint64), distance)
                    a.append(x.view(np.int64))
                    b.append(y.view(np.int64))
                if j < len(keys):
                    yield from (out(h) for h in [held] if held)
                    held = []
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
                yield pa.RecordBatch.from_arrays([pa.array(a[near]), pa.array(b[near])], ["a", "b"])
        if held:
            yield out(held)
    return link


def links(fps: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all that are linked.

    Guests whose bucket has no home are left behind by a join; what remains is searched bucket by
    bucket, where only as many links leave as there are members. A bucket of more than
    ``bucket_rows`` is split: every two of its parts meet in a cell of their own.
    """
    homes, guests = _probes(fps)
    home_keys = homes.groupBy("bucket").agg(F.count(F.lit(1)).alias("homes"))
    visits = stage(guests.join(home_keys.select("bucket"), "bucket", "left_semi"), "guests")
    met = homes.join(
        home_keys.where("homes > 1").select("bucket").unionByName(visits.select("bucket")).distinct(), "bucket", "left_semi"
    )
    members = stage(met.select("bucket", "fp").unionByName(visits.select("bucket", "fp")), "bucket-members")
    parts = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("parts")).where("parts > 1")
    split = members.join(parts, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
    cells = split.withColumn("own", own).withColumn("other", other).select(
        "bucket", (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).alias("cell"), "fp"
    )
    ordered = cells.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
    return arrow_map(ordered, _link_buckets(distance), "a long, b long")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node it is joined to.

    Each round points every node's larger neighbours at its smallest one and then the node itself
    (large and small stars); the rounds grow with the logarithm of the longest path. Each round
    is a written table.
    """
    def both(e):
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    nodes = None
    for _ in range(most_rounds):
        around = both(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a")
        small = small.select(F.col("b").alias("x"), "m").unionByName(small.select(F.col("a").alias("x"), "m"))
        after = stage(small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "links")
        state = [e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for e in (edges, after)]
        edges = after
        if state[0] == state[1]:
            nodes = edges
            break
    if nodes is None:
        raise RuntimeError(f"components need more than {most_rounds} rounds")
    roots = nodes.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(nodes.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicate_groups(prints: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, root) of every distinct fingerprint: equal roots are joined by links."""
    distinct = stage(prints.select("fp").distinct(), "distinct-fingerprints")
    found = stage(components(links(distinct, distance, bucket_rows)), "components")
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs`` (doc_id, text).

    component_id: the smallest doc_id joined to the row by links, its own included; null only if
    no joined row has a doc_id. Texts without words (null, empty, blanks) have fingerprint zero and
    link like any other. Repeated rows are kept; other columns are left out; no rows give none.
    """
    prints = stage(fingerprints(docs, ["doc_id"]), "fingerprints")
    groups = stage(near_duplicate_groups(prints, distance, bucket_rows), "groups")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(groups, "fp")
    first = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stage(groups.join(first, "root").select("fp", "component_id"), "component-ids")
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS, broadcast_bytes: int = 32 * 1024 * 1024
) -> DataFrame:
    """The row with the smallest doc_id of each component, null ids last; of several such the first as stored.

    The rows are written once with a number each, which names the rows to drop.
    """
    inner, at = numbered_columns(docs)
    rows = stage(inner.withColumn("row", F.monotonically_increasing_id()), "numbered-rows")
    ids = rows.select("row", F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text"))
    prints = stage(fingerprints(ids, ["row", "doc_id"]), "fingerprints")
    groups = near_duplicate_groups(prints, distance, bucket_rows)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = stage(groups, "groups")
    best = prints.groupBy("fp").agg(F.min(order).alias("o")).join(groups, "fp").groupBy("root").agg(F.min("o").alias("o"))
    best = stage(groups.join(best, "root").select("fp", F.col("o.row").alias("best")), "best-rows")
    extra = stage(prints.join(best, "fp").where("row <> best").select("row"), "extra-rows")
    # Copies are fewer than rows: while they are few enough to be sent to all tasks, no text is shuffled.
    extra = F.broadcast(extra) if extra.count() * 24 <= broadcast_bytes else extra.hint("merge")
    return named_columns(rows.join(extra, "row", "left_anti"), at)
