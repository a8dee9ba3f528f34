"""Exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it. The index is a written table
of blocks: vectors of one pivot between two distances, an annulus. A search begins in the annuli
that hold the query, goes on to those around it and ends with all that the triangle inequality
can't rule out: from a pivot p, a vector x is at least |d(q,p) - d(x,p)| away from the query q, so its
inner product is at most (q.q + x.x - (d(q,p) - d(x,p))^2) / 2.
"""

from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.blocks import arrow_map, give_back
from tillmart.workspace import stage

SCALE = 1024
PIVOTS = 64
SAMPLE_ROWS = 2048
BLOCK_ROWS = 1024
WAVE_BYTES = 16 * 1024 * 1024
_TILE = 512
_PENDING = 20_000
_NO_SCORE = np.iinfo(np.int64).min
# Beyond rounding errors of squared distances, and of their roots.
_SLACK = 1e-6

#: rows: of each query in the index; starts: dimension -> numbers of its queries; vectors: dimension -> matrix; pivot, dist: as in the index; floor: score to reach; ring: (gap above which, gap up to which) annuli are searched
Wave = namedtuple("Wave", "rows numbers vectors pivot dist floor ring pivots k")
#: first: number of a dimension's first pivot; points: matrix
Pivots = namedtuple("Pivots", "first points")


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vectors`` (vec_id, embedding) with components floor(scale * x) as ``v``; those that take no part are left out."""
    x = F.col("embedding").cast("array<double>")
    bounded = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) * scale < 2.0**31))
    squares = F.aggregate(x, F.lit(0.0), lambda s, e: s + (e * scale) * (e * scale))
    whole = F.transform(x, lambda e: F.floor(e * scale).cast("int"))
    return vectors.where(x.isNotNull() & F.coalesce(bounded, F.lit(True)) & (F.coalesce(squares, F.lit(0.0)) < 2.0**61)).select("vec_id", whole.alias("v"))


def choose_pivots(whole: DataFrame, pivots: int = PIVOTS, sample_rows: int = SAMPLE_ROWS) -> dict[int, Pivots]:
    """By dimension: from the ``sample_rows`` vectors of the least hashes, each farthest from those before it."""
    rows = whole.select("v").orderBy(F.xxhash64("v"), "v").limit(sample_rows).toArrow().column("v").to_pylist()
    out, first = {}, 0
    for dim in sorted({len(v) for v in rows} - {0}):
        sample = np.unique(np.array([v for v in rows if len(v) == dim], np.float64), axis=0)
        chosen, least = [0], ((sample - sample[0]) ** 2).sum(1)
        while len(chosen) < pivots and least.max(initial=0) > 0:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        out[dim] = Pivots(first, sample[chosen])
        first += len(chosen)
    return out


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """(vector, pivot)"""
    squares = (x * x).sum(1)[:, None] + (points * points).sum(1) - 2 * (x @ points.T)
    return np.sqrt(np.maximum(squares, 0))


def _of_dimension(pivots, dim):
    """A dimension that no sampled vector has is measured from its origin."""
    return pivots.get(dim) or Pivots(-1 - dim, np.zeros((1, dim)))


def _lists(column):
    """Of a column of int lists: their lengths, and all components one after the other."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy().astype(np.int64)
    return np.diff(ends), column.values.to_numpy()[ends[0]:ends[-1]] if len(ends) > 1 else np.zeros(0, np.int32)


def _by_dimension(column):
    """dimension -> (places in the column, matrix)"""
    dims, flat = _lists(column)
    owner = np.repeat(dims, dims)
    return {int(d): ((at := np.flatnonzero(dims == d)), flat[owner == d].reshape(len(at), d)) for d in np.unique(dims)}


def _key(shared):
    def key(batches):
        for batch in batches:
            pivot, dist = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for dim, (at, x) in _by_dimension(batch.column("v")).items():
                own = _of_dimension(shared.value, dim)
                away = _distances(x.astype(np.float64), own.points)
                near = away.argmin(1)
                pivot[at], dist[at] = own.first + near, away[np.arange(len(at)), near]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(dist)], [*batch.schema.names, "pivot", "dist"])
    return key


def _pack(batches):
    """Blocks of rows that come ordered by pivot and distance."""
    held = None

    def block(rows):
        dims, flat = _lists(rows["v"])
        vectors = flat.reshape(len(dims), dims[0])
        dist, own = rows["dist"].to_numpy(), rows["row"].to_numpy()
        ids = rows["vec_id"].fill_null(0).to_numpy().astype(np.int64)
        no_id = rows["vec_id"].is_null().to_numpy(zero_copy_only=False)
        # The place of each row among the equal vectors of the block, by id.
        _, group = np.unique(vectors, axis=0, return_inverse=True) if vectors.shape[1] else (None, np.zeros(len(own), np.int64))
        order = np.lexsort((own, ids, no_id, group.ravel()))
        begins = np.searchsorted(group.ravel()[order], group.ravel()[order])
        copy = np.empty(len(own), "<u4")
        copy[order] = np.arange(len(own)) - begins
        squares = (vectors.astype(np.float64) ** 2).sum(1)
        fields = {
            "dim": pa.array([vectors.shape[1]], pa.int32()), "pivot": pa.array([rows["pivot"][0].as_py()], pa.int32()),
            "low": pa.array([dist[0]]), "high": pa.array([dist[-1]]), "most": pa.array([squares.max()]),
        }
        fields |= {name: pa.array([values.tobytes()], pa.binary()) for name, values in (
            ("dist", dist), ("row", own), ("id", ids), ("no_id", no_id), ("copy", copy), ("v", vectors.astype("<i4")))}
        return pa.RecordBatch.from_arrays([*fields.values()], [*fields])

    for batch in batches:
        rows = pa.Table.from_batches([batch]).combine_chunks()
        held = pa.concat_tables([held, rows]).combine_chunks() if held is not None and held.num_rows else rows
        pivot = held["pivot"].to_numpy()
        begin, edges = 0, [*(np.flatnonzero(np.diff(pivot)) + 1).tolist()]
        for edge in [*edges, None]:
            end = held.num_rows if edge is None else edge
            while end - begin >= BLOCK_ROWS or (edge is not None and end > begin):
                take = min(BLOCK_ROWS, end - begin)
                yield block(held.slice(begin, take).combine_chunks().to_batches()[0])
                begin += take
        held = held.slice(begin)
    if held is not None and held.num_rows:
        yield block(held.combine_chunks().to_batches()[0])


_BLOCK = "dim int, pivot int, low double, high double, most double, dist binary, row binary, id binary, no_id binary, copy binary, v binary"


def keyed_vectors(whole: DataFrame, pivots: dict[int, Pivots]) -> DataFrame:
    """``whole`` with a number for each row, its nearest pivot and the distance from it, written."""
    rows = whole.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "v")
    shared = whole.sparkSession.sparkContext.broadcast(pivots)
    return stage(arrow_map(rows, _key(shared), "row long, vec_id long, v array<int>, pivot int, dist double"), "keyed-vectors")


def build_index(keyed: DataFrame) -> DataFrame:
    """The blocks, written. Ranges of (pivot, distance, row) split a pivot of any number of rows."""
    ordered = keyed.repartitionByRange("pivot", "dist", "row").sortWithinPartitions("pivot", "dist", "row")
    return stage(arrow_map(ordered, _pack, _BLOCK), "pivot-distance-index")


def _keep_best(best, k):
    """Of hits (query, score, no_id, id, row) the k first of each query, and each one's place."""
    query, score, no_id, id_, row = best
    order = np.lexsort((row, id_, no_id, -score, query))
    best = [x[order] for x in best]
    place = np.arange(len(order)) - np.searchsorted(best[0], best[0])
    return [x[place < k] for x in best], place[place < k]


def _search(shared):
    def search(batches):
        w = shared.value
        floor, best, pending = w.floor.copy(), [np.zeros(0, np.int64) for _ in range(5)], []
        own, squares, away = {}, {}, {}
        for dim, x in w.vectors.items():
            own[dim] = _of_dimension(w.pivots, dim)
            exact = x.astype(np.float64)
            squares[dim], away[dim] = (exact * exact).sum(1), _distances(exact, own[dim].points)

        def settle():
            nonlocal best, pending
            best, place = _keep_best([np.concatenate(x) for x in zip(best, *pending)], w.k)
            full = place == w.k - 1
            floor[best[0][full]] = np.maximum(floor[best[0][full]], best[1][full])
            pending = []

        for batch in batches:
            for b in batch.to_pylist():
                dim = b["dim"]
                if dim not in w.vectors:
                    continue
                numbers, q2 = w.numbers[dim], squares[dim]
                d = away[dim][:, b["pivot"] - own[dim].first]
                home = (w.pivot[numbers] == b["pivot"]) & (b["low"] <= w.dist[numbers]) & (w.dist[numbers] <= b["high"])
                if w.ring is None:
                    wanted = home
                else:
                    slack = _SLACK * (np.sqrt(q2) + np.sqrt(b["most"]) + d)
                    gap = np.maximum(np.maximum(b["low"] - d, d - b["high"]) - slack, 0)
                    wanted = ~home & (gap > w.ring[0][numbers]) & (gap <= w.ring[1][numbers])
                    wanted &= gap * gap <= _reach(q2, b["most"], floor[numbers])
                if not wanted.any():
                    continue
                dist, row, id_ = (np.frombuffer(b[n], t) for n, t in (("dist", "<f8"), ("row", "<i8"), ("id", "<i8")))
                no_id = np.frombuffer(b["no_id"], bool)
                # Of equal vectors only the first k + 1 can be among the k best, the query's own row not counted.
                used = np.frombuffer(b["copy"], "<u4") <= w.k
                x = np.frombuffer(b["v"], "<i4").reshape(len(row), dim)
                todo = np.flatnonzero(wanted)
                todo = todo[np.argsort(d[todo], kind="stable")]
                for i in range(0, len(todo), _TILE):
                    tile = todo[i:i + _TILE]
                    n = numbers[tile]
                    far = np.sqrt(_reach(q2[tile], b["most"], floor[n])) + _SLACK * (np.sqrt(q2[tile]) + np.sqrt(b["most"]) + d[tile])
                    low, high = np.searchsorted(dist, (d[tile] - far).min()), np.searchsorted(dist, (d[tile] + far).max(), "right")
                    at = low + np.flatnonzero(used[low:high])
                    if not len(at):
                        continue
                    if float(q2[tile].max()) * b["most"] < 2.0**104:
                        # Whole numbers below 2^53 all along: exact.
                        score = (w.vectors[dim][tile].astype(np.float64) @ x[at].T.astype(np.float64)).astype(np.int64)
                    else:
                        score = w.vectors[dim][tile].astype(np.int64) @ x[at].T.astype(np.int64)
                    query, place = np.nonzero(score >= floor[n][:, None])
                    hit = at[place]
                    other = row[hit] != w.rows[n[query]]
                    query, place, hit = query[other], place[other], hit[other]
                    pending.append([n[query], score[query, place], no_id[hit].astype(np.int64), id_[hit], row[hit]])
                    if sum(len(p[0]) for p in pending) > max(_PENDING, len(best[0])):
                        settle()
        settle()
        query, score, no_id, id_, row = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(w.rows[query]), pa.array(score), pa.array(id_, mask=no_id.astype(bool)), pa.array(row)], ["query", "score", "vec_id", "row"])
        give_back()
    return search


def _reach(q2, most, floor):
    """Squared distance at which a vector can still have the score ``floor``; infinite if there is none yet."""
    reach = q2 + most - 2 * floor.astype(np.float64)
    return np.where(floor == _NO_SCORE, np.inf, np.maximum(reach, 0) + _SLACK * (q2 + most))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").isNull(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_wave(index: DataFrame, queries: pa.Table, pivots: dict[int, Pivots], most: float, k: int) -> DataFrame:
    """The k best of each query, in three rounds that expand from the query's own annuli."""
    spark = index.sparkSession
    rows = queries.column("row").to_numpy()
    by_dim = _by_dimension(queries.column("v"))
    squares = np.zeros(len(rows))
    for at, x in by_dim.values():
        squares[at] = (x.astype(np.float64) ** 2).sum(1)
    wave = Wave(
        rows, {dim: at for dim, (at, _) in by_dim.items()}, {dim: x for dim, (_, x) in by_dim.items()}, queries.column("pivot").to_numpy(),
        queries.column("dist").to_numpy(), np.full(len(rows), _NO_SCORE), None, pivots, k,
    )
    best, number, least = None, np.argsort(rows), np.full(len(rows), -1.0)
    for part in (None, 0.25, 1.0):
        if part is not None:
            upto = np.full(len(rows), np.inf) if part == 1 else part * np.sqrt(_reach(squares, most, wave.floor))
            wave = wave._replace(ring=(least, upto))
            least = upto
        found = arrow_map(index, _search(spark.sparkContext.broadcast(wave)), "query long, score long, vec_id long, row long")
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = stage(_best(found, k), "best-vectors")
        full = best.where(F.col("rank") == k).select("query", "score").toArrow()
        floor = wave.floor.copy()
        floor[number[np.searchsorted(rows, full.column("query").to_numpy(), sorter=number)]] = full.column("score").to_numpy()
        wave = wave._replace(floor=floor)
    return best


def top_k(
    vectors: DataFrame, is_query: Column | str, k: int = 10, scale: int = SCALE, pivots: int = PIVOTS,
    sample_rows: int = SAMPLE_ROWS, wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, embedding) for which
    ``is_query`` (of vec_id) holds, the k other rows of the highest inner products, fewer if there are fewer.

    Components count as floor(scale * x), so scores are whole and exact. Ties go to the smaller
    vec_id, a null one last. A vector that is null or holds a null or a non-finite component takes no
    part, nor does one whose squared length, so scaled, passes 2^61 or a component 2^31, as its scores
    may not fit 64 bits. Vectors are compared with those of their own dimension only. Rows with equal
    vec_id are rows of their own; other columns are left out; no rows give none.

    Pivots come from ``sample_rows`` rows; every row is indexed. Queries are taken in waves of
    ``wave_bytes``, which go to all tasks; with each the index is read three times.
    """
    whole = whole_vectors(vectors, scale)
    chosen = choose_pivots(whole, pivots, sample_rows)
    keyed = keyed_vectors(whole, chosen)
    index = build_index(keyed)
    queries = keyed.where(is_query)
    size, most = queries.agg(F.sum(4 * F.size("v") + 32)).first()[0] or 0, index.agg(F.max("most")).first()[0] or 0.0
    waves = -(-size // wave_bytes)
    out = None
    for i in range(waves):
        own = queries.where(F.pmod(F.xxhash64("row"), F.lit(waves)) == i).select("row", "v", "pivot", "dist").toArrow()
        if own.num_rows:
            best = _search_wave(index, own, chosen, most, k)
            out = best if out is None else out.unionByName(best)
    if out is None:
        return queries.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    names = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return out.join(names, "query").select("query_id", "rank", "vec_id", "score")
