"""Exact top-k search by inner product with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it, the keys are range-partitioned, and each run of
block_rows vectors of one pivot is a block: an annulus around the pivot, or part of one. A directory, a table with one row a
block, has the least and the largest distance of its vectors from every pivot, and their largest norm. By the triangle
inequality a vector x of a block is no nearer to a query q than the largest of max(0, |qp| - hi_p, lo_p - |qp|) over the
pivots p, which bounds q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 from above; so does q.p + |q| hi_p for the block's own pivot.

A query first searches the annulus that it lies in, which gives a floor for its k-th score. The other annuli whose bound
reaches that floor are sorted by their bounds and visited in waves that grow by the factor widen; each wave raises the floor,
and a query stops when its next bound is below it, as then all that follow are. What is left out can't hold a
better score. Queries stream past a block's vectors, and past a page of the directory, so memory holds one block or page and
one batch of queries. How many of the possible visits were made is logged.

Pivots are fitted on at most sample vectors, those whose ids hash lowest; every vector is indexed and the results are exact.

Results for odd input: vectors that are null or hold null or non-finite components, and rows without an id, take no
part; only vectors of equal length are compared; a query's own id is never its candidate; a repeated id counts once,
with its best score; scores beyond 64 bits are clipped; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import ceil_div, hash_sample, materialize, release

_KEYED = "vec_id long, dim int, pivot int, dist double, norm2 double, vec binary"
_FOUND = "query_id long, vec_id long, score long"
_LIMIT = (1 << 63) - 1
log = logging.getLogger(__name__)


def _vectors(column: pa.Array, scale: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, floor(scale * x) as whole doubles) of the vectors that take part."""
    for k, v in enumerate(column):
        if v.is_valid:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            if np.isfinite(x).all():
                yield k, np.floor(scale * x)


def _pack(x: np.ndarray) -> bytes:
    return x.astype("<i4" if not len(x) or np.abs(x).max() < 2**31 else "<f8").tobytes()


def _unpack(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if len(data) == 4 * dim else "<f8").astype(np.float64)


def _far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """n rows of x at most, each the farthest from those before."""
    chosen, near = [0], np.full(len(x), np.inf)
    while len(chosen) < min(n, len(x)):
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        if near.max() == 0:
            break
        chosen.append(int(near.argmax()))
    return x[chosen]


def _centres(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres of a few rounds of k-means that begin far apart."""
    c = _far_apart(x, n)
    for _ in range(rounds):
        own = ((x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        c = np.array([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
    return c


def fit_pivots(vectors: DataFrame, scale: float, n_pivots: int, sample: int) -> dict[int, np.ndarray]:
    """Pivots by vector length."""
    rows = hash_sample(vectors.filter("embedding is not null"), sample, "vec_id").select("embedding").toArrow()
    by_dim: dict[int, list[np.ndarray]] = {}
    for _, x in _vectors(rows.column(0).combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.float64())), scale):
        by_dim.setdefault(len(x), []).append(x)
    return {dim: _centres(np.array(x), n_pivots) for dim, x in by_dim.items()}


def _key(pivots: dict[int, np.ndarray], scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for k, x in _vectors(batch.column(1), scale):
                centres = pivots.get(len(x), np.zeros((1, len(x))))
                far = np.sqrt(((centres - x) ** 2).sum(axis=1))
                near = int(far.argmin())
                out.append((ids[k], len(x), near, float(far[near]), float(x @ x), _pack(x)))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)], ["vec_id", "dim", "pivot", "dist", "norm2", "vec"])

    return run


def _far(pivots: dict[int, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Distances of x from the pivots of its length."""
    return np.sqrt(((pivots.get(len(x), np.zeros((1, len(x)))) - x) ** 2).sum(axis=1))


def _number(block_rows: int):
    """Rows are sorted by dim, pivot and dist; gives each its block, a number that no other partition gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block, kind, n = (context.partitionId() if context else 0) << 40, None, 0
        for batch in batches:
            out = []
            for own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if own != kind or n == block_rows:
                    block, kind, n = block + 1, own, 0
                n += 1
                out.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), *batch.columns], ["block", *batch.schema.names])

    return run


_ENTRY = "block long, dim int, pivot int, lo array<double>, hi array<double>, norm2 double"


def _describe(pivots: dict[int, np.ndarray]):
    """Directory entries of the parts of blocks in a partition. Rows: block, dim, pivot, norm2, vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries: dict[int, tuple] = {}
            for block, dim, pivot, norm2, vec in zip(*(c.to_pylist() for c in batch.columns)):
                far = _far(pivots, _unpack(vec, dim))
                old = entries.get(block)
                entries[block] = (block, dim, pivot, np.minimum(old[3], far) if old else far, np.maximum(old[4], far) if old else far, max(old[5], norm2) if old else norm2)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*entries.values())) or [()] * 6, kinds)], ["block", "dim", "pivot", "lo", "hi", "norm2"])

    return run


def _bounds(pivots: dict[int, np.ndarray]):
    """Rows are sorted by page, entries before queries: page, is_query, vec_id, dim, block, vec, floor, pivot, lo, hi, norm2. Gives each query's blocks of the page, but its own, whose bound reaches its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ready = None, [], None
        for batch in batches:
            out = []
            for page, is_query, vec_id, dim, block, vec, floor, pivot, lo, hi, norm2 in zip(*(c.to_pylist() for c in batch.columns)):
                if page != current:
                    current, held, ready = page, [], None
                if not is_query:
                    held.append((block, pivot, norm2, lo, hi))
                    continue
                if not held:
                    continue
                if ready is None:
                    ready = [np.array(c) for c in zip(*held)]
                blocks, own, most, low, high = ready
                x = _unpack(vec, dim)
                far, square = _far(pivots, x), float(x @ x)
                near = np.maximum(0, np.maximum(far - high, low - far)).max(axis=1)
                around = pivots.get(dim, np.zeros((1, dim)))[own] @ x + np.sqrt(square) * high[np.arange(len(own)), own]
                bound = np.minimum(np.minimum((square + most - near**2) / 2, np.sqrt(square * most)), around) + 1e-9 * (square + most) + 1
                reach = blocks != block
                if floor is not None:
                    reach &= bound >= floor
                out += [(vec_id, b, v) for b, v in zip(blocks[reach].tolist(), bound[reach].tolist())]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 3, kinds)], ["query_id", "block", "bound"])

    return run


def _scores(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Inner products, exact."""
    most = np.abs(queries).max(initial=0) * np.abs(block).max(initial=0) * queries.shape[1]
    if most < 2**53:
        return (queries @ block.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)  # Python's integers
    exact = whole(queries) @ whole(block).T
    return np.array([[max(-_LIMIT, min(_LIMIT, int(v))) for v in row] for row in exact], np.int64).reshape(len(queries), len(block))


def _top(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(id, score) of the k largest scores, ties to smaller ids, without own."""
    keep = ids != own
    scores, ids = scores[keep], ids[keep]
    if len(scores) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return list(zip(ids[order].tolist(), scores[order].tolist()))


def _search(k: int, chunk: int = 512):
    """Rows are sorted by block, then vectors before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}  # by length: ids and vectors of the block
        ready: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def answer(rows: list[tuple[int, int, bytes, int | None]]) -> list[tuple[int, int, int]]:
            found = []
            for dim in {d for _, d, _, _ in rows}:
                if dim not in held:
                    continue
                if dim not in ready:
                    ready[dim] = np.array([i for i, _ in held[dim]]), np.array([v for _, v in held[dim]])
                ids, block = ready[dim]
                own = [(q, _unpack(v, dim), floor) for q, d, v, floor in rows if d == dim]
                for at in range(0, len(own), chunk):
                    part = own[at : at + chunk]
                    for (q, _, floor), s in zip(part, _scores(np.array([v for _, v, _ in part]), block)):
                        found += [(q, i, v) for i, v in _top(s, ids, q, k) if floor is None or v >= floor]
            return found

        for batch in batches:
            blocks, kinds, ids, dims, vecs, floors = (c.to_pylist() for c in batch.columns)
            found, asked = [], []
            for b, is_query, i, dim, vec, floor in zip(blocks, kinds, ids, dims, vecs, floors):
                if b != current:
                    found += answer(asked)
                    asked, current, held, ready = [], b, {}, {}
                if is_query:
                    asked.append((i, dim, vec, floor))
                else:
                    held.setdefault(dim, []).append((i, _unpack(vec, dim)))
            found += answer(asked)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*found)) or [()] * 3], ["query_id", "vec_id", "score"])

    return run


def _visit(index: DataFrame, routed: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of every block, from the query's floor up, for each query routed to it. routed: block, vec_id, dim, vec, floor."""
    none = F.lit(None).cast("long").alias("floor")
    both = index.select("block", F.lit(0).alias("is_query"), "vec_id", "dim", "vec", none).union(routed.select("block", F.lit(1), "vec_id", "dim", "vec", "floor"))
    return both.repartition("block").sortWithinPartitions("block", "is_query").mapInArrow(_search(k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k)


def _routes(directory: DataFrame, queries: DataFrame, pivots: dict[int, np.ndarray], page_rows: int) -> DataFrame:
    """query_id, block, bound of the blocks that a query may have to visit. queries: vec_id, dim, block (its own), vec, floor."""
    paged = directory.withColumn("page", F.struct("dim", F.pmod(F.xxhash64("block"), F.lit(ceil_div(directory.count(), page_rows) or 1)).alias("at")))
    pages = paged.groupBy("dim").agg(F.collect_set("page").alias("pages"))  # one row a length; pages are few beside blocks
    none = lambda kind: F.lit(None).cast(kind)
    entries = paged.select("page", F.lit(0).alias("is_query"), none("long").alias("vec_id"), "dim", "block", none("binary").alias("vec"), none("long").alias("floor"), "pivot", "lo", "hi", "norm2")
    asked = queries.join(pages, "dim").select(F.explode("pages").alias("page"), F.lit(1), "vec_id", "dim", "block", "vec", "floor", none("int"), none("array<double>"), none("array<double>"), none("double"))
    both = entries.union(asked)
    return both.repartition("page").sortWithinPartitions("page", "is_query").withColumn("page", F.xxhash64("page")).mapInArrow(_bounds(pivots), "query_id long, block long, bound double")


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 10, scale: float = 1024.0, n_pivots: int = 32, sample: int = 4096, block_rows: int = 256, page_rows: int = 1024, widen: int = 8) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best inner products of floor(scale * x) for every query.

    vectors: vec_id, embedding. is_query: from the column vec_id, whether a row is a query. block_rows, page_rows: vectors of a block and
    entries of a page of the directory. widen: how much more blocks each wave visits than all before.
    """
    vectors = vectors.filter("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    parts = max(1, ceil_div(vectors.count(), 16 * block_rows))
    pivots = fit_pivots(vectors, scale, n_pivots, sample)
    order = ("dim", "pivot", "dist", "vec_id")
    keyed = vectors.mapInArrow(_key(pivots, scale), _KEYED).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    index = materialize(keyed.mapInArrow(_number(block_rows), f"block long, {_KEYED}"), "index")
    described = index.select("block", "dim", "pivot", "norm2", "vec").mapInArrow(_describe(pivots), _ENTRY)
    ends = [f(F.get(c, F.lit(j))) for c, f in (("lo", F.min), ("hi", F.max)) for j in range(n_pivots)]  # a block can lie in two batches
    merged = described.groupBy("block", "dim", "pivot").agg(F.array_compact(F.array(*ends[:n_pivots])).alias("lo"), F.array_compact(F.array(*ends[n_pivots:])).alias("hi"), F.max("norm2").alias("norm2"))
    directory = materialize(merged, "directory")
    queries = materialize(index.filter(is_query(F.col("vec_id"))).select("vec_id", "dim", "block", "vec").dropDuplicates(["vec_id", "vec"]), "queries")
    best = materialize(_best(_visit(index, queries.withColumn("floor", F.lit(None).cast("long")), k), k), "best")

    def asked() -> DataFrame:
        floors = best.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
        return queries.join(floors, queries.vec_id == floors.query_id, "left").select("vec_id", "dim", "block", "vec", "floor")

    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block"))
    routes = materialize(_routes(directory, asked(), pivots, page_rows).groupBy("query_id", "block").agg(F.max("bound").alias("bound")).withColumn("turn", turn), "routes")
    last, visits, upto = routes.agg(F.max("turn")).first()[0] or 0, 0, 1
    while upto <= last:
        wave = routes.filter((F.col("turn") >= upto) & (F.col("turn") < upto * widen))
        now = asked().select("vec_id", "dim", "vec", "floor")
        routed = wave.join(now, F.col("query_id") == F.col("vec_id")).filter("floor is null or bound >= floor").select("block", "vec_id", "dim", "vec", "floor")
        upto *= widen
        routed = materialize(routed, "routed")
        made = routed.count()
        if made:
            visits += made
            before, best = best, materialize(_best(best.select("query_id", "vec_id", "score").union(_visit(index, routed, k)), k), "best")
            release(before)
        release(routed)
    pairs = queries.groupBy("dim").count().join(directory.groupBy("dim").agg(F.count("*").alias("blocks")), "dim").agg(F.sum(F.col("count") * (F.col("blocks") - 1))).first()[0]
    log.info("visited %d of %d blocks beside the queries' own", visits, pairs or 0)
    release(index, directory, queries, routes)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
