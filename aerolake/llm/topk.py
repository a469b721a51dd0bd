"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors become integers and are laid out in an order that keeps similar ones together (nearest of
a few pivots, then id). Runs of this order are blocks with a forward index (ids and components)
and each term's largest and smallest component. For a query, the summed term maxima bound every
score in a block; blocks are visited by falling bound until it is below the k-th score so far.

Queries travel in groups and blocks in chunks. Each group first searches the chunk with its best
bounds; the k-th scores found there decide which other chunks a group needs at all.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null
id, take no part. Every other row is a candidate of every query but those with its own id, so an id
that rows share can be found once for each of them, identical rows included; queries that share an
id share one ranking, of all their scores. Shorter vectors count as padded with zeros; components
beyond 64 bits saturate, and so do scores. Other columns are ignored. An empty table or no query
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

PIVOTS = 64  # a bounded sample that only decides the order of the vectors
BLOCK = 256  # vectors of a block
CHUNK = 65_536  # vectors of a chunk at most
GROUP = 8_192  # queries of a group at most
_LONG = 2**63 - 1

_CHUNKS = "chunk bigint, n bigint, ids binary, cells binary, high binary, low binary"
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def as_integers(vector: np.ndarray, scale: float) -> np.ndarray:
    cells = np.floor(scale * vector.astype(np.float64))
    return np.clip(cells, -9.2233720368547748e18, 9.2233720368547748e18).astype(np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for row, value in enumerate(column.to_pylist()):
        out[row, : len(value)] = value
    return out


def _near(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, dim: int):
    for batch in batches:
        cells = _matrix(batch.column(1), dim)
        pivot = (cells.astype(np.float64) @ pivots.T).argmax(axis=1)
        yield batch_of(
            {
                "pivot": (pivot, pa.int32()),
                "vec_id": (batch.column(0), None),
                "cells": (list(cells), pa.list_(pa.int64())),
            }
        )


def _block_up(batches: Iterator[pa.RecordBatch], dim: int, most: int):
    """Chunks of at most ``most`` vectors, in the order they come."""
    from pyspark import TaskContext

    held, ids, number = [], [], TaskContext.get().partitionId() << 32

    def chunk():
        cells, keys = np.concatenate(held), np.concatenate(ids)
        starts = np.arange(0, len(keys), BLOCK)
        rows = {
            "chunk": ([number], pa.int64()),
            "n": ([len(keys)], pa.int64()),
            "ids": ([keys.tobytes()], pa.binary()),
            "cells": ([cells.tobytes()], pa.binary()),
            "high": ([np.maximum.reduceat(cells, starts).tobytes()], pa.binary()),
            "low": ([np.minimum.reduceat(cells, starts).tobytes()], pa.binary()),
        }
        return batch_of(rows)

    size = 0
    for batch in batches:
        cells = _matrix(batch.column(1), dim)
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        while len(keys):
            take = min(len(keys), most - size)
            held.append(cells[:take])
            ids.append(keys[:take])
            size += take
            cells, keys = cells[take:], keys[take:]
            if size == most:
                yield chunk()
                held, ids, size, number = [], [], 0, number + 1
    if size:
        yield chunk()


def _read(n: int, raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(-1, dim)


def _number(cells: list[np.ndarray], dim: int) -> type:
    """float64 where every sum of products is exact in it, else Python integers."""
    most = max((int(np.abs(c.astype(np.float64)).max()) for c in cells if c.size), default=0)
    return np.float64 if most * most * max(dim, 1) < 2**52 else object


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    zero = queries.dtype.type(0) if queries.dtype != object else 0
    return np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T


def _search(batches: Iterator[pa.RecordBatch], dim: int, k: int):
    """Rows (query, candidate, score) of each pair of group and chunk that may matter."""
    for batch in batches:
        for row in batch.to_pylist():
            found = _search_pair(row, dim, k)
            if len(found[0]):
                yield batch_of(
                    {n: (v, pa.int64()) for n, v in zip(("query_id", "vec_id", "score"), found)}
                )


def _search_pair(row: dict, dim: int, k: int):
    queries, cells = (_read(0, row[name], dim) for name in ("q_cells", "cells"))
    high, low = (_read(0, row[name], dim) for name in ("high", "low"))
    q_ids, ids = (np.frombuffer(row[name], np.int64) for name in ("q_ids", "ids"))
    kind = _number([queries, cells], dim)
    queries, high, low = queries.astype(kind), high.astype(kind), low.astype(kind)
    none = -np.inf if kind is np.float64 else -(2**200)
    floor = np.frombuffer(row["floor"], np.int64).astype(kind) if row["floor"] else None
    scores = np.full((len(q_ids), k), none, dtype=kind)
    found = np.full((len(q_ids), k), _LONG, dtype=np.int64)
    bounds = _bounds(queries, high, low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    for place in range(order.shape[1]):
        block_of = order[:, place]
        bound = np.take_along_axis(bounds, block_of[:, None], 1)[:, 0]
        # an equal bound may still hold a smaller id
        least = scores[:, -1] if floor is None else np.maximum(scores[:, -1], floor)
        active = np.flatnonzero(bound >= least)
        if not len(active):
            break
        for block in np.unique(block_of[active]):
            mine = active[block_of[active] == block]
            part = slice(block * BLOCK, (block + 1) * BLOCK)
            fresh = queries[mine] @ cells[part].astype(kind).T
            fresh[q_ids[mine][:, None] == ids[part][None, :]] = none
            both = np.concatenate([scores[mine], fresh], axis=1)
            keys = np.concatenate([found[mine], np.broadcast_to(ids[part], fresh.shape)], axis=1)
            if kind is np.float64:
                best = np.lexsort((keys, -both), axis=-1)[:, :k]
            else:
                best = np.array(
                    [sorted(range(len(b)), key=lambda i: (-b[i], x[i]))[:k] for b, x in zip(both, keys)]
                )
            scores[mine] = np.take_along_axis(both, best, 1)
            found[mine] = np.take_along_axis(keys, best, 1)
    real = scores > none
    query = np.broadcast_to(q_ids[:, None], scores.shape)[real]
    values = [int(min(max(x, -_LONG), _LONG)) for x in scores[real]]
    return query, found[real], np.array(values, dtype=np.int64)


def _pair_bounds(batches: Iterator[pa.RecordBatch], dim: int):
    """For each pair of group and chunk: the best bound, and whether any query may need it."""
    for batch in batches:
        groups, chunks, tops, needed = [], [], [], []
        for row in batch.to_pylist():
            queries = _read(0, row["q_cells"], dim)
            high, low = (_read(0, row[name], dim) for name in ("high", "low"))
            kind = _number([queries, high, low], dim)
            bound = _bounds(queries.astype(kind), high.astype(kind), low.astype(kind)).max(axis=1)
            floor = np.frombuffer(row["floor"], np.int64) if row["floor"] else None
            groups.append(row["group"])
            chunks.append(row["chunk"])
            tops.append(float(bound.max()))
            needed.append(bool(floor is None or (bound >= floor).any()))
        yield batch_of(
            {
                "group": (groups, pa.int64()),
                "chunk": (chunks, pa.int64()),
                "top": (tops, pa.float64()),
                "needed": (needed, pa.bool_()),
            }
        )


def _with_floor(batches: Iterator[pa.RecordBatch]):
    """Each group with the k-th scores known so far, in the order of its queries."""
    for batch in batches:
        rows = batch.to_pylist()
        floors = []
        for row in rows:
            known = dict(zip(row["known_ids"] or [], row["known_scores"] or []))
            ids = np.frombuffer(row["q_ids"], np.int64)
            floors.append(np.array([known.get(i, -_LONG - 1) for i in ids], np.int64).tobytes())
        yield batch_of(
            {
                "group": ([r["group"] for r in rows], pa.int64()),
                "q_ids": ([r["q_ids"] for r in rows], pa.binary()),
                "q_cells": ([r["q_cells"] for r in rows], pa.binary()),
                "floor": (floors, pa.binary()),
            }
        )


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = 5,
    scale: float = 256.0,
    key: str = "vec_id",
    value: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row where ``is_query``.

    ``is_query`` is a condition on ``vec_id``.
    """
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    cells = F.transform(value, lambda x: F.floor(scale * x.cast("double")).cast("bigint"))
    sound = vectors.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).filter(finite)
    whole = sound.select(F.col(key).cast("bigint").alias("vec_id"), cells.alias("cells"))
    rows = stage(whole, "topk-rows")
    dim = rows.agg(F.max(F.size("cells"))).first()[0] or 0
    spark = vectors.sparkSession
    if not dim:
        return spark.createDataFrame([], RESULT)
    sample = rows.orderBy(F.xxhash64("vec_id", "cells"), "vec_id", "cells").limit(PIVOTS).collect()
    pivots = np.zeros((len(sample), dim))
    for place, row in enumerate(sample):
        pivots[place, : len(row["cells"])] = row["cells"]
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-9)
    near = in_batches(
        rows, partial(_near, pivots=pivots, dim=dim), "pivot int, vec_id bigint, cells array<bigint>"
    )

    def blocks(frame: DataFrame, most: int) -> DataFrame:
        # the hash parts rows that share an id
        order = ["pivot", "vec_id", F.xxhash64("cells")]
        laid = frame.repartitionByRange(*order).sortWithinPartitions(*order)
        return in_batches(
            laid.select("vec_id", "cells"), partial(_block_up, dim=dim, most=most), _CHUNKS
        )

    chunks = stage(blocks(near, CHUNK), "topk-chunks")
    asked = blocks(near.filter(is_query), GROUP)
    groups = stage(
        asked.select(F.col("chunk").alias("group"), F.col("ids").alias("q_ids"),
                     F.col("cells").alias("q_cells")), "topk-groups",
    )

    def searched(groups: DataFrame, pairs: DataFrame) -> DataFrame:
        ready = pairs.select("group", "chunk").join(groups, "group").join(chunks, "chunk")
        return in_batches(
            ready.select("q_ids", "q_cells", "floor", "ids", "cells", "high", "low"),
            partial(_search, dim=dim, k=k),
            "query_id bigint, vec_id bigint, score bigint",
        )

    # every group against the outline of every chunk: the query set in blocks
    numbers = chunks.select("chunk").agg(F.sort_array(F.collect_list("chunk"))).first()[0]

    def bounded(groups: DataFrame) -> DataFrame:
        met = groups.withColumn("chunk", F.explode(F.lit(numbers).cast("array<bigint>")))
        met = met.join(chunks.select("chunk", "high", "low"), "chunk")
        return in_batches(
            met.select("group", "chunk", "q_cells", "floor", "high", "low"),
            partial(_pair_bounds, dim=dim),
            "group bigint, chunk bigint, top double, needed boolean",
        )

    fresh = groups.withColumn("floor", F.lit(None).cast("binary"))
    home = (
        bounded(fresh).groupBy("group").agg(F.max_by("chunk", F.struct("top", "chunk")).alias("chunk"))
    )
    home = stage(home, "topk-home")
    first = stage(searched(fresh, home), "topk-first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    owner = groups.select("group", "q_ids", "q_cells")
    # a group's queries and their k-th scores travel with the group, at most GROUP numbers
    known = in_batches(
        groups.select("group", "q_ids"), _spread, "group bigint, query_id bigint"
    ).join(kth.filter(F.col("n") >= k), "query_id")
    known = known.groupBy("group").agg(
        F.collect_list(F.struct("query_id", "score")).alias("known")
    )
    told = owner.join(known, "group", "left").select(
        "group", "q_ids", "q_cells",
        F.col("known.query_id").alias("known_ids"), F.col("known.score").alias("known_scores"),
    )
    floored = stage(
        in_batches(told, _with_floor, "group bigint, q_ids binary, q_cells binary, floor binary"),
        "topk-floored",
    )
    rest = bounded(floored).filter("needed").join(home, ["group", "chunk"], "left_anti")
    both = first.unionByName(searched(floored, rest))
    # ranks above k are cut before the shuffle
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = both.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _spread(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for group, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.frombuffer(raw, np.int64)
            yield batch_of(
                {"group": (np.full(len(ids), group), pa.int64()), "query_id": (ids, pa.int64())}
            )
