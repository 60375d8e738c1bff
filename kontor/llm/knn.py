"""Exact top-k search by inner product: a Voronoi join.

Vectors are grouped by the nearest of some pivots.  A group is summed up by its
size, its radius and the ``k + 1`` smallest distances to the pivot.  With query q,
pivot p and a vector x at distance d from p, ``q.p - |q| d <= q.x <= q.p + |q| d``.  The
lower ends, over all groups, bound the k-th best score of q from below; a query goes
only to groups whose upper end reaches this bound, and is solved there.

* A group is cut into slices of some ``SLICE`` rows, so a group of any size spreads over
  tasks.  A task holds a slice, and queries pass it in batches.
* Components are ``floor(scale * x)``, ``x`` as double; scores are exact.  Vectors that
  are null or hold a null or a component that isn't finite take no part.  Vectors
  of other lengths than the longest count as if filled up with zeros.
* Ties go to the smaller id.  A query meets every row but those of its own id; rows
  that repeat another id count each.  An empty table gives an empty result.
* Pivots are vectors of the table, chosen by hash, ``PIVOTS`` at most; the summaries
  are a few numbers for each pivot.  Only these are collected.
* Scores of 2^63 or more raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import named, tasks
from kontor.session import stored

PIVOTS = 32
SLICE = 1024
_QUERIES = 512
#: Whole numbers below this are exact as doubles.
_EXACT = 2.0**53


def quantised(table: DataFrame, vector: str, key: str, scale: float) -> DataFrame:
    """id, vector (doubles with whole values, as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["vector"]
            sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(scale * flat).astype("<f8").tobytes()
            ends = np.cumsum(sizes) * 8
            rows = [whole[end - 8 * size:end] for end, size in zip(ends, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(rows, pa.binary())], ["id", "vector"]
            )

    value = named(vector).cast("array<double>")
    whole = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return table.filter(F.coalesce(whole, F.lit(False)) & named(key).isNotNull()).select(
        named(key).cast("bigint").alias("id"), value.alias("vector")
    ).mapInArrow(run, "id bigint, vector binary")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    if all(len(row) == 8 * width for row in rows):
        return np.frombuffer(b"".join(rows), dtype="<f8").reshape(len(rows), width)
    filled = np.zeros((len(rows), width))
    for at, row in enumerate(rows):
        filled[at, :len(row) // 8] = np.frombuffer(row, dtype="<f8")
    return filled


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products, as 64-bit numbers."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if most < _EXACT:
        return (left @ right.T).astype(np.int64)
    wide = [[int(x) for x in row] for row in left.tolist()]
    other = [[int(x) for x in row] for row in right.tolist()]
    return np.array(
        [[sum(map(int.__mul__, a, b)) for b in other] for a in wide], dtype=object
    ).astype(np.int64).reshape(len(left), len(right))


def _pivots(vectors: DataFrame, width: int, count: int) -> np.ndarray:
    mark = F.xxhash64("vector")
    rows = (
        vectors.groupBy(F.pmod(mark, F.lit(count)).alias("slot"))
        .agg(F.min(F.struct(mark.alias("mark"), "vector")).alias("chosen"))
        .orderBy("slot").collect()
    )
    return _matrix(pa.array([row["chosen"]["vector"] for row in rows], pa.binary()), width)


def _assigned(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its nearest pivot and its distance."""
    width, norms = pivots.shape[1], (pivots**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["vector"], width)
            near = (norms - 2 * (x @ pivots.T)).argmin(axis=1)
            apart = np.linalg.norm(x - pivots[near], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["vector"], pa.array(near.astype(np.int32)), pa.array(apart)],
                ["id", "vector", "cell", "apart"],
            )

    return vectors.mapInArrow(run, "id bigint, vector binary, cell int, apart double")


def _summaries(assigned: DataFrame, k: int) -> dict[int, tuple[int, float, list[float], list[int]]]:
    """Of each cell its size, its radius and the ``k + 1`` smallest distances of different ids
    with these ids."""

    def nearest(apart: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(apart, kind="stable")
        first = np.sort(np.unique(ids[order], return_index=True)[1])[:k + 1]
        return apart[order[first]], ids[order[first]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[int, float, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cells = batch["cell"].to_numpy(zero_copy_only=False)
            apart = batch["apart"].to_numpy(zero_copy_only=False)
            ids = batch["id"].to_numpy(zero_copy_only=False)
            for cell in np.unique(cells).tolist():
                own = apart[cells == cell]
                count, radius, least, names = kept.get(
                    cell, (0, 0.0, np.zeros(0), np.zeros(0, dtype=np.int64)))
                kept[cell] = (count + len(own), max(radius, float(own.max())), *nearest(
                    np.concatenate([least, own]), np.concatenate([names, ids[cells == cell]])))
        yield pa.RecordBatch.from_arrays([
            pa.array(list(kept), pa.int32()), pa.array([x[0] for x in kept.values()], pa.int64()),
            pa.array([x[1] for x in kept.values()], pa.float64()),
            pa.array([x[2].tolist() for x in kept.values()], pa.list_(pa.float64())),
            pa.array([x[3].tolist() for x in kept.values()], pa.list_(pa.int64())),
        ], ["cell", "rows", "radius", "least", "names"])

    parts = stored(assigned.select("cell", "id", "apart").mapInArrow(
        run, "cell int, rows bigint, radius double, least array<double>, names array<bigint>"
    ))
    # Each task sends k + 1 numbers a cell.
    whole = parts.groupBy("cell").agg(F.sum("rows").alias("rows"), F.max("radius").alias("radius"))
    near = parts.select(
        "cell", F.inline(F.arrays_zip("least", "names"))
    ).groupBy("cell", "names").agg(F.min("least").alias("least")).groupBy("cell").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("least", "names"))), 1, k + 1).alias("near")
    )
    return {
        row["cell"]: (row["rows"], row["radius"], [x["least"] for x in row["near"]],
                      [x["names"] for x in row["near"]])
        for row in whole.join(near, "cell").collect()
    }


def _routed(
    queries: DataFrame, pivots: np.ndarray, cells: dict, slices: list[int], k: int
) -> DataFrame:
    """Queries at every slice that may hold one of their best: id, vector, cell, slice, floor."""
    width = pivots.shape[1]
    names = sorted(cells)
    radius = np.array([cells[name][1] for name in names])
    near = np.array([x for name in names for x in cells[name][3]], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch["vector"], width)
            at, size = q @ pivots[names].T, np.linalg.norm(q, axis=1)[:, None]
            slack = 1e-9 * (np.abs(at).max(initial=0) + size * radius.max(initial=0)) + 1e-6
            lower = np.concatenate([
                at[:, [n]] - size * np.array(cells[name][2]) for n, name in enumerate(names)
            ], axis=1)
            # Rows of the query's own id don't count.
            ids = batch["id"].to_numpy(zero_copy_only=False)
            lower[ids[:, None] == near[None, :]] = -np.inf
            if lower.shape[1] >= k:
                floor = np.partition(lower, -k, axis=1)[:, -k] - slack[:, 0]
            else:
                floor = np.full(len(q), -np.inf)
            rows, found = np.nonzero(at + size * radius + slack >= floor[:, None])
            per = np.array([slices[names[n]] for n in found], dtype=np.int64)
            rows, found = np.repeat(rows, per), np.repeat(found, per)
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(per) - per, per)
            rows = pa.array(rows)
            yield pa.RecordBatch.from_arrays([
                batch["id"].take(rows), batch["vector"].take(rows),
                pa.array(np.array(names, dtype=np.int32)[found]), pa.array(nth.astype(np.int32)),
                pa.array(floor).take(rows),
            ], ["id", "vector", "cell", "slice", "floor"])

    return queries.select("id", "vector").mapInArrow(
        run, "id bigint, vector binary, cell int, slice int, floor double"
    )


def _best(scores: np.ndarray, own: np.ndarray, names: np.ndarray, floor: np.ndarray, k: int):
    """Places (query, vector) of the k best of each query; ``names`` ascends."""
    held = own[:, None] != names[None, :]
    if scores.shape[1] > k:
        bound = np.partition(
            np.where(held, scores, np.iinfo(np.int64).min), -k, axis=1)[:, -k]
        held &= (scores >= bound[:, None]) & (scores >= np.ceil(floor)[:, None])
    rows, columns = np.nonzero(held)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, rows, "left")
    kept = np.arange(len(rows)) - first < k
    return rows[kept], columns[kept]


def _solved(rows: DataFrame, width: int, k: int) -> DataFrame:
    """query_id, vec_id, score of the best of each slice; data come before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, vectors, sorted_ = None, [], [], False
        for batch in batches:
            cell = batch["cell"].to_numpy(zero_copy_only=False).astype(np.int64)
            place = cell << 32 | batch["slice"].to_numpy(zero_copy_only=False)
            floors = batch["floor"].to_numpy(zero_copy_only=False)
            query = batch["asks"].to_numpy(zero_copy_only=False)
            ids = batch["id"].to_numpy(zero_copy_only=False)
            change = np.flatnonzero((place[1:] != place[:-1]) | (query[1:] != query[:-1])) + 1
            bounds = [0, *change.tolist(), len(place)] if len(place) else []
            for start, stop in zip(bounds, bounds[1:], strict=False):
                own = _matrix(batch["vector"].slice(start, stop - start), width)
                if place[start] != key:
                    key, names, vectors, sorted_ = place[start], [], [], False
                if not query[start]:
                    names.append(ids[start:stop])
                    vectors.append(own)
                    continue
                if not names:
                    continue
                if not sorted_:
                    known, data = np.concatenate(names), np.concatenate(vectors)
                    order = np.argsort(known, kind="stable")
                    known, data, sorted_ = known[order], data[order], True
                for at in range(start, stop, _QUERIES):
                    to = min(at + _QUERIES, stop)
                    scores = _products(own[at - start:to - start], data)
                    who, what = _best(scores, ids[at:to], known, floors[at:to], k)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[at:to][who]), pa.array(known[what]),
                        pa.array(scores[who, what]),
                    ], ["query_id", "vec_id", "score"])

    return (
        rows.repartition(tasks(rows), "cell", "slice")
        .sortWithinPartitions("cell", "slice", "asks")
        .mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    )


def top_k(
    table: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding",
    key: str = "vec_id", scale: float = 64.0, pivots: int = PIVOTS, slice_rows: int = SLICE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of every row for which ``is_query``
    holds (a condition on ``id``) the k rows of largest inner product."""
    vectors = stored(quantised(table, vector, key, scale))
    out = "query_id bigint, rank int, vec_id bigint, score bigint"
    width = vectors.agg(F.max(F.octet_length("vector"))).first()[0]
    if width is None:
        return table.sparkSession.createDataFrame([], out)
    width //= 8
    centres = _pivots(vectors, width, pivots)
    assigned = stored(_assigned(vectors, centres))
    cells = _summaries(assigned, k)
    slices = [-(-cells[n][0] // slice_rows) if n in cells else 1 for n in range(len(centres))]
    data = assigned.select(
        "id", "vector", "cell",
        F.pmod(
            F.monotonically_increasing_id(), F.get(F.array(*map(F.lit, slices)), F.col("cell"))
        ).cast("int").alias("slice"),
        F.lit(0.0).alias("floor"), F.lit(False).alias("asks"),
    )
    asked = _routed(assigned.filter(is_query), centres, cells, slices, k)
    found = _solved(data.unionByName(asked.withColumn("asks", F.lit(True))), width, k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
