"""Exact top-k search by a vector-approximation file.

Vectors of whole numbers are kept twice: exactly, and as one small cell number per
component. A scan over the cells gives bounds of each inner product. The k-th best lower
bound of a query over all rows is a floor; only rows whose upper bound reaches the floor
can be among the best, and only their exact vectors are read, best bound first, until the
k-th result is certain.

Queries are taken in blocks of bounded size, each block against all rows. Equal vectors
are one entry with its k + 1 smallest ids, which is all that k results can use of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import stage, with_row_id

SCALE = 256
CELL = 8  # width of a cell, in whole units of the vectors; a power of two
QUERY_BLOCK = 4096  # queries that one pass over the cells answers
_CHUNK = 2048  # rows whose bounds are held at once


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * x) of each component, as DOUBLE arithmetic gives it.

    A component that no BIGINT holds is an error, as in SQL.
    """

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        fits = (scaled >= F.lit(-(2.0**63))) & (scaled < F.lit(2.0**63))
        return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("component out of range")).cast("bigint"))

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """True for a non-empty vector of finite components."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
        F.lit(False),
    )


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with cells: `_entry`, `dim`, `exact`, `cells`, `ids`.

    A hot vector sends at most k + 1 ids per task into the grouping.
    """
    same = W.partitionBy("exact").orderBy("vec_id")
    first = vectors.withColumn("_rank", F.row_number().over(same)).where(F.col("_rank") <= k + 1)
    grouped = first.groupBy("exact").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(
        F.monotonically_increasing_id().alias("_entry"), F.size("exact").alias("dim"), "exact",
        F.transform("exact", lambda x: F.shiftright(x, CELL.bit_length() - 1)).alias("cells"), "ids",
    )


def _rows(column: pa.ListArray, kind) -> np.ndarray:
    """A matrix of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


class QueryBlock:
    """Queries of one block by dimension, with the widths of their bounds."""

    def __init__(self, rows: list):
        self.sides: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in {len(r["exact"]) for r in rows}:
            mine = [r for r in rows if len(r["exact"]) == dim]
            self.sides[dim] = (
                np.array([r["_query"] for r in mine], np.int64),
                np.array([r["exact"] for r in mine], np.float64),
            )

    def bounds(self, dim: int, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (rows x queries) of the inner products.

        A component in cell c lies in [CELL c, CELL c + CELL - 1]. Sums of whole and half
        numbers are exact in double precision up to 2^52; beyond, the bounds are widened by
        more than what rounding can do.
        """
        queries = self.sides[dim][1]
        centers = cells * CELL + (CELL - 1) / 2
        middle = centers @ queries.T
        spread = np.abs(queries).sum(1) * ((CELL - 1) / 2)
        largest = np.abs(centers).max(initial=0) * np.abs(queries).max(initial=0)
        if dim * largest + spread.max(initial=0) >= 2.0**51:
            reach = np.abs(centers) @ np.abs(queries).T + spread
            spread = spread + reach * ((dim + 8) * 2.0**-51)
        return middle - spread, middle + spread


def floors(cells: DataFrame, block: QueryBlock, k: int) -> DataFrame:
    """`_query`, `floor`: the (k+1)-th best lower bound over all entries, if so many.

    One more than k, since the query's own row is among the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, at in _by_dim(batch):
                if dim not in block.sides:
                    continue
                for lo in range(0, len(at), _CHUNK):
                    part = batch.take(pa.array(at[lo : lo + _CHUNK]))
                    low, _ = block.bounds(dim, _rows(part.column("cells"), np.float64))
                    held = np.vstack([best[dim], low]) if dim in best else low
                    if len(held) > k + 1:
                        held = -np.partition(-held, k, axis=0)[: k + 1]
                    best[dim] = held
        for dim, held in best.items():
            ids = np.tile(block.sides[dim][0], len(held))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(held.ravel())], names=["_query", "low"]
            )

    lows = cells.mapInArrow(run, "_query bigint, low double")
    ranked = lows.withColumn("_rank", F.row_number().over(
        W.partitionBy("_query").orderBy(F.col("low").desc())
    ))
    return ranked.where(F.col("_rank") == k + 1).select("_query", F.col("low").alias("floor"))


def near(cells: DataFrame, block: QueryBlock, floor: dict[int, float]) -> DataFrame:
    """`_query`, `_entry`, `upper` of the entries whose upper bound reaches the floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at in _by_dim(batch):
                if dim not in block.sides:
                    continue
                ids = block.sides[dim][0]
                least = np.array([floor.get(int(q), -np.inf) for q in ids])
                for lo in range(0, len(at), _CHUNK):
                    part = batch.take(pa.array(at[lo : lo + _CHUNK]))
                    _, high = block.bounds(dim, _rows(part.column("cells"), np.float64))
                    row, query = np.nonzero(high >= least)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[query]), part.column("_entry").take(pa.array(row)),
                        pa.array(high[row, query]),
                    ], names=["_query", "_entry", "upper"])

    return cells.mapInArrow(run, "_query bigint, _entry bigint, upper double")


def products(rows: np.ndarray, query: np.ndarray) -> list[int]:
    """Inner products of whole numbers, by Python's integers where 64 bits may not do."""
    reach = np.abs(rows.astype(np.float64)) @ np.abs(query.astype(np.float64))
    if reach.max(initial=0) < 2.0**62:
        return (rows @ query).tolist()
    return (rows.astype(object) @ query.astype(object)).tolist()


def _refine(k: int):
    """Read candidates in the order of their upper bounds until the k-th is certain."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        query = table.column("query_id")[0].as_py()
        upper = table.column("upper").to_numpy()
        order = np.argsort(-upper, kind="stable")
        mine = np.array(table.column("query")[0].as_py(), np.int64)
        found: list[tuple[int, int]] = []
        for lo in range(0, len(order), 64):
            kth = found[k - 1][0] if len(found) >= k else None
            if kth is not None and -kth > upper[order[lo]]:
                break
            part = table.take(pa.array(order[lo : lo + 64]))
            exact = _rows(part.column("exact").combine_chunks(), np.int64)
            own = (exact == mine).all(axis=1)
            for score, ids, same in zip(products(exact, mine), part.column("ids").to_pylist(), own, strict=True):
                if same and query in ids:
                    ids.remove(query)  # one row: its own
                found += [(-score, i) for i in ids]
            found = sorted(found)[:k]
        return pa.table({
            "query_id": pa.array([query] * len(found), pa.int64()),
            "rank": pa.array(range(1, len(found) + 1), pa.int32()),
            "vec_id": pa.array([i for _, i in found], pa.int64()),
            "score": pa.array([-s for s, _ in found], pa.int64()),
        })

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = QUERY_BLOCK
) -> DataFrame:
    """The k rows of largest inner product for every query: `query_id`, `rank`, `vec_id`, `score`.

    Both tables have `vec_id` and `exact` (whole numbers). A row of `queries` is a query of its
    own, also where an id repeats; its own row (one row of its id and vector) is no result, every
    other row is. Ties go to the smaller id. A query meets the rows of its own dimension; it
    gets all of them where they are fewer than k. Rows without id take no part, other columns
    are not read. Empty tables give an empty result. A result whose score no BIGINT holds is
    an error.
    """
    spark = vectors.sparkSession
    given = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", "exact")
    file = stage(entries(given, k), "cells")
    cells = file.select("_entry", "dim", "cells")
    asked = with_row_id(stage(
        queries.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").alias("query_id"), "exact"), "queries"
    ), "_query")
    blocks = max(1, -(-asked.count() // block))
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("_query"), F.lit(blocks)))
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    results = []
    for number in range(blocks):  # a bounded set of queries against all rows
        mine = dealt.where(F.col("_block") == number).drop("_block")
        held = QueryBlock(mine.collect())
        floor = {r[0]: r[1] for r in floors(cells, held, k).collect()}  # a number per query
        close = near(cells, held, floor)
        read = close.join(file.select("_entry", "exact", "ids"), "_entry")
        paired = read.join(mine.withColumnRenamed("exact", "query"), "_query")
        results.append(stage(
            paired.groupBy("_query").applyInArrow(_refine(k), schema), "found"
        ))
    if not results:
        return spark.createDataFrame([], schema)
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out
