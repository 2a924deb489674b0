"""Dot products of (user, article) pairs, without a vector per pair on any exchange.

Users and articles are hashed into the rows and columns of a grid with about as many cells
as there are shuffle partitions. A distinct pair lies in one cell; a user's vectors are
sent once to each cell of its row in which it has pairs, an article's once to each such cell
of its column. A user or article of a third of all pairs is spread over a row or column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.joins import lookup


class _Side:
    """Vectors of one cell by key; keys are found by binary search."""

    def __init__(self, table: pa.Table, column: str):
        table = table.sort_by("key")
        self.keys = table.column("key").to_numpy()
        lists = table.column(column).combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
        ends = lists.offsets.to_numpy()
        self.begin, self.width = ends[:-1], np.diff(ends)
        self.width = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, self.width)
        values = lists.values
        self.flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
        self.holes = np.concatenate([[0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it has a whole vector here."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        lo = self.begin[at]
        whole = self.holes[lo + self.width[at]] == self.holes[lo]
        return at, (self.keys[at] == keys) & (self.width[at] > 0) & whole


def products(left: _Side, right: _Side, users: np.ndarray, articles: np.ndarray) -> np.ndarray:
    """Dot products; NaN where a side has no vector or the widths differ."""
    i, has_left = left.places(users)
    j, has_right = right.places(articles)
    out = np.full(len(users), np.nan)
    good = np.flatnonzero(has_left & has_right)
    good = good[left.width[i[good]] == right.width[j[good]]]
    widths = left.width[i[good]]
    for width in np.unique(widths):
        at = good[widths == width]
        for lo in range(0, len(at), 4096):
            part = at[lo : lo + 4096]
            steps = np.arange(width)
            x = left.flat[left.begin[i[part]][:, None] + steps]
            y = right.flat[right.begin[j[part]][:, None] + steps]
            out[part] = np.einsum("ij,ij->i", x, y)
    return out


def pair_products(
    pairs: DataFrame, profiles: DataFrame, article_vecs: DataFrame, uses: Sequence[tuple[str, str]]
) -> DataFrame:
    """`user_id`, `article_id`, `dots` of the distinct pairs.

    `dots` has, for each (profile column, vector column) of `uses`, the dot product, null
    where either is missing, has a null component, or the widths differ. Vectors are ARRAY of
    FLOAT or DOUBLE and travel as they are; sums are DOUBLE. Ids are whole numbers; pairs with a null id are left out. `profiles` and `article_vecs` have one row per id.
    """
    spark = pairs.sparkSession
    side = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cell = F.pmod(F.xxhash64("user_id"), F.lit(side)) * side + F.pmod(F.xxhash64("article_id"), F.lit(side))
    dealt = (
        pairs.select(F.col("user_id").cast("bigint"), F.col("article_id").cast("bigint"))
        .where(F.col("user_id").isNotNull() & F.col("article_id").isNotNull())
        .distinct().withColumn("cell", cell)
    )

    forms = {"wide": T.ArrayType(T.DoubleType()), "narrow": T.ArrayType(T.FloatType())}  # sent as they are

    def sent(key: str, table: DataFrame, columns: Sequence[str], first: int) -> DataFrame:
        """A row for each cell and vector of the ids that have pairs there."""
        wanted = dealt.select(key, "cell").distinct()
        rows = lookup(wanted, table.select(F.col(key).cast("bigint").alias(key), *columns), key, "inner")
        stacked = F.array(*[
            F.struct(F.lit(first + k).alias("what"), *[
                F.when(F.lit(table.schema[c].dataType == kind), F.col(c)).cast(kind).alias(n) for n, kind in forms.items()
            ]) for k, c in enumerate(columns)
        ])
        return rows.select("cell", F.col(key).alias("key"), F.lit(None).cast("bigint").alias("other"), F.inline(stacked))

    mine = list(dict.fromkeys(p for p, _ in uses))
    theirs = list(dict.fromkeys(v for _, v in uses))
    left = sent("user_id", profiles, mine, 0)
    right = sent("article_id", article_vecs, theirs, len(mine))
    asked = dealt.select(
        "cell", F.col("user_id").alias("key"), F.col("article_id").alias("other"), F.lit(-1).alias("what"),
        *[F.lit(None).cast(kind).alias(n) for n, kind in forms.items()],
    )

    form_of = [
        "narrow" if table.schema[c].dataType == forms["narrow"] else "wide"
        for table, columns in ((profiles, mine), (article_vecs, theirs)) for c in columns
    ]

    def run(rows: pa.Table) -> pa.Table:
        what = rows.column("what").to_numpy()
        sides = [_Side(rows.filter(pa.array(what == k)), form) for k, form in enumerate(form_of)]
        some = rows.filter(pa.array(what == -1))
        users, articles = some.column("key").to_numpy(), some.column("other").to_numpy()
        dots = [
            products(sides[mine.index(p)], sides[len(mine) + theirs.index(v)], users, articles) for p, v in uses
        ]
        flat = np.column_stack(dots).ravel() if len(users) else np.zeros(0)
        return pa.table({
            "user_id": users, "article_id": articles,
            "dots": pa.ListArray.from_arrays(
                pa.array(np.arange(len(users) + 1, dtype=np.int32) * len(uses)),
                pa.array(flat, mask=np.isnan(flat)),
            ),
        })

    return asked.unionByName(left).unionByName(right).groupBy("cell").applyInArrow(
        run, "user_id bigint, article_id bigint, dots array<double>"
    )
