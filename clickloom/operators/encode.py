"""Id dictionaries and encoding: joins against two-column maps, no per-row lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import arrays
from clickloom.operators.ordering import dense_index
from clickloom.session import stage, with_row_id

UNKNOWN_CATEGORY = "UNK"


def article_index(articles: DataFrame) -> DataFrame:
    """(article_id, idx): from 1 in id order; 0 is left for padding and unknown ids."""
    return dense_index(articles, "article_id", start=1)


def user_index(*behaviors: DataFrame) -> DataFrame:
    """(user_id, idx): users of all given splits, from 0 in id order."""
    users = behaviors[0].select("user_id")
    for other in behaviors[1:]:
        users = users.union(other.select("user_id"))
    return dense_index(users, "user_id", start=0)


def category_dictionary(articles: DataFrame, column: str = "category_str") -> DataFrame:
    """(category_str, cat_id): all names and 'UNK', from 0 in name order."""
    named = articles.select(F.coalesce(F.col(column), F.lit(UNKNOWN_CATEGORY)).alias("category_str"))
    unknown = articles.sparkSession.range(1).select(F.lit(UNKNOWN_CATEGORY).alias("category_str"))
    return dense_index(named.union(unknown), "category_str", start=0, name="cat_id")


def category_codes(articles: DataFrame, column: str = "category_str") -> DataFrame:
    """(column, code): from 1 in name order; a null category has no row and gets code 0."""
    return dense_index(articles.select(F.col(column).cast("string").alias(column)), column, 1, "code")


def encode_column(
    df: DataFrame, column: str, index: DataFrame, to: str, unknown: int | None = 0, idx: str = "idx"
) -> DataFrame:
    """Left join the map; ids it lacks become `unknown` (None keeps them null)."""
    key = index.columns[0]
    lookup = index.select(F.col(key).alias(column), F.col(idx).alias(to))
    out = df.join(lookup, column, "left")
    return out if unknown is None else out.withColumn(to, F.coalesce(to, F.lit(unknown)))


def encode_lists(df: DataFrame, columns: dict[str, str], index: DataFrame) -> DataFrame:
    """Replace id lists by encoded ones: order and duplicates kept, null as empty, unknown 0.

    All lists are exploded together, meet the map in one join, and are regrouped by row:
    as many rows come out as went in, whatever keys they share, and a rebuilt list is as
    long as it came in. The rows are stored first, so that a row's number is the same in
    every attempt; its other columns ride on its first item, so they are shuffled once. A
    hot article splits at run time: the map side is one row per id.
    """
    id_name = index.columns[0]
    rest = [c for c in df.columns if c not in columns]
    id_type = df.schema[next(iter(columns))].dataType.elementType.simpleString()
    stored = stage(with_row_id(df, "_number"), "lists")

    def item(kind, article):
        return F.struct(F.lit(kind).alias("kind"), article.cast(id_type).alias(id_name))

    def tagged_list(kind, column):
        return F.transform(arrays.or_empty(F.col(column), id_type), lambda x: item(kind, x))

    tagged = F.concat(*[tagged_list(kind, c) for kind, c in enumerate(columns)])
    listed = stored.withColumn("_tagged", tagged).select(
        "_number",
        F.struct(*rest).alias("_row") if rest else F.lit(None).cast("struct<_none:int>").alias("_row"),
        F.when(F.size("_tagged") > 0, F.col("_tagged")).otherwise(
            F.array(item(-1, F.lit(None)))
        ).alias("_tagged"),
    )
    items = listed.select(
        "_number", "_row", F.posexplode_outer("_tagged").alias("pos", "_item")
    ).select(
        "_number", "pos", "_item.kind", f"_item.{id_name}",
        F.when(F.col("pos") == 0, F.col("_row")).alias("_row"),
    )
    encoded = encode_column(items, id_name, index, "_idx")
    rebuilt = encoded.groupBy("_number").agg(
        F.array_sort(F.collect_list(F.struct("pos", "kind", "_idx"))).alias("_items"),
        F.first("_row", ignorenulls=True).alias("_row"),
    )

    def of_kind(kind):
        picked = F.filter("_items", lambda x: x["kind"] == F.lit(kind))
        return F.transform(picked, lambda x: x["_idx"].cast("int"))

    return rebuilt.select(
        *[F.col("_row")[c].alias(c) for c in rest],
        *[of_kind(kind).alias(to) for kind, to in enumerate(columns.values())],
    )
