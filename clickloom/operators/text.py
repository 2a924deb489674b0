"""Text, category and article embeddings."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.scalar import with_prefix
from clickloom.operators.encode import UNKNOWN_CATEGORY
from clickloom.operators.joins import lookup

# The description of the category that stands for "none given", and the
# prefix that encoders expect before a passage.
UNKNOWN_DESCRIPTION = "General news content with no specific category."
PASSAGE = "passage: "
NOT_A_WORD = "[^\\p{L}\\p{N}]+"
_KNOWN = 1 << 20  # words whose bucket a task remembers
# texts are counted so many bytes and so many (text, bucket) cells at a time, however large the batch
_BYTES = 1 << 23
_CELLS = 1 << 22


def _bucket_counts(dim: int) -> Callable:
    """UDF: the buckets of a text's words in order, and how many of the words each holds.

    Words are told apart first, so md5 runs once per different word a task remembers.
    """
    known: dict[str, int] = {"": -1}

    def cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.split_pattern_regex(texts, NOT_A_WORD)
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(known) > _KNOWN:
            known.clear()
            known[""] = -1
        for name in names:
            if name not in known:
                known[name] = int.from_bytes(hashlib.md5(name.encode()).digest()[:4], "big") % dim
        table = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        bucket = table[coded.indices.to_numpy()]
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
        n = np.bincount((row * dim + bucket)[bucket >= 0], minlength=len(texts) * dim)
        held = np.flatnonzero(n)
        return held, n[held]

    def hashed_split(texts: pa.Array) -> pa.Array:
        before = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // _BYTES
        slices = before + np.arange(len(texts)) * dim // _CELLS  # neither part falls, so equal sums are neighbours
        starts = [*np.flatnonzero(np.diff(slices, prepend=-1)).tolist(), len(texts)]
        parts = [cells(texts.slice(i, j - i)) for i, j in pairwise(starts)]
        nothing = np.zeros(0, np.int64)
        cell = np.concatenate([nothing, *(held + i * dim for i, (held, _) in zip(starts, parts, strict=False))])
        ends = pa.array(np.searchsorted(cell, np.arange(len(texts) + 1) * dim), pa.int32())
        buckets, ns = (cell % dim).astype(np.int32), np.concatenate([nothing, *(n for _, n in parts)])
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (buckets, ns)]
        return pa.StructArray.from_arrays(lists, names=["buckets", "ns"])

    return F.arrow_udf(hashed_split, "struct<buckets:array<int>,ns:array<bigint>>")


def _text_counts(named: DataFrame, dim: int) -> DataFrame:
    """`_id`, `_counts`: the counts of an id's texts, a list of buckets and one of numbers.

    An id's counts stay in one row. Only ids that name several rows, found from the ids alone,
    are added up bucket by bucket; the join splits a hot one at run time, see `lookup`, and
    its exchange holds the counts for every reader.
    """
    key = F.struct("_id").alias("_key")  # the only id kept: a reader without ids still shares the exchange
    counted = named.select(key, _bucket_counts(dim)("_text").alias("_counts"))
    twice = (
        named.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
        .select(key, F.lit(True).alias("_again"))
    )
    marked = counted.join(twice.hint("merge"), "_key", "left")
    again = (
        marked.where(F.col("_again")).select("_key", _entries("bucket", "n"))
        .groupBy("_key", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("_list"))
        .select("_key", F.struct(F.col("_list.bucket").alias("buckets"), F.col("_list.n").alias("ns")).alias("_counts"))
    )
    once = marked.where(F.col("_again").isNull()).select("_key", "_counts")
    return once.unionByName(again).select("_key._id", "_counts")


def _entries(bucket: str, n: str) -> Column:
    return F.inline(F.arrays_zip("_counts.buckets", "_counts.ns")).alias(bucket, n)


def term_weights(df: DataFrame, ids: Sequence[str], column: str, dim: int = 256) -> DataFrame:
    """`*ids`, `bucket`, `value`: hashed terms of whole texts as unit vectors, in long form.

    A term is a run of letters and digits (as Arrow's RE2 tells them) in lower case, its bucket
    the first 32 bits of its md5 modulo `dim`. A value is the bucket's count times log((rows + 1) / (rows with it + 1)),
    divided by the row's length. Only buckets that occur have a row; a text without terms, or
    null, has none. `ids` must name each row, nulls allowed.

    Texts are split once: the document frequencies and the weights read the same exchange of
    counts, one row per text, and a length is taken within that row.
    """
    named = df.select(F.struct(*ids).alias("_id"), F.lower(F.coalesce(column, F.lit(""))).alias("_text"))
    counts = _text_counts(named, dim)
    rows = named.agg(F.count(F.lit(1)).alias("_rows"))
    having = (
        counts.select(F.explode("_counts.buckets").alias("bucket"), F.size("_counts.ns").alias("_of"))
        .groupBy("bucket").agg(F.count("_of").alias("_having"))
    )
    # one row of at most `dim` values, whatever the data
    rarity = having.crossJoin(F.broadcast(rows)).agg(F.map_from_entries(F.collect_list(F.struct(
        "bucket", F.log((F.col("_rows") + 1) / (F.col("_having") + 1))
    ))).alias("_map")).select(F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda b: F.coalesce(F.try_element_at("_map", b), F.lit(0.0))
    ).alias("_idf"))
    weighed = counts.crossJoin(F.broadcast(rarity))
    weights = F.zip_with("_counts.buckets", "_counts.ns", lambda b, n: n * F.get("_idf", b))
    norm = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda total, w: total + w * w))
    entries = weighed.select("_id", "_idf", "_counts", norm.alias("_norm")).select("*", _entries("_bucket", "_n"))
    weight = F.col("_n") * F.get("_idf", F.col("_bucket"))
    return entries.select(
        "_id.*", F.col("_bucket").cast("bigint").alias("bucket"),
        F.coalesce(F.try_divide(weight, F.col("_norm")), F.lit(0.0)).alias("value"),
    )


def embed_texts(
    df: DataFrame,
    columns: dict[str, str],
    dim: int = 256,
    prefix: str = PASSAGE,
    make_encoder: Callable[[], Callable] | None = None,
    batch_size: int = 32,
) -> DataFrame:
    """Replace text columns by unit-length vectors of the whole texts.

    Default: the hashed terms of `term_weights`, as dense FLOAT vectors. The other columns
    must name each row; nothing runs while the plan is made.

    With `make_encoder`, an external encoder gets the prefixed texts in batches (a string
    array in, a (batch, dim) float array out) and is loaded once per Python process;
    its vectors are normalised here.
    """
    keep = [c for c in df.columns if c not in columns]
    if make_encoder is None:
        out = df.select(F.struct(*keep).alias("_id"))
        for c, to in columns.items():
            entry = F.struct("bucket", "value")
            lists = term_weights(df, keep, c, dim).groupBy(F.struct(*keep).alias("_id")).agg(
                F.map_from_entries(F.collect_list(entry)).alias("_map")
            )
            dense = F.transform(
                F.sequence(F.lit(0), F.lit(dim - 1)),
                lambda b: F.coalesce(F.try_element_at("_map", b.cast("bigint")), F.lit(0.0)).cast("float"),
            )
            vectors = lists.select("_id", dense.alias(to))
            zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
            out = out.join(vectors, "_id", "left").withColumn(to, F.coalesce(to, zero))
        return out.select("_id.*", *columns.values())
    encode = predict_batch_udf(make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    weighted = df.select(*keep, *[
        array_to_vector(
            encode(with_prefix(F.coalesce(c, F.lit("")), prefix)).cast("array<double>")
        ).alias(f"_w{i}")
        for i, c in enumerate(columns)
    ])
    for i in range(len(columns)):
        weighted = Normalizer(p=2.0, inputCol=f"_w{i}", outputCol=f"_unit{i}").transform(weighted)
    return weighted.select(*keep, *[
        vector_to_array(f"_unit{i}", "float32").alias(to) for i, to in enumerate(columns.values())
    ])


def category_descriptions(categories: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """(category_str, cat_id, description): given texts, the fixed one for 'UNK', else the name."""
    named = categories
    if descriptions is not None:
        named = categories.join(descriptions, "category_str", "left")
    else:
        named = categories.withColumn("description", F.lit(None).cast("string"))
    unknown = F.col("category_str") == UNKNOWN_CATEGORY
    return named.withColumn(
        "description",
        F.when(unknown, F.lit(UNKNOWN_DESCRIPTION)).otherwise(F.coalesce("description", "category_str")),
    )


def category_vectors(
    categories: DataFrame,
    dim: int = 256,
    descriptions: DataFrame | None = None,
    make_encoder: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Category artefact (category_str, cat_id, category_vector), one row per category."""
    described = category_descriptions(categories, descriptions)
    columns = {"description": "category_vector"}
    return embed_texts(described, columns, dim, make_encoder=make_encoder)


def embed_articles(
    text: DataFrame,
    categories: DataFrame,
    dim: int = 256,
    make_encoder: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Article embeddings: title and body vectors, and the category vector by name.

    `text` comes from `article_text`, `categories` from `category_vectors`. A category
    the artefact lacks keeps its article with a null vector.
    """
    columns = {"full_title": "title_vector", "body": "body_vector"}
    both = embed_texts(text, columns, dim, make_encoder=make_encoder)
    named = categories.select("category_str", "category_vector")
    return lookup(both, named, "category_str").select(
        "article_id", "published_time", "category_str", "title_vector", "body_vector", "category_vector"
    )
