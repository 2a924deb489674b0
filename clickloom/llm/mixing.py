"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the copy count that each of its documents should have;
the whole part is given to all, the fraction is rounded per document. Rounding is pivotal:
two documents with open fractions meet, and words are moved from one to the other in a
random direction, with probabilities that keep every expectation, until one fraction is 0
or 1. The words of the pair stay the same, so a source's total stays at its target.

Documents are dealt by hash to leaves of bounded size. A leaf leaves at most one open
document, and the open documents of `FAN_IN` leaves meet in the next level of the tree,
until each source has at most one. A source with a third of all rows is many leaves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.names import fresh
from clickloom.operators.joins import lookup
from clickloom.operators.ordering import dense_index
from clickloom.session import stage, with_row_id

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5  # times the size of all documents
MOST = 2.0  # times a source's size
WORDS = r"[^\x20\x09-\x0D]+"
LEAF = 4096
FAN_IN = 1024
SEED = 11


def source_key(source: Column) -> Column:
    """A key without nulls: the null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def measured(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """`_row`, `doc_id`, `source`, key, size in words and a hash that orders documents."""
    rows = with_row_id(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    ))
    return rows.select(
        "_row", "doc_id", "source", source_key(F.col("source")).alias("_source"),
        F.regexp_count("_text", F.lit(WORDS)).cast("bigint").alias("size"),
        F.xxhash64(F.lit(SEED), "doc_id", "_text").alias("_order"),
    )


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
    most: float = MOST,
) -> DataFrame:
    """`_source`, `source_size`, `n`, `target` of every source (rows: `source`, `_source`, `size`).

    Sources in code point order, null last, have the weights in turn. Targets share
    `budget` times all sizes by weight and stop at `most` times the source's size; the
    excess is shared again by weight until no target is above its limit.
    """
    totals = stage(
        sizes.groupBy("source", "_source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
        ), "sources",
    )
    index = dense_index(totals, "source", name="_index")
    numbered = stage(
        totals.join(index, "source", "left").withColumn("_index", F.coalesce(
            "_index", F.lit(totals.where(F.col("source").isNotNull()).count())
        )), "numbered",
    )
    turn = F.pmod(F.col("_index"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = numbered.select("_source", "source_size", "n", weight.alias("w"))
    limit = F.col("source_size") * F.lit(float(most))
    level, at_limit = 0.0, -1
    while True:  # each round puts at least one more source at its limit, or is the last
        above = F.lit(level) * F.col("w") > limit
        full, open_weight, total, count = rows.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0)),
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(above.cast("int")), F.lit(0)),
        ).first()
        if count == at_limit or open_weight == 0:
            break
        level, at_limit = max((budget * total - full) / open_weight, 0.0), count
    return rows.select(
        "_source", "source_size", "n", F.least(limit, F.lit(level) * F.col("w")).alias("target")
    )


def round_pairs(size: np.ndarray, mass: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Pivotal rounding in the given order; at most one mass stays between 0 and its size.

    The random direction of a pair comes from the pair's own hashes, so runs agree.
    """
    mass = mass.astype(np.float64).copy()
    with np.errstate(over="ignore"):
        mixed = order.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    def tiny(whole: float) -> float:
        return 1e-9 * whole

    held = -1
    for k in range(len(mass)):
        if not tiny(size[k]) < mass[k] < size[k] - tiny(size[k]):
            continue
        if held < 0:
            held = k
            continue
        up = min(size[held] - mass[held], mass[k])
        down = min(mass[held], size[k] - mass[k])
        draw = ((int(mixed[held]) ^ (int(mixed[k]) >> 7)) * 0xD6E8FEB86659FD93 >> 11 & (1 << 53) - 1) / (1 << 53)
        move = up if draw < down / (up + down) else -down
        mass[held] += move
        mass[k] -= move
        left = (j for j in (held, k) if tiny(size[j]) < mass[j] < size[j] - tiny(size[j]))
        held = next(left, -1)
    return np.where(size - mass <= 1e-9 * size, size, np.where(mass <= 1e-9 * size, 0.0, mass))


_NODE = "_row bigint, _source string, _leaf bigint, _order bigint, size bigint, mass double"


def round_tree(rows: DataFrame, leaves: int) -> DataFrame:
    """Round `mass` against `size` along the tree: `_row`, `mass` of every given row."""

    def leaf(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_order", "ascending"), ("size", "ascending"), ("_row", "ascending")])
        size, mass, order = (table.column(c).to_numpy() for c in ("size", "mass", "_order"))
        rounded = round_pairs(size, mass, order)
        return table.set_column(table.schema.get_field_index("mass"), "mass", pa.array(rounded))

    done = []
    while True:
        rounded = stage(rows.groupBy("_source", "_leaf").applyInArrow(leaf, _NODE), "rounded")
        still = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
        if leaves <= 1:
            return _union([*done, rounded]).select("_row", "mass")
        done.append(rounded.where(~still))
        rows = rounded.where(still).withColumn("_leaf", F.floor(F.col("_leaf") / FAN_IN))
        leaves = -(-leaves // FAN_IN)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix_plan(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST,
) -> DataFrame:
    """What the mix takes: `_row`, `doc_id`, `size`, `source_size`, `target`, `copies`, `taken`.

    `taken` counts words: whole copies, and for the one document of a source that the
    tree leaves open the words of its fraction (`copies` rounds that document by its
    half). Null texts have size 0 and are taken 0 times; a null source is a source;
    repeated rows and null ids are documents of their own. An empty table gives an empty
    result. Runs over the same table agree.
    """
    rows = stage(measured(docs, text, id_col, source), "measured")
    targets = stage(source_targets(rows, weights, budget, most), "targets")
    joined = lookup(rows, targets, "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    counted = joined.withColumn("_whole", F.floor(rate + 1e-12)).withColumn(
        "_part", F.greatest(rate - F.col("_whole"), F.lit(0.0))
    )
    open_rows = counted.where((F.col("_part") > 0) & (F.col("size") > 0)).select(
        "_row", "_source",
        F.pmod(F.xxhash64("_order", "_row"), F.ceil(F.col("n") / LEAF)).alias("_leaf"), "_order", "size",
        (F.col("_part") * F.col("size")).alias("mass"),
    )
    most_rows = targets.agg(F.max("n")).first()[0] or 0
    rounded = round_tree(open_rows, -(-most_rows // LEAF))
    extra = F.coalesce("mass", F.lit(0.0))
    return counted.join(rounded, "_row", "left").select(
        "_row", "doc_id", "size", "source_size", "target",
        (F.col("_whole") + (extra * 2 >= F.greatest("size", F.lit(1))).cast("int")).alias("copies"),
        (F.col("_whole") * F.col("size") + F.round(extra).cast("bigint")).alias("taken"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table: every row of `docs` as often as the plan says, in whole copies."""
    row, copies = fresh(docs, "_row"), fresh(docs, "_copies")
    plan = mix_plan(docs, **options).where("copies > 0").select(
        F.col("_row").alias(row), F.col("copies").cast("int").alias(copies)
    )
    taken = with_row_id(docs, row).join(plan.hint("shuffle_hash"), row)
    names = [F.col(f"`{c}`") for c in docs.columns]
    return taken.select(*names, F.explode(F.sequence(F.lit(1), copies)).alias(copies)).drop(copies)
