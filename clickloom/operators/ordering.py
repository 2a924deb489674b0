"""Numbering and running sums that never put a whole key, or all rows, in one task.

A plain window over a key is one task per key. Here the rows are range-partitioned
by (key, order), so a key holding a third of all rows is spread over a third of the
partitions; small per-partition totals then turn local numbers into global ones.
The stamped rows are checkpointed between the two steps, because range bounds are
sampled and must not be drawn twice. Where the data say how to cut a key (a time, an id),
`position_by_slice` and `running_total_of_ids` do without sample and checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _stamped(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition and sort by `order`; add the partition and the row within it."""
    stamped = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_stamp", F.monotonically_increasing_id())
    )
    return (
        cut_lineage(stamped)
        .withColumn("_part", F.shiftright("_stamp", _ROW_BITS))
        .withColumn("_row", F.col("_stamp").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_stamp")
    )


def _part_offsets(stamped: DataFrame, total: Column) -> DataFrame:
    """One row per range partition: the total of all earlier partitions.

    Its size is the number of partitions whatever the data, hence the single-task
    window and, in the callers, the broadcast.
    """
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return (
        stamped.groupBy("_part")
        .agg(total.alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    )


def dense_index(df: DataFrame, key: str, start: int = 0, name: str = "idx") -> DataFrame:
    """Distinct non-null keys, numbered without gaps in key order from `start`."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    stamped = _stamped(keys, [key])
    offsets = _part_offsets(stamped, F.count(F.lit(1)))
    return stamped.join(F.broadcast(offsets), "_part").select(
        key, (F.col("_before") + F.col("_row") + F.lit(start)).cast("bigint").alias(name)
    )


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos", start: int = 0
) -> DataFrame:
    """Number each key's rows by `order`, from `start`.

    `keys` must be non-null and (keys, order) unique. A range boundary can split at
    most one key, so at most one key per partition continues an earlier one.
    """
    stamped = _stamped(df, [*keys, *order])
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        stamped.groupBy("_part", *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_carry", F.sum("_n").over(earlier))
        .where("_carry > 0")
        .select("_part", *keys, "_carry")
    )
    local = W.partitionBy("_part", *keys).orderBy("_row")
    return (
        stamped.withColumn("_local", F.row_number().over(local))
        .join(F.broadcast(carried), ["_part", *keys], "left")
        .withColumn(
            name,
            (F.col("_local") - 1 + F.coalesce("_carry", F.lit(0)) + F.lit(start)).cast("bigint"),
        )
        .drop("_part", "_row", "_local", "_carry")
    )


def position_by_slice(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], piece: Column, name: str = "pos", start: int = 0
) -> DataFrame:
    """Number each key's rows by `order`, from `start`, with one exchange of the rows.

    `piece` cuts a key's rows into slices that follow each other in `order` (an hour of the
    time, say), so that a key of a third of all rows is numbered slice by slice. The sizes
    of the slices, a row each, are summed up per key and joined to where the rows are
    already. Nothing is sampled or written. `keys` must be non-null and (keys, order) unique.
    """
    cut = df.withColumn("_slice", F.struct(piece))  # never null itself
    on = [*keys, "_slice"]
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    sizes = cut.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).select(
        *on, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    numbered = cut.withColumn("_local", F.row_number().over(W.partitionBy(*on).orderBy(*order)))
    position = (F.col("_before") + F.col("_local") - 1 + F.lit(start)).cast("bigint")
    return numbered.join(sizes, on).select(*df.columns, position.alias(name))


def running_total_of_ids(
    df: DataFrame, key: str, value: str, name: str, inclusive: bool = True, bits: int = 12
) -> DataFrame:
    """Sum of `value` over all rows up to (or strictly before) each row, by a unique whole
    number `key`.

    Ids are cut into slices of 2**bits, and those into slices of as many; a window never holds
    more rows than that, but for the last one, over a row per 2**(2 * bits) ids.
    """
    fine, coarse = F.shiftright(key, bits), F.shiftright(key, 2 * bits)
    totals = df.groupBy(fine.alias("_fine"), coarse.alias("_coarse")).agg(F.sum(value).alias("_n"))
    before = W.orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    above = totals.groupBy(F.col("_coarse").alias("_c")).agg(F.sum("_n").alias("_n")).select(
        "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above")
    )
    inside = W.partitionBy("_coarse").orderBy("_fine").rowsBetween(W.unboundedPreceding, -1)
    slices = totals.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        above, F.col("_coarse") == F.col("_c")
    ).select(F.col("_fine").alias("_f"), (F.col("_above") + F.col("_inside")).alias("_before"))
    local = F.sum(value).over(W.partitionBy("_fine").orderBy(key).rowsBetween(W.unboundedPreceding, 0))
    summed = df.withColumn("_fine", fine).withColumn("_local", local)
    total = F.col("_before") + F.col("_local")
    return summed.join(slices, F.col("_fine") == F.col("_f")).select(
        *df.columns, (total if inclusive else total - F.col(value)).alias(name)
    )


def running_total(
    df: DataFrame, order: Sequence[str], value: str, name: str, inclusive: bool = True
) -> DataFrame:
    """Sum of `value` over all rows up to (or strictly before) each row."""
    stamped = _stamped(df, order)
    offsets = _part_offsets(stamped, F.sum(value))
    local = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
    total = F.col("_before") + F.sum(value).over(local)
    if not inclusive:
        total = total - F.col(value)
    return (
        stamped.join(F.broadcast(offsets), "_part")
        .withColumn(name, total)
        .drop("_part", "_row", "_before")
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order`; partial aggregation shrinks a hot key
    on the map side, where a row_number window would ship all its rows."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)
