"""Packing documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut at multiples of the capacity; every full piece is a sequence of
its own. The remainders are dealt by hash to groups of a bounded number of tokens, and
each group is partitioned into windows: partial partitions are merged, largest difference
first, the large windows of one meeting the small windows of the other, until one
partition with near-equal windows is left. Where a window exceeds the capacity the group
gets more windows.

Near-equal windows need some small pieces: the remainder of one document in four is cut
into halves of halves, so that the last merges can even out what large pieces leave.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.names import fresh
from clickloom.llm.tokens import tokenizer
from clickloom.session import with_row_id

CAPACITY = 2048
GROUP_WINDOWS = 512  # windows that one group fills, about
END_ID = 1
SMALLEST = 12  # remainders are not halved below this
_BLOCK = 256


def cut(total: int, row: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    full = total // capacity
    pieces = [(k * capacity, capacity) for k in range(full)]
    at, rest = full * capacity, total - full * capacity
    halved = (row * 2654435761 >> 13) % 4 == 0
    while halved and rest >= 2 * SMALLEST:
        pieces.append((at, rest - rest // 2))
        at += rest - rest // 2
        rest //= 2
    if rest:
        pieces.append((at, rest))
    return pieces


def tokenised_pieces(
    docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of every document: `doc_id`, `start`, `length`, `doc_tokens`, `ids`, `_row`.

    `ids` are little-endian unsigned 32-bit numbers. Each document ends with `end_id`; a
    null or empty text is that id alone. `path` names the tokenizer file on every worker.
    Repeated rows and null ids are documents of their own; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        ids_of = tokenizer(path).ids
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                texts = [t or "" for t in part.column("t").to_pylist()]
                rows = part.column("_row").to_pylist()
                owner, cuts, totals, ids = [], [], [], []
                for k, text in enumerate(texts):
                    data = ids_of(text).tobytes() + end
                    n = len(data) // 4
                    for start, length in cut(n, rows[k], capacity):
                        owner.append(k)
                        cuts.append((start, length))
                        totals.append(n)
                        ids.append(data[4 * start : 4 * (start + length)])
                starts, lengths = np.array(cuts, np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(starts),
                    pa.array(lengths), pa.array(totals, pa.int64()), pa.array(ids, pa.binary()),
                    part.column("_row").take(pa.array(owner, pa.int64())),
                ], names=["doc_id", "start", "length", "doc_tokens", "ids", "_row"])

    rows = with_row_id(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t")
    ))
    return rows.mapInArrow(
        run,
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, _row bigint",
    )


def difference(lengths: np.ndarray, windows: int) -> tuple[np.ndarray, int]:
    """Karmarkar-Karp: the window of each item, and the largest window's sum.

    A partial partition holds its non-empty windows, largest first. Merging lays the
    small windows of one onto the large windows of the other.
    """
    n = len(lengths)
    left = np.full(2 * n, -1)
    right = np.full(2 * n, -1)
    made = n
    heap = [(-int(lengths[i]), i, lengths[i : i + 1].astype(np.int64), np.array([i])) for i in range(n)]
    heapq.heapify(heap)
    serial = n
    grow = [left, right]
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        b, b_nodes = b[::-1], b_nodes[::-1]
        shared = max(0, len(a) + len(b) - windows)
        lone = len(a) - shared
        sums = np.concatenate([a[:lone], a[lone:] + b[:shared], b[shared:]])
        joint = np.arange(made, made + shared)
        if made + shared > len(grow[0]):
            grow[:] = [np.concatenate([g, np.full(len(g) + shared, -1)]) for g in grow]
        grow[0][joint], grow[1][joint] = a_nodes[lone:], b_nodes[:shared]
        made += shared
        nodes = np.concatenate([a_nodes[:lone], joint, b_nodes[shared:]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        gap = sums[0] - (sums[-1] if len(sums) == windows else 0)
        heapq.heappush(heap, (-int(gap), serial, sums, nodes))
        serial += 1
    _, _, sums, nodes = heap[0]
    window = np.full(made, -1)
    window[nodes] = np.arange(len(nodes))
    for node in range(made - 1, n - 1, -1):  # parents are made after their parts
        window[grow[0][node]] = window[grow[1][node]] = window[node]
    return window[:n], int(sums[0])


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece; the window count rises until no window overflows."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    more = 1
    while True:
        placed, largest = difference(lengths, windows)
        if largest <= capacity:
            return placed
        windows += more
        more = min(more * 2, max(1, windows // 64))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (`length` of at most `capacity`, `_row`, `start`, any more columns).

    Adds `sequence_id` and `offset`, gapless from 0 in each sequence. `pieces` must be
    stored or cheap: its token count is read first, to choose the number of groups. A
    group is a hash of row and start, so no document, source or key can swell one.
    """
    short = pieces.where(F.col("length") < capacity)
    full = pieces.where(F.col("length") >= capacity)
    tokens = short.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(tokens / (GROUP_WINDOWS * capacity)))
    name = fresh(pieces, "_group")
    schema = T.StructType(list(pieces.schema)).add("sequence_id", "long").add("offset", "long")

    def place(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy().astype(np.int64)
        window = pack_group(lengths, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        first = np.searchsorted(window[order], window[order])
        offset = np.empty_like(begins)
        offset[order] = begins - begins[first]
        group = table.column(name)[0].as_py()
        return table.drop([name]).append_column(
            "sequence_id", pa.array(((group << 20) + window) * 2)
        ).append_column("offset", pa.array(offset))

    placed = (
        short.withColumn(name, F.pmod(F.xxhash64("_row", "start"), F.lit(groups)))
        .groupBy(name).applyInArrow(place, schema)
    )
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn(
        "offset", F.lit(0).cast("bigint")
    )
    return placed.unionByName(alone)


def assemble(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Sequences from packed pieces that carry `ids`: `sequence_id`, `n_tokens`, `ids`.

    A sequence has at most `capacity` ids; short ones are padded, except at a power of two.
    """
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("parts"),
    )
    joined = F.array_join(F.transform("parts", lambda p: p["ids"]), "")
    pad = "".join(f"{b:02X}" for b in np.array([pad_id], "<u4").tobytes())
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    filled = F.when(power, joined).otherwise(
        F.concat(joined, F.repeat(F.lit(pad), (F.lit(capacity) - F.col("n_tokens")).cast("int")))
    )
    return parts.select("sequence_id", "n_tokens", F.unhex(filled).alias("ids"))
