"""Removal of repeated byte strings, by prefix-free parsing of the corpus.

Texts are parsed into phrases (`phrases`); every window of `length` bytes lies in one
phrase. The parse, as rows of phrase hashes, gives how often each phrase occurs: all
windows of a phrase that occurs twice are repeated. Other windows can only be repeated
inside a different phrase with the same trigger context, so the dictionary that has to be
ordered is small: one copy of each phrase whose context occurs in several phrases. Its
window suffixes are ordered bucket by bucket, by a 128-bit rank of their first `length`
bytes; neighbours of equal rank are repeats. Dictionary order and phrase counts together
tell for each place of the corpus whether its window starts anywhere else.

A context that very many phrases share is ordered window by window instead, and windows
that meet in one task are settled there, so neither a hot phrase nor a hot context is
gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import phrases
from clickloom.operators.joins import lookup
from clickloom.session import stage, with_row_id

LENGTH = 200
SHARED_MOST = 1000  # phrases of one context that are ordered together
BUCKET = 6_000  # phrases in a bucket of the dictionary, about


def text_rows(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return with_row_id(docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("body"),
    )).select("_row", "doc_id", "body")


def parse(rows: DataFrame, length: int) -> DataFrame:
    """Phrase occurrences: `key`, `phrase`, `_row`, `spot` (start, windows and lead)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, begins, size = [], [], [], 0
            for row, body in zip(batch.column("_row").to_pylist(), batch.column("body"), strict=True):
                data = memoryview(body.as_buffer())
                for lo, hi in phrases.segments(len(data), length):
                    texts.append(data[lo:hi])
                    ids.append(row)
                    begins.append(lo)
                    size += hi - lo
                    if size >= phrases.BLOCK:
                        yield _occurrences(texts, ids, begins, length)
                        texts, ids, begins, size = [], [], [], 0
            if texts:
                yield _occurrences(texts, ids, begins, length)

    return rows.select("_row", "body").mapInArrow(
        run, "key bigint, phrase bigint, _row bigint, spot bigint"
    )


def _occurrences(texts: list, ids: list, begins: list, length: int) -> pa.RecordBatch:
    limits = np.cumsum([len(t) for t in texts])
    found = phrases.parse(np.frombuffer(b"".join(texts), np.uint8), length, limits)
    owner = np.searchsorted(limits, found.start, side="right")
    start = found.start - np.concatenate([[0], limits[:-1]])[owner] + np.array(begins)[owner]
    spot = start << 16 | found.count << 8 | found.lead
    return pa.RecordBatch.from_arrays([
        pa.array(found.key.view(np.int64)), pa.array(found.phrase.view(np.int64)),
        pa.array(np.array(ids)[owner]), pa.array(spot),
    ], names=["key", "phrase", "_row", "spot"])


def _start(spot: Column) -> Column:
    return F.shiftright(spot, 16)


def _count(spot: Column) -> Column:
    return F.shiftright(spot, 8).bitwiseAND(F.lit(255))


def _ranks(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(
        phrases.Rolling(data, which).ranges(starts, starts + length) for which in (0, 1)
    )


_ENTRY = "h1 bigint, h2 bigint, _row bigint, start bigint, windows int, once boolean, body binary"


def dictionary(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Read the dictionary's phrases (`wanted`: `_row`, `list` of places) from the texts.

    A phrase of an ordinary context is one entry with its bytes. For a context that many
    phrases share every window is an entry with its rank; windows found twice in a batch
    are settled at once and go on as one entry; a run of n settled windows has `windows` -n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, hot = [], []
            for row, body, places in zip(
                batch.column("_row").to_pylist(), batch.column("body"),
                batch.column("list").to_pylist(), strict=True,
            ):
                data = memoryview(body.as_buffer())
                for p in places:
                    start, windows = p["spot"] >> 16, p["spot"] >> 8 & 255
                    part = bytes(data[start : start + windows - 1 + length])
                    if p["shared"]:
                        hot.append((row, start, windows, p["once"], part))
                    else:
                        out.append((p["key"], 0, row, start, windows, p["once"], part))
            yield from _entries(out)
            for at in range(0, len(hot), 2048):
                yield from _windows(hot[at : at + 2048], length)

    return rows.join(wanted.hint("shuffle_hash"), "_row").select(
        "_row", "doc_id", "body", "list"
    ).mapInArrow(run, _ENTRY)


_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
_NAMES = ["h1", "h2", "_row", "start", "windows", "once", "body"]


def _entries(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 4096):
        columns = zip(*rows[at : at + 4096], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
        )


def _windows(hot: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    counts = np.array([h[2] for h in hot])
    first = np.cumsum([0, *(len(h[4]) for h in hot[:-1])])
    owner = np.repeat(np.arange(len(hot)), counts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    data = np.frombuffer(b"".join(h[4] for h in hot), np.uint8)
    h1, h2 = _ranks(data, first[owner] + step, length)
    row = np.array([h[0] for h in hot])[owner]
    start = np.array([h[1] for h in hot])[owner] + step
    once = np.array([h[3] for h in hot])[owner]
    order = np.lexsort((h2, h1))
    same = np.zeros(len(order), bool)
    same[1:] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
    again = same.copy()
    again[:-1] |= same[1:]  # every window that has an equal one in the batch
    settled = order[again & once[order]]
    lead = order[~same]
    once_left = once.copy()
    once_left[order[again]] = False
    settled, runs = _runs(np.sort(settled), owner, step)
    for index, windows in ((lead, np.ones(len(lead), np.int32)), (settled, -runs)):
        n = len(index)
        yield pa.RecordBatch.from_arrays([
            pa.array(h1[index].view(np.int64)), pa.array(h2[index].view(np.int64)),
            pa.array(row[index]), pa.array(start[index]), pa.array(windows.astype(np.int32)),
            pa.array(once_left[index]), pa.nulls(n, pa.binary()),
        ], names=_NAMES)


def _runs(index: np.ndarray, owner: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and length of the runs of neighbouring windows of one phrase."""
    new = np.ones(len(index), bool)
    new[1:] = (owner[index[1:]] != owner[index[:-1]]) | (step[index[1:]] != step[index[:-1]] + 1)
    begin = np.flatnonzero(new)
    return index[begin], np.diff(np.append(begin, len(index)))


def _repeated(length: int):
    def run(table: pa.Table) -> pa.Table:
        """Spans of the entries' repeated windows, in one bucket of the dictionary."""
        table = table.combine_chunks()
        windows = table.column("windows").to_numpy()
        row, start = table.column("_row").to_numpy(), table.column("start").to_numpy()
        whole = np.flatnonzero(windows < 0)
        spans = [(row[whole], start[whole], start[whole] - windows[whole] - 1 + length)]
        parts = [b or b"" for b in table.column("body").to_pylist()]
        sizes = np.array([len(p) for p in parts])
        open_ = windows > 0
        counts = np.where(open_, windows, 0)
        owner = np.repeat(np.arange(len(parts)), counts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        h1 = table.column("h1").to_numpy().view(np.uint64)[owner]
        h2 = table.column("h2").to_numpy().view(np.uint64)[owner]
        read = sizes[owner] > 0
        if read.any():
            data = np.frombuffer(b"".join(parts), np.uint8)
            first = np.cumsum(sizes) - sizes
            h1[read], h2[read] = _ranks(data, first[owner[read]] + step[read], length)
        order = np.lexsort((h2, h1))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
        hit = np.zeros(len(order), bool)
        hit[order] = same[:-1] | same[1:]
        once = table.column("once").to_numpy(zero_copy_only=False)
        hit &= once[owner]
        begin, runs = _runs(np.flatnonzero(hit), owner, step)
        first = start[owner[begin]] + step[begin]
        spans.append((row[owner[begin]], first, first + runs - 1 + length))
        return pa.table({
            name: np.concatenate([s[k] for s in spans]).astype(np.int64)
            for k, name in enumerate(("_row", "start", "end"))
        })

    return run


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """`_row`, `start`, `end` (bytes) of strings of at least `length` that occur elsewhere.

    Spans may overlap. `rows` are those of `text_rows`.
    """
    found = parse(rows, length)
    contexts = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = stage(lookup(found, contexts, "key", "inner"), "occurrences")
    distinct = stage(
        shared.groupBy("key", "phrase").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("_row", "spot")).alias("at")
        ), "phrases",
    )
    several = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = stage(
        lookup(distinct, several, "key", "inner").select(
            "key", "at._row", "at.spot", (F.col("n") == 1).alias("once"),
            (F.col("kinds") > SHARED_MOST).alias("shared"),
        ), "wanted",
    )
    entries, single = wanted.agg(
        F.count(F.lit(1)), F.sum(F.when(F.col("shared"), _count(F.col("spot"))))
    ).first()
    buckets = max(1, round(entries / BUCKET + (single or 0) / (40 * BUCKET)))
    lists = wanted.groupBy("_row").agg(
        F.collect_list(F.struct("spot", "key", "once", "shared")).alias("list")
    )
    ordered = (
        dictionary(rows, lists, length)
        .withColumn("bucket", F.pmod(F.xxhash64("h1"), F.lit(buckets)))
        .groupBy("bucket").applyInArrow(_repeated(length), "_row bigint, start bigint, end bigint")
    )
    again = distinct.where("n > 1").select(F.struct("key", "phrase").alias("pair"))
    pairs = shared.select(F.struct("key", "phrase").alias("pair"), "_row", "spot")
    often = lookup(pairs, again, "pair", "inner").select(
        "_row", _start(F.col("spot")).alias("start"),
        (_start(F.col("spot")) + _count(F.col("spot")) + (length - 1)).alias("end"),
    )
    return often.unionByName(ordered)


def merged(spans: list[dict]) -> np.ndarray:
    """Sorted, maximal spans of a list that may overlap or touch."""
    if not spans:
        return np.zeros((0, 2), np.int64)
    both = np.array(sorted((s["start"], s["end"]) for s in spans), np.int64)
    reach = np.maximum.accumulate(both[:, 1])
    new = np.concatenate([[True], both[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(both) - 1]])
    return np.column_stack([both[new, 0], reach[last]])


def remove_repeats(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH
) -> DataFrame:
    """Per document: `_row`, `doc_id`, `n_bytes`, `spans` (maximal removed runs), `kept`.

    Texts are UTF-8 bytes; every byte of a string of `length` bytes that also starts
    anywhere else, in the same document too, is removed, judged on the input. `kept` is
    the remaining bytes, which may not be whole characters. Null and empty texts are kept
    empty. Repeated rows count as documents of their own; other columns are not read; an
    empty table gives an empty result.
    """
    rows = text_rows(docs, text, id_col)
    lists = repeated_spans(rows, length).groupBy("_row").agg(
        F.collect_list(F.struct("start", "end")).alias("found")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                spans, kept, sizes = [], [], []
                for body, found in zip(part.column("body"), part.column("found").to_pylist(), strict=True):
                    data = body.as_py()
                    runs = merged(found or [])
                    cuts = np.concatenate([[0], runs.ravel(), [len(data)]]).tolist()
                    kept.append(b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
                    spans.append([{"start": a, "end": b} for a, b in runs.tolist()])
                    sizes.append(len(data))
                yield pa.RecordBatch.from_arrays([
                    part.column("_row"), part.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.array(spans, _SPANS), pa.array(kept, pa.binary()),
                ], names=["_row", "doc_id", "n_bytes", "spans", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(lists.hint("shuffle_hash"), "_row", "left").select(
        "_row", "doc_id", "body", "found"
    ).mapInArrow(
        run,
        f"_row bigint, doc_id {kind}, n_bytes bigint, "
        "spans array<struct<start:bigint,end:bigint>>, kept binary",
    )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
