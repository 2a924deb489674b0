"""Near-duplicates by SimHash and anchor-point covering.

A text's fingerprint is the bitwise majority of its shingles' hashes. Blocks of 23
fingerprint bits are words of a covering code (`anchors`): a fingerprint is at home with
the anchors that cover its blocks, and is copied to every pair of anchors within the
covering radius plus the threshold. Two fingerprints within the threshold therefore meet
at the home of either, and are compared there. Equal fingerprints are one entry, so what is
compared grows with the number of different fingerprints, not with the size of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import anchors
from clickloom.llm.components import components
from clickloom.llm.names import fresh
from clickloom.operators.joins import lookup
from clickloom.session import stage, with_row_id

WORDS = 3
THRESHOLD = 2
SEED = 42
_CHUNK = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a whole text, repeats included, in bounded chunks."""
    parts = text.encode().translate(_LOWER).split()
    if not parts:
        return
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(parts))
    spans = list(zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), _CHUNK):
        chunk = spans[at : at + _CHUNK]
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in chunk), np.uint64, len(chunk))


def fingerprint(text: str | None, words: int) -> int:
    """The majority bits of a text's shingle hashes, as a signed long; repeats vote each time."""
    votes = np.zeros(64, np.int64)
    count = 0
    for hashes in shingle_hashes(text or "", words):
        count += len(hashes)
        for at in range(0, len(hashes), 255):  # so many votes fit a byte
            bits = np.unpackbits(hashes[at : at + 255, None].view(np.uint8), axis=1, bitorder="little")
            votes += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(2 * votes > count, bitorder="little").view(np.int64)[0])


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The different shingle hashes of a text, in order."""
    return np.unique(np.concatenate([*shingle_hashes(text or "", words), np.zeros(0, np.uint64)]))


def fingerprints(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS
) -> DataFrame:
    """`_row`, `doc_id`, `p` (64 bits as a signed long) of every document.

    Words are split at ASCII white space and lower-cased A-Z only. A text of fewer words
    is one shingle; a null text, or one without words, has only zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                prints = [fingerprint(t, words) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("doc_id"), pa.array(prints, pa.int64())],
                    names=["_row", "doc_id", "p"],
                )

    rows = with_row_id(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t")
    ))
    return rows.mapInArrow(run, "_row bigint, doc_id bigint, p bigint")


def _blocks(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = prints.view(np.uint64)
    low = (1 << anchors.BITS) - 1
    return (p & np.uint64(low)).astype(np.int64), (p >> np.uint64(anchors.BITS) & np.uint64(low)).astype(np.int64)


def home_anchors(prints: np.ndarray) -> np.ndarray:
    """The pair of anchors that covers the two blocks of each fingerprint, as one number."""
    first, second = _blocks(prints)
    return (anchors.anchor(first) << 12 | anchors.anchor(second)).astype(np.int64)


def copied_anchors(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor pair) for all pairs within the radius plus `threshold` flips in all.

    These are the homes of every fingerprint at most `threshold` flips away.
    """
    first, second = _blocks(prints)
    rows, pairs = [], []
    for flips in range(threshold + 1):
        i, a = anchors.anchors_within(first, flips)
        j, b = anchors.anchors_within(second, threshold - flips)
        count = np.bincount(j, minlength=len(prints))
        begin = np.concatenate([[0], np.cumsum(count)[:-1]])
        repeat = count[i]
        left = np.repeat(np.arange(len(i)), repeat)
        within = np.arange(len(left)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        right = begin[i[left]] + within
        rows.append(i[left])
        pairs.append(a[left].astype(np.int64) << 12 | b[right])
    joined = np.concatenate(rows).astype(np.int64) << 24 | np.concatenate(pairs)
    both = np.unique(joined)
    return both >> 24, both & ((1 << 24) - 1)


def _mapped(prints: DataFrame, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                p = batch.column(0).slice(at, 4096).to_numpy()
                index, anchor = make(p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(p[index])], names=["anchor", "p"]
                )

    return prints.mapInArrow(run, "anchor int, p bigint")


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """`a`, `b` of all different fingerprints (`p`) at most `threshold` bits apart.

    A link is found once, at the home of its smaller fingerprint. Fingerprints are
    distinct, so no fingerprint has more links than there are patterns of that few flips.
    """
    home = _mapped(prints, lambda p: (np.arange(len(p)), home_anchors(p)))
    copies = _mapped(prints, lambda p: copied_anchors(p, threshold))
    apart = F.bit_count(F.col("h.p").bitwiseXOR(F.col("c.p")))
    return (
        home.alias("h").join(copies.alias("c"), F.col("h.anchor") == F.col("c.anchor"))
        .where((F.col("h.p") < F.col("c.p")) & (apart <= threshold))
        .select(F.col("h.p").alias("a"), F.col("c.p").alias("b"))
    )


def near_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """`_row`, `doc_id`, `p`, `component_id`, `keep_row` of every document.

    Documents link at `threshold` or fewer differing bits (equal fingerprints always);
    a component's id is its smallest doc_id (null only if none has one), and `keep_row` is
    one row of it, that of the smallest doc_id. Texts without words link like any other.
    Repeated rows are members of their own; extra columns are not read, whatever their
    names. An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, text, id_col, words), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    different = stage(rows.groupBy("p").agg(first.alias("first")), "different")
    roots = components(links(different.select("p"), threshold))
    rooted = different.join(roots.withColumnRenamed("node", "p"), "p", "left").withColumn(
        "root", F.coalesce("root", "p")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = stage(lookup(rooted.select("p", "root"), least, "root").select("p", "least"), "named")
    return lookup(rows, named, "p").select(
        "_row", "doc_id", "p", F.col("least.doc_id").alias("component_id"),
        F.col("least._row").alias("keep_row"),
    )


def drop_near_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row of each group of `near_groups`, that of its smallest id, with all columns of
    `docs` (extra columns may have any names), which must be a table read from files.

    Texts without words (null ones too) are one group; rows without id stay only where no
    row of their group has an id; of repeated rows one stays. An empty table stays empty.
    """
    row = fresh(docs, "_row")
    kept = near_groups(docs, text, id_col, words, threshold).where(
        F.col("_row") == F.col("keep_row")
    ).select(F.col("_row").alias(row))
    return with_row_id(docs, row).join(kept.hint("shuffle_hash"), row, "left_semi").drop(row)
