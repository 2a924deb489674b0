"""Ranked lexical search by the Best Position Algorithm.

Every term of a query has an impact list: the documents that hold it, highest impact
first. Lists are read from the top in step. Each document met is scored at once by direct
accesses to the query's other lists, and every access marks its position as seen. The best
position of a list is the end of its unbroken seen stretch, which direct accesses push
beyond the last position read; the sum of the impacts there bounds every document not met
yet. Reading ends when the k-th score is strictly above that bound, so ties are complete.

Statistics (documents, terms, document frequencies) cover all documents. The lists are cut
by document into shards of `SHARD` rows, each searched where it lies: a term that most
documents hold is split like any other. A shard's k best of each query go on, which
contain the k best of all; queries come in blocks of `QUERY_BLOCK`, each against all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.session import stage, with_row_id

SHARD = 8192  # documents whose lists are searched at once
QUERY_BLOCK = 4096  # queries that one pass over the documents answers
FIRST_STEP = 16  # positions of each list that are read first; doubled from step to step

# Fixed values of the score: scale of logarithms, of impacts, and the length norm.
LOG_SCALE, IMPACT_SCALE, TF_SCALE, NORM_SCALE = 1000, 1_000_000_000, 1000, 12
FLAT, SLOPE = 75, 25

_KEPT = bytes(
    c if c >= 0x80 or chr(c).isdigit() else ord(chr(c).lower()) if chr(c).isalpha() else 0x20
    for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z
    in lower case, of a text in UTF-8; null has none."""
    return text.translate(_KEPT).split() if text else []


def _utf8(column: str) -> Column:
    return F.col(column).cast("string").cast("binary")


def query_terms(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """`_query` (a row's number), `item_id`, `term`, `times`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, t, n) for k, b in enumerate(batch.column("t").to_pylist())
                    for t, n in Counter(terms(b)).items()]
            at = pa.array([k for k, _, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("_query").take(at), batch.column("item_id").take(at),
                pa.array([t for _, t, _ in rows], pa.binary()), pa.array([n for _, _, n in rows], pa.int64()),
            ], names=["_query", "item_id", "term", "times"])

    kind = items.schema[id_col].dataType.simpleString()
    given = with_row_id(items.select(F.col(id_col).alias("item_id"), _utf8(text).alias("t")), "_query")
    return given.mapInArrow(run, f"_query bigint, item_id {kind}, term binary, times bigint")


def counted(docs: DataFrame, id_col: str, text: str, words: dict[bytes, int]) -> DataFrame:
    """`_row`, `doc_id`, `n` (terms), and `term`, `tf` of the terms in `words`, as lists."""
    spread = docs.sparkSession.sparkContext.broadcast(words)  # the terms of a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = spread.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, ends, term, tf = [], [0], [], []
                for body in part.column("t").to_pylist():
                    own = terms(body)
                    n.append(len(own))
                    if own:
                        times = Counter(own)
                        held = known.keys() & times.keys()
                        term += [known[t] for t in held]
                        tf += [times[t] for t in held]
                    ends.append(len(term))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column("_row"), part.column("doc_id"), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32())),
                ], names=["_row", "doc_id", "n", "term", "tf"])

    rows = with_row_id(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), _utf8(text).alias("t")))
    return rows.mapInArrow(run, "_row bigint, doc_id bigint, n bigint, term array<int>, tf array<int>")


def weights(found: DataFrame, documents: int) -> dict[int, int]:
    """The weight of each term of the block that any document holds."""
    held = found.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    odds = F.lit(2.0 * documents + 2) / (F.lit(2.0) * F.col("df") + 1)
    rows = held.select("term", F.floor(F.lit(float(LOG_SCALE)) * F.log(odds)).cast("bigint").alias("w"))
    return {r["term"]: r["w"] for r in rows.collect()}  # bounded by the block's terms


class Lists:
    """The impact lists of one shard, and the same entries by document."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 weight: np.ndarray, documents: int, total: int):
        if len(n) and int(n.max()) * SLOPE * documents >= 1 << 63:
            long = np.array([SLOPE * int(x) * documents // total for x in n], np.int64)
        else:
            long = SLOPE * n * documents // max(total, 1)
        norm = NORM_SCALE * (FLAT + long)
        tf = tf.astype(np.int64)
        impact = weight[term] * (IMPACT_SCALE * tf // (TF_SCALE * tf + norm[doc]))
        order = np.lexsort((doc, -impact, term))
        self.term, self.doc, self.impact = term[order], doc[order], impact[order]
        self.begin = np.searchsorted(self.term, np.arange(len(weight) + 1))
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.doc_begin = np.searchsorted(self.doc[self.by_doc], np.arange(len(n) + 1))
        self.seen = np.zeros(len(order), bool)
        self.score = np.zeros(len(n), np.int64)
        self.met = np.zeros(len(n), bool)

    def _entries_of(self, docs: np.ndarray) -> np.ndarray:
        """Places in the lists of all entries of some documents."""
        size = self.doc_begin[docs + 1] - self.doc_begin[docs]
        ends = np.cumsum(size)
        steps = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
        return self.by_doc[np.repeat(self.doc_begin[docs], size) + steps]

    def search(self, asked: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """All documents met for a query (`asked` terms, each so many `times`), their scores,
        and how many positions were read in order. The k best of the shard are among them."""
        begin, end = self.begin[asked], self.begin[asked + 1]
        full = end > begin
        begin, end, asked, times = begin[full], end[full], asked[full], times[full]
        factor = np.zeros(len(self.begin) - 1, np.int64)
        factor[asked] = times
        best, read, step = begin.copy(), begin.copy(), FIRST_STEP
        met, marked, reads = [np.zeros(0, np.int64)], [], 0
        top = np.zeros(0, np.int64)
        while (best < end).any():
            upto = np.minimum(np.maximum(read, best) + step, end)
            spans = [np.arange(a, b) for a, b in zip(np.maximum(read, best), upto, strict=True) if b > a]
            places = np.concatenate([*spans, np.zeros(0, np.int64)])
            reads += len(places)
            docs = np.unique(self.doc[places])
            docs = docs[~self.met[docs]]
            self.met[docs] = True
            met.append(docs)
            direct = self._entries_of(docs)  # direct accesses: all lists of the query
            direct = direct[factor[self.term[direct]] > 0]
            np.add.at(self.score, self.doc[direct], self.impact[direct] * factor[self.term[direct]])
            self.seen[direct] = True
            marked.append(direct)
            read = upto
            for j in range(len(best)):
                if best[j] < end[j]:
                    rest = self.seen[read[j] : end[j]]  # all before is read
                    gap = int(rest.argmin()) if len(rest) else 0
                    best[j] = end[j] if not len(rest) or rest[gap] else read[j] + gap
            # an unseen document stands after the best position of each list, or not in it
            left = best < end
            last = np.maximum(best - 1, begin)
            bound = int((self.impact[last] * times)[left].sum())
            top = np.concatenate([top, self.score[docs]])
            if len(top) > k:
                top = -np.partition(-top, k - 1)[:k]
            if len(top) >= k and int(top.min()) > bound:
                break
            step *= 2
        met_docs = np.concatenate(met)
        scores = self.score[met_docs]
        self.score[met_docs] = 0
        self.met[met_docs] = False
        for places in marked:
            self.seen[places] = False
        return met_docs, scores, reads


def best_of_shards(
    found: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray,
    documents: int, total: int, k: int, shard: int,
) -> DataFrame:
    """`_query`, `_row`, `doc_id`, `score`: the k best of each shard for every query."""
    spread = found.sparkSession.sparkContext.broadcast((queries, weight))

    def searched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked, weight = spread.value
        size = np.diff(batch.column("term").offsets.to_numpy())
        doc = np.repeat(np.arange(batch.num_rows), size)
        term, tf = (batch.column(c).flatten().to_numpy() for c in ("term", "tf"))
        useful = weight[term] > 0
        lists = Lists(batch.column("n").to_numpy(), doc[useful], term[useful], tf[useful], weight, documents, total)
        ids = batch.column("doc_id")
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        row = batch.column("_row").to_numpy()
        out = []
        for query, wanted, times in asked:
            met, scores, _ = lists.search(wanted, times, k)
            order = np.lexsort((row[met], number[met], missing[met], -scores))[:k]
            order = order[scores[order] > 0]
            out.append((np.full(len(order), query), met[order], scores[order]))
        if out:
            query, at, score = (np.concatenate(x) for x in zip(*out, strict=True))
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), batch.column("_row").take(at), ids.take(at), pa.array(score)],
                names=["_query", "_row", "doc_id", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, shard):
                part = batch.slice(at, shard)
                if held and rows + part.num_rows > shard:
                    yield from searched(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield from searched(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    wanted = found.where(F.size("term") > 0)
    return wanted.mapInArrow(run, "_query bigint, _row bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", id_col: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", shard: int = SHARD, block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k highest-scoring documents of every item: `item_id`, `rank`, `doc_id`, `score`.

    `docs` and `items` are tables read from files. Scores of 0 give no row, so an item
    without known terms has none, nor has a null or empty text on either side. Equal scores
    go by `doc_id`, null ids last; repeated documents, and items of one id, count each for
    themselves. Extra columns are not read, whatever their names. Texts are read whole.
    Empty tables give an empty result.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    asked = stage(query_terms(items, item_id, item_text), "query-terms")
    blocks = max(1, -(-asked.select("_query").distinct().count() // block))
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("_query"), F.lit(blocks)))
    results = []
    for number in range(blocks):  # a bounded set of queries against all documents
        mine = dealt.where(F.col("_block") == number).collect()
        words: dict[bytes, int] = {}
        for r in mine:
            words.setdefault(bytes(r["term"]), len(words))
        found = stage(counted(docs, id_col, text, words), "counted")
        documents, total = found.agg(
            F.coalesce(F.sum((F.col("n") > 0).cast("bigint")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
        ).first()
        weight = np.zeros(len(words), np.int64)
        for term, w in weights(found, documents).items():
            weight[term] = w
        by_query: dict[int, list[tuple[int, int]]] = {}
        for r in mine:
            by_query.setdefault(r["_query"], []).append((words[bytes(r["term"])], r["times"]))
        queries = []
        for query, pairs in by_query.items():
            pairs = np.array(sorted(p for p in pairs if weight[p[0]] > 0), np.int64).reshape(-1, 2)
            queries.append((query, pairs[:, 0], pairs[:, 1]))
        names = dealt.where(F.col("_block") == number).select("_query", "item_id").distinct()
        best = best_of_shards(found, queries, weight, documents, total, k, shard)
        order = W.partitionBy("_query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "_row")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        results.append(stage(
            ranked.join(names, "_query").select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked"
        ))
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item_id").cast(kind), "rank", "doc_id", "score")
