"""Jaccard self-join of word n-gram sets, by token-combination prefixes.

A document of s shingles that is similar enough to another may miss e of its shingles in
it. In any order of all shingles that is the same for every document, a prefix in which
more than e shingles would be missed therefore meets the other's prefix. Shingles are of
two classes. One of at most `RARE` documents counts as missed when it is not shared, and
is indexed alone. Frequent ones are dealt into groups; all but one of a group's count as
missed unless two of the group are shared, so the prefix is extended by one for each group,
and pairs of one group are indexed. A common passage thus brings two documents together
only if they share combinations of it, and only if rarer shingles do not settle it before.

The order is: shingles of small hash (the front, about a third) by document frequency, then
the others. So only the front of a set is counted and indexed; a document whose front is
too short for its prefix gives its whole set. Fronts and groups depend on the scale of the
smaller size of a pair, and a document is indexed for each scale that its partners can have.

Copies are one set. Documents that share an entry are compared by their whole sets: first
all with two members of each entry, then, block by block, those that are not connected yet.
What counts is whether documents are connected, so links inside a component are not asked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.simhash import shingle_set
from clickloom.operators.joins import lookup
from clickloom.session import stage, with_row_id

WORDS = 5
PERCENT = 80
RARE = 10  # documents of a shingle that is indexed alone
_HOT = 64  # entries of one shingle that a batch sends to the shingle's own place
_BLOCK = 256  # documents that are compared with as many others at once
_IDS = 1_000_000  # ids of documents to compare that are broadcast; more are shuffled
_MIX = 0x9E3779B97F4A7C15


def scales(size: int, percent: int = PERCENT) -> list[int]:
    """The scales (powers of two) of the smaller size of a pair with a set of this size."""
    least = -(-size * percent // 100)
    return list(range(least.bit_length() - 1, size.bit_length()))


def missed(size: int, percent: int) -> int:
    """Shingles of a set that a similar one can lack."""
    return size - -(-size * percent // 100)


def groups(scale: int, percent: int) -> int:
    """Groups of frequent shingles at a scale: one for about four places of a prefix."""
    return max(1, (missed(1 << scale, percent) + 1) // 4)


def front(scale: int, percent: int) -> int:
    """Hashes below this are the front at a scale."""
    share = 1.25 * (100 - percent) / 100 + 1 / math.sqrt(1 << scale)
    return (1 << 64) - 1 if scale < 6 or share >= 1 else int(share * (1 << 64))


def head(shingles: np.ndarray, percent: int) -> tuple[np.ndarray, list[int]]:
    """What a set (sorted hashes) gives to be counted, and the size of its front by scale."""
    size = len(shingles)
    if not size:
        return shingles, []
    steps = scales(size, percent)
    fronts = [int(np.searchsorted(shingles, np.uint64(front(s, percent)), side="right")) for s in steps]
    enough = all(
        n > missed(size, percent) + groups(s, percent) for n, s in zip(fronts, steps, strict=True)
    )
    return (shingles[: max(fronts)] if enough else shingles), fronts


def signatures(
    size: int, fronts: list[int], shingles: np.ndarray, frequency: np.ndarray, percent: int, rare: int
) -> np.ndarray:
    """Index entries of a set, from those of its counted shingles that others have too."""
    order = np.lexsort((shingles, frequency))
    shingles, frequency = shingles[order], frequency[order]
    out = []
    for scale, ahead in zip(scales(size, percent), fronts, strict=True):
        limit = np.uint64(front(scale, percent))
        count = groups(scale, percent)
        need = missed(size, percent) + 1
        singles: list[int] = []
        dealt: dict[int, list[int]] = {}
        inside = shingles <= limit
        for part, total in ((inside, ahead), (~inside, size - ahead)):
            need -= total - int(part.sum())  # nobody else has these
            for t, f in zip(shingles[part].tolist(), frequency[part].tolist(), strict=True):
                if need <= 0:
                    break
                if f <= rare:
                    singles.append(t)
                    need -= 1
                else:
                    own = dealt.setdefault((t * _MIX >> 20) % count, [])
                    own.append(t)
                    need -= len(own) > 1
            if need <= 0:
                break
        out += [_entry(scale, t) for t in singles]
        for own in dealt.values():
            out += [_entry(scale, a, b) for k, a in enumerate(own) for b in own[:k]]
    return np.array(out, np.uint64)


def _entry(scale: int, a: int, b: int = 0) -> int:
    if a < b:
        a, b = b, a
    return xxhash.xxh64_intdigest(a.to_bytes(8, "little") + b.to_bytes(8, "little"), scale)


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield part, [shingle_set(t, words) for t in part.column("t").to_pylist()]


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def described(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """`_row`, `doc_id`, `size`, `digest` of its set, `fronts`, and `lead`: the first of its
    task with this set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for batch in batches:
            for part, sets in _sets(batch, words):
                digests = [_digest(s) for s in sets]
                lead = []
                for d, s in zip(digests, sets, strict=True):
                    lead.append(len(s) > 0 and d not in known)
                    known.add(d)
                fronts = [head(s, percent)[1] for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("_row"), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()), pa.array(fronts, pa.list_(pa.int64())), pa.array(lead),
                ], names=["_row", "doc_id", "size", "digest", "fronts", "lead"])

    return rows.mapInArrow(
        run, "_row bigint, doc_id bigint, size bigint, digest binary, fronts array<bigint>, lead boolean"
    )


def occurrences(rows: DataFrame, words: int, percent: int, rare: int) -> DataFrame:
    """`token`, `_row`, `hot` of the counted shingles of every task's different sets.

    Of a shingle that very many documents of a batch have, some entries go to the
    shingle's place, enough to make it frequent there; the others are `hot`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for batch in batches:
            heads, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for part, sets in _sets(batch, words):
                for row, shingles in zip(part.column("_row").to_pylist(), sets, strict=True):
                    d = _digest(shingles)
                    if len(shingles) and d not in known:
                        mine = head(shingles, percent)[0]
                        heads.append(mine)
                        ids.append(np.full(len(mine), row))
                    known.add(d)
            token, row = np.concatenate(heads), np.concatenate(ids)
            order = np.argsort(token, kind="stable")
            token, row = token[order], row[order]
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            start = np.flatnonzero(new)
            place = np.arange(len(token)) - np.repeat(start, np.diff(np.append(start, len(token))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(row), pa.array(place >= max(_HOT, rare + 1))],
                names=["token", "_row", "hot"],
            )

    return rows.select("_row", "t").mapInArrow(run, "token bigint, _row bigint, hot boolean")


def shared(found: DataFrame, rare: int) -> DataFrame:
    """`_row`, `token`, `frequency` (at most rare + 1) of the shingles that two or more have.

    Entries are dealt by shingle, hot ones by entry, and read in order of the shingle:
    no more than `rare` entries of one shingle are ever held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_token, held = None, np.zeros(0, np.int64)  # entries of the last shingle so far
        full = False  # it is known to be frequent

        def made(row: np.ndarray, token: np.ndarray, frequency: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(token), pa.array(frequency.astype(np.int32))],
                names=["_row", "token", "frequency"],
            )

        for batch in batches:
            token, row = batch.column("token").to_numpy(), batch.column("_row").to_numpy()
            hot = batch.column("hot").to_numpy(zero_copy_only=False)
            if hot.any():
                yield made(row[hot], token[hot], np.full(int(hot.sum()), rare + 1))
                token, row = token[~hot], row[~hot]
            if not len(token):
                continue
            if held_token is not None and token[0] == held_token and full:
                same = token == held_token
                yield made(row[same], token[same], np.full(int(same.sum()), rare + 1))
                token, row = token[~same], row[~same]
                if not len(token):
                    continue
            elif len(held):
                token = np.concatenate([np.full(len(held), held_token), token])
                row = np.concatenate([held, row])
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(token)))
            held_token, full = token[-1], bool(size[-1] > rare)
            last = 0 if full else int(size[-1])
            held = row[len(row) - last :]
            done = np.repeat(size > 1, size)
            done[len(token) - last :] = False
            frequency = np.minimum(np.repeat(size, size), rare + 1)
            yield made(row[done], token[done], frequency[done])
        if len(held) > 1:
            yield made(held, np.full(len(held), held_token), np.full(len(held), len(held)))

    place = F.when(F.col("hot"), F.xxhash64("token", "_row")).otherwise(F.col("token"))
    dealt = found.withColumn("_place", place).repartition("_place").drop("_place")
    return dealt.sortWithinPartitions("token").mapInArrow(run, "_row bigint, token bigint, frequency int")


def indexed(common: DataFrame, sets: DataFrame, percent: int, rare: int) -> DataFrame:
    """`entry`, `id`, `size`, `alone`: the index entries of every set of `sets` (`id`, `size`,
    `fronts`), and how many in a thousand of its counted shingles few others have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, ids, sizes, alone = [np.zeros(0, np.uint64)], *([np.zeros(0, np.int64)] for _ in range(3))
            ends = batch.column("token").offsets.to_numpy()
            token = batch.column("token").flatten().to_numpy().view(np.uint64)
            frequency = batch.column("frequency").flatten().to_numpy()
            ends = ends - ends[0]
            for k, (i, n, fronts) in enumerate(zip(
                *(batch.column(c).to_pylist() for c in ("id", "size", "fronts")), strict=True
            )):
                part = slice(ends[k], ends[k + 1])
                made.append(np.unique(signatures(n, fronts, token[part], frequency[part], percent, rare)))
                ids.append(np.full(len(made[-1]), i))
                sizes.append(np.full(len(made[-1]), n))
                common = int((frequency[part] > rare).sum())
                alone.append(np.full(len(made[-1]), 1000 - 1000 * common // max(1, *fronts, ends[k + 1] - ends[k])))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(made).view(np.int64)), pa.array(np.concatenate(ids)),
                pa.array(np.concatenate(sizes)), pa.array(np.concatenate(alone)),
            ], names=["entry", "id", "size", "alone"])

    own = common.groupBy("_row").agg(F.collect_list(F.struct("token", "frequency")).alias("own"))
    full = own.withColumnRenamed("_row", "id").join(sets, "id").select(
        "id", "size", "fronts", F.col("own.token").alias("token"), F.col("own.frequency").alias("frequency")
    )
    return full.mapInArrow(run, "entry bigint, id bigint, size bigint, alone bigint")


def whole_sets(rows: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """`id`, `shingles` of some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _sets(batch, words):
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("_row"),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64))),
                ], names=["id", "shingles"])

    wanted = ids.select(F.col("id").alias("_row"))
    small = wanted.count() <= _IDS
    wanted = F.broadcast(wanted) if small else wanted.hint("shuffle_hash")
    return rows.join(wanted, "_row", "left_semi").select("_row", "t").mapInArrow(
        run, "id bigint, shingles array<bigint>"
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose sets are similar enough."""
    left, right = (sets.select(F.col("id").alias(s), F.col("shingles").alias(f"s{s}")) for s in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return (
        lookup(lookup(pairs.select("a", "b"), left, "a", "inner"), right, "b", "inner")
        .where(100 * common >= percent * union).select("a", "b")
    )


def _sized(small, large, percent: int):
    return 100 * F.least(small, large) >= percent * F.greatest(small, large)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of some sets share (of a set and itself: not told)."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((n, n), np.float32)
    for few in (True, False):
        wanted = (count > 1) & ((count <= 4) == few)
        name = np.cumsum(wanted) - 1
        keep = wanted[token]
        who, what = owner[keep], name[token[keep]]
        if few:  # pairs of owners, one by one
            order = np.argsort(what, kind="stable")
            who, what = who[order], what[order]
            for step in range(1, 4):
                same = what[step:] == what[:-step] if step < len(what) else np.zeros(0, bool)
                np.add.at(shared, (who[:-step][same], who[step:][same]), 1)
            shared += shared.T
            continue
        order = np.argsort(what, kind="stable")
        who, what = who[order], what[order]
        for lo in range(0, int(wanted.sum()), 4096):
            at = slice(*np.searchsorted(what, [lo, lo + 4096]))
            held = np.zeros((n, 4096), np.float32)
            held[who[at], what[at] - lo] = 1
            shared += held @ held.T
    return shared


def joined(
    ids: np.ndarray, roots: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links that connect all different roots which similar sets connect, no two in a circle."""
    sizes = np.array([len(x) for x in sets])
    common = _common(sets).astype(np.int64)
    near = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    near &= np.triu(roots[:, None] != roots[None, :], 1)
    if blocks.min() != blocks.max():  # each block has a turn of its own
        near &= blocks[:, None] != blocks[None, :]
    over = {int(r): int(r) for r in roots}

    def top(r: int) -> int:
        while over[r] != r:
            over[r] = r = over[over[r]]
        return r

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        x, y = top(int(roots[i])), top(int(roots[j]))
        if x != y:
            over[x] = y
            out.append((int(ids[i]), int(ids[j])))
    return out


def links_between_roots(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`a`, `b`: links between different roots among the rows of each neighbourhood
    (`near`, `id`, `root`).

    Neighbourhoods are compared by blocks of about `_BLOCK` rows, two at a time, each two
    where their sets meet; only links that join something leave a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def compared(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            hood, part, ids, roots, blocks = (
                table.column(c).to_numpy() for c in ("near", "part", "id", "root", "block")
            )
            lists = table.column("shingles").combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.chunk(0)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            new = np.ones(len(hood), bool)
            new[1:] = (hood[1:] != hood[:-1]) | (part[1:] != part[:-1])
            start = np.append(np.flatnonzero(new), len(new)).tolist()
            out = []
            for lo, hi in zip(start[:-1], start[1:], strict=True):
                if hi - lo > 1:
                    own = [flat[ends[k] : ends[k + 1]] for k in range(lo, hi)]
                    out += joined(ids[lo:hi], roots[lo:hi], blocks[lo:hi], own, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            hood, part = table.column("near").to_numpy(), table.column("part").to_numpy()
            last = int(((hood == hood[-1]) & (part == part[-1])).argmax())  # may go on
            held = table.slice(last)
            if last:
                yield compared(table.slice(0, last))
        if held is not None:
            yield compared(held)

    counted = near.groupBy("near").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")
    ).where("lo < hi")
    blocks = F.ceil(F.col("n") / _BLOCK).cast("int").alias("blocks")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    dealt = (
        lookup(near, counted.select("near", blocks), "near", "inner").select("*", own).select("*", other)
        .select("near", pair.cast("bigint").alias("part"), "block", "id", "root")
    )
    full = lookup(dealt, sets, "id", "inner").select("near", "part", "block", "id", "root", "shingles")
    return (
        full.repartition("near", "part").sortWithinPartitions("near", "part")
        .mapInArrow(run, "a bigint, b bigint")
    )


def links(entries: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """`a`, `b`: enough of the similar pairs of sets to connect all that are similar.

    The first two that the members of an entry are compared with are the one with the most
    shingles that many have (in a family of edited copies, the text they were made from),
    and another by chance.
    """
    central = F.struct("alone", F.xxhash64("id").alias("by"), "id", "size")
    chance = F.struct(F.xxhash64("id").alias("by"), "id", "size")
    members = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    counted = entries.groupBy("entry").agg(
        F.min(central).alias("lo"), F.min(chance).alias("hi"), F.count(F.lit(1)).alias("n"), *members
    ).where("n > 1")
    counted = counted.groupBy("lo", "hi", "n", "x1", "x2").agg(F.min("entry").alias("entry"))  # of equal members
    several = stage(lookup(
        entries.select("entry", "id", "size"),
        counted.select("entry", "n", F.array(
            F.struct("lo.id", "lo.size"), F.struct("hi.id", "hi.size")).alias("leads")),
        "entry", "inner",
    ), "several")
    first = several.select("id", "size", F.explode("leads").alias("lead")).where(
        (F.col("id") != F.col("lead.id")) & _sized(F.col("size"), F.col("lead.size"), percent)
    )
    asked = stage(first.select(
        F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b")
    ).distinct(), "asked")
    sets = stage(whole_sets(rows, several.select("id").distinct(), words), "sets")
    found = stage(verified(asked, sets, percent), "verified")
    roots = components(found).withColumnRenamed("node", "id")
    rooted = stage(
        lookup(several.select("entry", F.col("leads")[0]["id"].alias("near"), "id"), roots, "id")
        .withColumn("root", F.coalesce("root", "id")), "rooted",
    )
    mixed = rooted.groupBy("entry").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    near = stage(
        lookup(rooted, mixed.select("entry"), "entry", "inner").select("near", "id", "root").distinct(), "near"
    )
    return found.unionByName(stage(links_between_roots(near, sets, percent), "joined"))


def similar_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS,
    percent: int = PERCENT, rare: int = RARE,
) -> DataFrame:
    """`_row`, `doc_id`, `n_shingles`, `component_id` of every document.

    Documents link where 100 times the shingles they share are at least `percent` times
    those that either has. Words are split at ASCII white space and lower-cased A-Z only;
    repeated shingles count once; a text of fewer words is one shingle. Null texts and
    texts without words link with nothing. A component's id is its smallest doc_id (null
    only if none has one); a document without links, empty ones too, has its own. Repeated
    rows link. Texts are read whole, extra columns not at all. `docs` is a table read from
    files; an empty one gives an empty result.
    """
    rows = with_row_id(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t")
    ))
    known = stage(described(rows, words, percent), "described")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    different = stage(
        known.where("size > 0").groupBy("digest").agg(
            F.min(F.when(F.col("lead"), F.struct(F.col("_row").alias("id"), "size", "fronts"))).alias("set"),
            least.alias("least"),
        ).select("digest", "set.*", "least"), "different",
    )
    common = stage(shared(occurrences(rows, words, percent, rare), rare), "shared")
    entries = stage(indexed(common, different.select("id", "size", "fronts"), percent, rare), "entries")
    roots = components(links(entries, rows, words, percent)).withColumnRenamed("node", "id")
    rooted = different.select("id", "digest", "least").join(roots, "id", "left").withColumn(
        "root", F.coalesce("root", "id")
    )
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = stage(
        lookup(rooted.select("digest", "root"), first, "root").select("digest", F.col("first.doc_id").alias("component_id")),
        "named",
    )
    full = lookup(known.where("size > 0"), named, "digest").select("_row", "doc_id", "size", "component_id")
    empty = known.where("size = 0").select("_row", "doc_id", "size", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumnRenamed("size", "n_shingles")
