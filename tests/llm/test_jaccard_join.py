import random
import re

import numpy as np
import pytest

from clickloom.llm import jaccard_join

from .helpers import awkward, prose, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, percent=80):
    """Size and component of each row, all pairs compared; rows are (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append((i is None, i))
    return sorted(((i, len(sets[k]), min(least[find(k)])[1]) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def corpus(rng, count):
    """Families of edited texts around the threshold, with lines that very many share."""
    lines = [prose(9000 + k, 40) for k in range(4)]
    rows = []
    for k in range(count):
        words = prose(k % 40, rng.choice([6, 12, 30, 90, 260])).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"own{rng.randrange(9)}"
        if rng.random() < 0.4:
            words += lines[rng.randrange(4)].split()[: rng.choice([10, 40])]
        if rng.random() < 0.2:
            words = words[: rng.randrange(1, len(words) + 1)]
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("rare,percent", [(10, 80), (2, 80), (1, 80), (1000, 80), (3, 60)])
def test_components_match_brute_force(spark, tmp_path, rare, percent):
    rng = random.Random(rare)
    rows = corpus(rng, 450)
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "one Word"), (5004, "ONE word"), (None, "one word"), (3, rows[3][1])]
    docs = table(spark, str(tmp_path / "d"), rows, "doc_id bigint, text string")
    assert got(jaccard_join.similar_groups(docs, rare=rare, percent=percent)) == brute(rows, percent)


def test_similar_sets_share_an_entry_at_every_size():
    """The prefix argument itself, on pairs exactly at and just under the threshold."""
    rng = np.random.default_rng(4)
    for size in [*range(4, 40), 64, 100, 127, 128, 255, 300, 1000, 3000]:
        for _ in range(6):
            both = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            drop = jaccard_join.missed(size, 80)
            x = both
            y = np.delete(both, rng.choice(len(both), drop, replace=False))  # |x & y| / |x| >= 0.8
            frequent = set(rng.choice(both, len(both) * 3 // 4).tolist()) if rng.random() < 0.7 else set(both.tolist())
            sides = []
            for s in (x, y):
                counted, fronts = jaccard_join.head(s, 80)
                tokens = np.intersect1d(counted, np.intersect1d(x, y))  # what others have
                frequency = np.array([11 if t in frequent else 2 for t in tokens.tolist()])
                sides.append(set(jaccard_join.signatures(len(s), fronts, tokens, frequency, 80, 10).tolist()))
            assert sides[0] & sides[1], size


def test_a_hot_family_and_a_hot_line(spark, tmp_path, settings):
    rng = random.Random(1)
    base = prose(1, 120).split()
    rows = []
    for k in range(300):  # a third: near copies of one text
        words = base.copy()
        words[rng.randrange(120)] = f"e{k}"
        rows.append((k, " ".join(words)))
    line = prose(2, 60)
    rows += [(1000 + k, prose(100 + k, 40) + " " + line) for k in range(300)]  # one line, else unrelated
    rows += [(2000 + k, "same words in every one of these texts here") for k in range(300)]
    docs = table(spark, str(tmp_path / "d"), rows, "doc_id bigint, text string")
    settings({"spark.sql.execution.arrow.maxRecordsPerBatch": 150, "spark.sql.shuffle.partitions": 16})
    assert got(jaccard_join.similar_groups(docs)) == brute(rows)


def test_counts_do_not_depend_on_batches(spark, settings):
    rng = random.Random(2)
    rows = [(rng.choice([rng.randrange(5), rng.randrange(5, 300)]), k, False) for k in range(3000)]
    want = {}
    for t, *_ in rows:
        want[t] = want.get(t, 0) + 1
    frame = spark.createDataFrame(rows, "token bigint, _row bigint, hot boolean")
    for size in (1, 7, 10_000):
        settings({"spark.sql.execution.arrow.maxRecordsPerBatch": size})
        out = {(r["token"], r["_row"]): r["frequency"] for r in jaccard_join.shared(frame, 10).collect()}
        assert out == {(t, k): min(want[t], 11) for t, k, _ in rows if want[t] > 1}


def test_awkward_and_empty_tables(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(jaccard_join.similar_groups(docs)) == brute(plain)
    assert jaccard_join.similar_groups(docs.limit(0)).count() == 0


def test_links_of_a_block_are_a_forest_of_all_that_is_similar():
    rng = np.random.default_rng(5)
    base = np.arange(1, 101, dtype=np.int64)
    sets = [np.unique(np.where(rng.random(100) < rng.choice([0.02, 0.15]), rng.integers(1000, 9999, 100), base)) for _ in range(60)]
    ids, roots, blocks = np.arange(60) + 7, np.arange(60) // 2, np.zeros(60, np.int64)
    common = jaccard_join._common(sets)
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    off = ~np.eye(60, dtype=bool)
    assert (common[off] == want[off]).all()
    for blocks in (np.zeros(60, np.int64), np.arange(60) % 2):
        got_links = jaccard_join.joined(ids, roots, blocks, sets, 80)

        def classes(pairs):
            over = list(range(30))
            for i, j in pairs:
                x, y = over[roots[i]], over[roots[j]]
                over = [y if r == x else r for r in over]
            return [over.index(r) for r in over], len(set(over))

        every = [(i, j) for i in range(60) for j in range(i) if 100 * want[i, j] >= 80 * (len(sets[i]) + len(sets[j]) - want[i, j])
                 and (blocks.min() == blocks.max() or blocks[i] != blocks[j])]
        mine = [(i - 7, j - 7) for i, j in got_links]
        assert classes(mine) == classes(every) and len(mine) == 30 - classes(every)[1]
