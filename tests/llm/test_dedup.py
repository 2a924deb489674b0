import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from clickloom.llm import anchors, components, exact_dedup, simhash

from .helpers import awkward, prose, table


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_groups_on_awkward_rows(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == 10
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) == 5
    by = {}
    for r in got:
        by.setdefault(r["text_sha256"], []).append(r)
    fox = by[hashlib.sha256(norm("The quick brown fox").encode()).hexdigest()]
    assert len(fox) == 3 and {r["keep_id"] for r in fox} == {5}  # most code points
    empty = by[hashlib.sha256(b"").hexdigest()]
    assert {r["doc_id"] for r in empty} == {2, 3, 6} and empty[0]["keep_id"] == 6
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and left.count() == 5


def test_repeated_rows_keep_one(spark, tmp_path):
    docs = table(spark, str(tmp_path / "d"), [(1, "same", "en", "a", 4)] * 50)
    got = exact_dedup.exact_groups(docs)
    assert got.where("kept").count() == 1 and got.first()["group_size"] == 50
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("lanes,fan_in", [(1, 8), (4, 2), (64, 8), (27, 3), (20, 8)])
def test_every_tree_gives_the_same_groups(spark, tmp_path, lanes, fan_in):
    rng = random.Random(4)
    rows = [(k, prose(rng.randrange(20) if rng.random() < 0.7 else 0, 6), "en", "a", 0) for k in range(300)]
    docs = table(spark, str(tmp_path / "d"), rows)
    want = {}
    for k, text, *_ in rows:
        want.setdefault(norm(text), []).append((-len(text), k))
    for r in exact_dedup.exact_groups(docs, lanes=lanes, fan_in=fan_in).collect():
        group = want[norm(rows[r["doc_id"]][1])]
        assert (r["keep_id"], r["group_size"]) == (min(group)[1], len(group))


def test_no_python_runs_in_exact_dedup(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    plan = exact_dedup.exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_anchor_code_is_perfect():
    words = np.arange(1 << 14) * 509 % (1 << 23)
    leaders = anchors._leaders()[anchors._syndromes()[words]]
    assert max(int(x).bit_count() for x in leaders) <= 3
    assert len(np.unique(anchors.anchor(np.arange(1 << 23)))) == 4096


def test_copies_reach_every_home_within_the_threshold():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 200)
    index, anchor = simhash.copied_anchors(prints, 2)
    reach = {}
    for i, a in zip(index, anchor, strict=True):
        reach.setdefault(int(i), set()).add(int(a))
    for i in range(200):
        for _ in range(20):
            flips = sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 3), replace=False))
            home = simhash.home_anchors(np.array([int(prints[i]) ^ flips]))[0]
            assert int(home) in reach[i]


def bits(text, n):
    words = (text or "").encode().translate(simhash._LOWER).split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_near_groups_match_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for k in range(240):
        words = prose(k % 60, 40).split()
        if rng.random() < 0.4:
            words[rng.randrange(40)] = "other"
        rows.append((k, " ".join(words[: rng.choice([2, 40, 40])]), "en", "a", 0))
    rows += [(900, None, None, None, None), (901, "", "en", "a", 0)]
    docs = table(spark, str(tmp_path / "d"), rows)
    fps = {k: bits(t, 3) for k, t, *_ in rows}
    parent = {k: k for k in fps}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r["doc_id"]: r for r in simhash.near_groups(docs).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == {k: find(k) for k in fps}
    assert all(r["p"] & (1 << 64) - 1 == fps[k] for k, r in got.items())


def test_near_groups_on_awkward_rows(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    got = simhash.near_groups(docs).collect()
    assert len(got) == 10 and len({r["keep_row"] for r in got}) == 5
    assert {r["component_id"] for r in got if r["doc_id"] in (2, 3, 6)} == {2}
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert simhash.near_groups(docs.limit(0)).count() == 0
    left = simhash.drop_near_groups(docs)
    assert left.columns == docs.columns and left.count() == 5


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 150)}
    assert components.components(frame.limit(0)).count() == 0
