import numpy as np
import pytest

from clickloom.llm import mixing

from .helpers import awkward, prose, table


def water_fill(sizes):
    """Share by weight, stop at twice the size, share the excess again until none is above."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, fixed = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in fixed]
        level = (budget - sum(2 * sizes[s] for s in fixed)) / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in fixed else level * weight[s] for s in names}
        fixed |= above


def corpus():
    sources = ["é", "b", "a", None, "Z", "𝔘", "ﬀ"]
    return [(k, prose(k, 3 + 11 * k % 90), "en", sources[0 if k % 3 == 0 else k % 7], 0) for k in range(700)]


@pytest.mark.parametrize("leaf,fan", [(4096, 1024), (8, 2)])
def test_targets_and_words(spark, tmp_path, monkeypatch, leaf, fan):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN_IN", fan)
    rows = corpus()
    docs = table(spark, str(tmp_path / "d"), rows)
    got = mixing.mix_plan(docs).collect()
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = water_fill(sizes)
    taken, open_ = {}, {}
    source_of = {r[0]: r[3] for r in rows}
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["target"] == pytest.approx(want[s]) and r["source_size"] == sizes[s]
        assert r["taken"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        open_[s] = open_.get(s, 0) + (r["taken"] % r["size"] > 0)
    assert len(got) == 700 and max(open_.values()) <= 1
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixing.mix_plan(docs).select("doc_id", "taken").collect()
    assert {r["doc_id"]: r["taken"] for r in got} == {r["doc_id"]: r["taken"] for r in again}


def test_pairs_keep_words_and_expectations():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 50, 40).astype(float)
    total = np.zeros(40)
    for seed in range(3000):
        order = np.random.default_rng(seed).integers(-(1 << 62), 1 << 62, 40)
        out = mixing.round_pairs(size, 0.3 * size, order)
        assert out.sum() == pytest.approx(0.3 * size.sum())
        assert ((out > 0) & (out < size)).sum() <= 1
        total += out / size
    assert abs(total / 3000 - 0.3).max() < 0.05


def test_mixed_rows(spark, tmp_path):
    docs = table(spark, str(tmp_path / "d"), corpus())
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: c for k, c in plan.items() if c}


def test_equal_rows_share_no_leaf(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 50)
    largest = []
    tree = mixing.round_tree

    def watched(rows, leaves):
        largest.append(rows.groupBy("_source", "_leaf").count().agg({"count": "max"}).first()[0])
        return tree(rows, leaves)

    monkeypatch.setattr(mixing, "round_tree", watched)
    rows = [(7 if k % 3 else None, "one and the same text", "en", "a", 0) for k in range(1500)]
    rows += [(k, prose(k, 20), "en", "b", 0) for k in range(1500, 1600)]
    got = mixing.mix_plan(table(spark, str(tmp_path / "d"), rows)).collect()
    assert len(got) == 1600 and max(largest) <= 150
    target = {r["source_size"]: r["target"] for r in got}
    for size, want in target.items():
        assert abs(sum(r["taken"] for r in got if r["source_size"] == size) - want) <= 1


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    got = mixing.mix_plan(docs).collect()
    assert len(got) == 10 and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix_plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    only_empty = table(spark, str(tmp_path / "e"), [(1, "", "en", "a", 0), (2, None, None, None, None)])
    assert [r["taken"] for r in mixing.mix_plan(only_empty).collect()] == [0, 0]
