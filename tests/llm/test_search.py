import numpy as np
from pyspark.sql import functions as F

from clickloom.llm import vafile


def run(spark, rows, every=7, k=5, block=4096):
    given = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, exact int")
    usable = given.where(vafile.usable(F.col("embedding")))
    vectors = usable.select("vec_id", vafile.whole_numbers(F.col("embedding")).alias("exact"))
    found = vafile.top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k, block)
    return sorted(tuple(r) for r in found.collect())


def brute(rows, every=7, k=5):
    """Every query row against every other row, repeats included."""
    clean = [
        (i, np.floor(256 * np.array(e, np.float32).astype(float)).astype(int)) for i, e, _ in rows
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e)
    ]
    out = []
    for n, (q, mine) in enumerate(clean):
        if q % every == 0:
            scored = sorted(
                (-int(mine @ e), c) for m, (c, e) in enumerate(clean) if m != n and len(e) == len(mine)
            )[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    return sorted(out)


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(0, [10.0, 0.0], 0), (0, [0.0, 10.0], 0), (1, [5.0, 1.0], 0), (2, [1.0, 7.0], 0), (3, [3.0, 3.0], 0)]
    assert run(spark, rows) == brute(rows)
    again = rows + rows[:2] + [(7, [5.0, 1.0], 0)] * 9 + [(14, [5.0, 1.0], 0)] * 2
    assert run(spark, again) == brute(again)
    assert run(spark, again, block=2) == brute(again)


def test_exact_on_random_vectors_in_blocks(spark):
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(0, 0.3, 16).tolist(), 0) for k in range(400)]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, block=9) == want


def test_a_hot_vector_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    hot = rng.normal(0, 0.3, 8).tolist()
    rows = [(k, hot if k % 3 else rng.normal(0, 0.3, 8).tolist(), 0) for k in range(200)]
    rows += [(700, None, 0), (701, [], 0), (702, [1.0, None] * 4, 0), (703, [float("nan")] * 8, 0),
             (707, [float("inf")] * 8, 0), (714, [0.5, -0.25], 0), (715, [0.1, 0.2], 0), (None, hot, 0), (7, rows[7][1], 0)]
    assert run(spark, rows) == brute(rows)


def test_fewer_rows_than_results_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [0.5, 0.5], 0)]
    assert run(spark, rows) == [(0, 1, 1, 256 * 128 + 512 * 128)]
    assert run(spark, [(1, None, 0)]) == []


def test_large_components_take_part(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(0, 0.3, 8) + np.eye(8)[k % 8] * (0, 2000, -2000, 1e7)[k % 4]).tolist(), 0) for k in range(120)]
    rows += [(200 + k, [1.1e7 + 2 * k, 0.25], 0) for k in range(9)]
    assert run(spark, rows, every=3, k=9) == brute(rows, every=3, k=9)


def test_bounds_hold_where_doubles_round():
    rng = np.random.default_rng(6)
    exact = rng.integers(-(2**58), 2**58, (200, 4))
    asked = rng.integers(-(2**58), 2**58, (5, 4))
    block = vafile.QueryBlock([{"_query": n, "exact": e.tolist()} for n, e in enumerate(asked)])
    low, high = block.bounds(4, (exact >> 3).astype(np.float64))
    for n, query in enumerate(asked):
        scores = vafile.products(exact, query)
        assert scores == [sum(a * b for a, b in zip(e, query.tolist(), strict=True)) for e in exact.tolist()]
        assert all(int(lo) <= s <= int(hi) for lo, s, hi in zip(low[:, n], scores, high[:, n], strict=True))
