import math

import numpy as np

from textmart.llm.lattice import cell_keys, linked_vectors, nearest_e8, shortest_vectors
from textmart.llm import segment_search
from textmart.llm.segment_search import best_of_block, statistics, survivors, top_k

SCHEMA = "vec_id long, embedding array<float>, rank string, score int"


def odd_rows(first):
    nan, inf = float("nan"), float("inf")
    return [(first, None), (first + 1, [1.0, None, 2.0]), (first + 2, [nan] * 8), (first + 3, [inf, 1.0]), (first + 4, []), (first + 5, [0.0] * 8), (first + 6, [0.5, 0.25]), (first + 7, [0.5, 0.25]), (None, [0.5, 0.25])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.choice([-1.0, -0.3, 0.2, 0.8], (300, 8)))] + odd_rows(300)
    data = frame(spark, rows)
    got = [tuple(r) for r in top_k(data, data.where("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect()]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    want = []
    for i, v in whole:
        if i % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v))[:10]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert got == want


def test_bounds_hold_and_large_numbers_are_exact():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-1000, 1000, (20, 19)).astype(float), rng.integers(-1000, 1000, (50, 19)).astype(float)
    for segments in (1, 4, 16, 40):
        (qm, qs), (cm, cs) = statistics(q, segments), statistics(c, segments)
        assert (qm @ cm.T + qs @ cs.T >= q @ c.T - 1e-6).all()
    big = np.array([[2.0**31, 1.0, 3.0]])
    _, _, scores = best_of_block(np.array([1]), big, np.array([2]), np.array([[2.0**31 - 1, 1.0, 3.0]]), 5)
    assert scores.tolist() == [2**31 * (2**31 - 1) + 10]


def test_blocks_in_turn_equal_one_and_leave_few_pairs():
    """Vectors around centres: the floors of earlier blocks and the coarse bounds leave few pairs to the finer ones."""
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 1000, (40, 8)).repeat(8, axis=1)
    rows = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 40, (4000, 64)))
    q_ids, q, ids, k = np.arange(50), rows[:50], np.arange(4000), 10
    exact = q @ rows.T
    exact[np.arange(50), np.arange(50)] = -np.inf
    best, found, pairs = np.full((50, k), -np.inf), [], []
    for low in range(0, 4000, 500):
        block = slice(low, low + 500)
        pairs.append(len(survivors(q_ids, q, ids[block], rows[block], k, best.min(axis=1))[0]))
        a, b, scores = best_of_block(q_ids, q, ids[block], rows[block], k, best)
        found += zip(a.tolist(), (-scores).tolist(), (b + low).tolist())
    for i in range(50):
        want = sorted((-s, j) for j, s in enumerate(exact[i]) if j != i)[:k]
        assert sorted(f[1:] for f in found if f[0] == i)[:k] == want
    assert (best.min(axis=1) <= np.sort(exact, axis=1)[:, -k]).all()
    assert max(pairs[1:]) < 50 * 500 * 0.2 and sum(pairs[1:]) < 50 * 3500 * 0.1


def test_groups_of_queries_one_after_the_other(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.choice([-1.0, 0.25, 0.5], (120, 6)))]
    data = frame(spark, rows)
    want = top_k(data, data, 3).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(segment_search, "GROUP", 1)
    monkeypatch.setattr(segment_search, "BLOCK", 16)
    assert top_k(data, data, 3).orderBy("query_id", "rank").collect() == want and len(want) == 360


def test_top_k_of_empty_tables(spark):
    data = frame(spark, [(1, [0.5])])
    assert top_k(data, data.where("false")).collect() == []
    assert top_k(data.where("false"), data).collect() == []
    assert top_k(data, data).collect() == []


def test_e8_points_are_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 2, (200, 8))
    near = nearest_e8(x)
    shifted = near[:, None, :] + shortest_vectors()[None, :, :]
    assert len(shortest_vectors()) == 240 and np.allclose((shortest_vectors() ** 2).sum(axis=1), 2)
    assert (((x - near) ** 2).sum(axis=1)[:, None] <= ((x[:, None, :] - shifted) ** 2).sum(axis=2) + 1e-9).all()
    doubled = near * 2
    assert np.allclose(doubled, np.rint(doubled)) and (near.sum(axis=1) % 2 == 0).all()


def clusters(seed, sizes, noise, width=16):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.standard_normal(width)
        rows += [(centre + noise * np.linalg.norm(centre) / np.sqrt(width) * rng.standard_normal(width)).astype(np.float32) for _ in range(size)]
    return rows


def brute_links(rows):
    unit = {}
    for i, v in rows:
        if i is not None and usable(v) and any(v):
            a = np.array(v, float)
            unit[i] = a / np.sqrt((a * a).sum())
    ids = sorted(unit)
    links = {i: [j for j in ids if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in ids}
    out = {}
    for start in ids:
        todo, seen = [start], {start}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[start] = (len(links[start]), min(seen))
    return out


def test_linked_vectors_equal_brute_force(spark):
    vectors = clusters(5, [40, 1, 1, 25, 3, 2] + [1] * 30, 0.15)
    vectors += [vectors[0]] * 3  # copies
    rows = [(i * 3 % 1009, [float(x) for x in v]) for i, v in enumerate(vectors)] + odd_rows(2000)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in linked_vectors(frame(spark, rows)).collect()}
    want = brute_links(rows)
    assert len(got) == len({i for i, _ in rows})
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _, _ in got.values()) >= 0.99 * links > 0
    for i, (n, component, kept) in got.items():
        m, c = want.get(i, (0, i))
        assert n <= m and kept == (component == i or i is None)
        if n == m:
            assert component == c
    assert linked_vectors(frame(spark, rows).where("false")).collect() == []


def test_blocks_do_not_change_the_links(spark, monkeypatch):
    import textmart.llm.lattice as lattice

    vectors = clusters(6, [60, 30], 0.1)
    data = frame(spark, [(i, [float(x) for x in v]) for i, v in enumerate(vectors)])
    whole = sorted(map(tuple, linked_vectors(data).collect()))
    monkeypatch.setattr(lattice, "BLOCK", 7)
    assert sorted(map(tuple, linked_vectors(data).collect())) == whole


def test_recall_near_the_limit():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    other = rng.standard_normal(a.shape)
    other -= (other * a).sum(axis=1)[:, None] * a
    other /= np.linalg.norm(other, axis=1)[:, None]
    x, y = cell_keys(a), cell_keys(0.9 * a + np.sqrt(1 - 0.81) * other)
    met = (x[:, :, :1] == y).any(axis=(1, 2)) | (y[:, :, :1] == x).any(axis=(1, 2))
    assert met.mean() > 0.95
