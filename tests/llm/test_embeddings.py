import numpy as np

from cadence.llm import embeddings as E


def brute(rows, threshold=0.98):
    ok = [i for i, (v, x, lab) in enumerate(rows)
          if v is not None and lab is not None and x is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    root = {rows[i][0]: rows[i][0] for i in ok}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    links = [0] * len(rows)
    pairs = set()
    for lab, size in {(rows[i][2], len(rows[i][1])) for i in ok}:
        at = [i for i in ok if rows[i][2] == lab and len(rows[i][1]) == size]
        x = np.array([rows[i][1] for i in at], float)
        c = x @ x.T / np.outer(*[np.linalg.norm(x, axis=1)] * 2) >= threshold
        np.fill_diagonal(c, False)
        for p, q in zip(*np.nonzero(c)):
            links[at[p]] += 1
            pairs.add((at[p], at[q]))
            a, b = sorted((find(rows[at[p]][0]), find(rows[at[q]][0])))
            root[b] = a
    return links, [find(r[0]) if r[0] in root else r[0] for r in rows], pairs


def _compare(got, rows):
    links, component, pairs = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    found = sum(min(sum(r.n_links for r in by[v]) / len(by[v]), n) for (v, _, _), n in zip(rows, links))
    assert all(r.n_links <= max(n for (v, _, _), n in zip(rows, links) if v == r.vec_id) for r in got)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    same = sum(by[v][0].component_id == c for (v, _, _), c in zip(rows, component))
    return found / max(sum(links), 1), same / len(rows)


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    rng = np.random.default_rng(9)
    for v, x, lab in rows[:400]:  # planted partners with cosines from 0.98 up
        x = np.array(x)
        u = rng.normal(size=len(x))
        u -= u @ x / (x @ x) * x
        c = rng.uniform(0.9801, 1)
        rows.append((10**6 + v, (c * x / np.linalg.norm(x) + np.sqrt(1 - c * c) * u / np.linalg.norm(u)).tolist(), lab))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    recall, same = _compare(E.near_duplicates(df).collect(), rows)
    assert recall >= 0.98 and same >= 0.99, (recall, same)


def test_many_cells_and_parts(spark, monkeypatch):
    monkeypatch.setattr(E, "CELL", 8)
    monkeypatch.setattr(E, "PART", 50)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    x = np.concatenate([base, base[:150] + 0.03 * rng.normal(size=(150, 16)), base[0] + 0.04 * rng.normal(size=(200, 16)),
                        np.repeat(base[1:2], 100, axis=0)])
    rows = [(i, [float(c) for c in v], int(i % 2) if i >= 300 else 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    recall, same = _compare(E.near_duplicates(df).collect(), rows)
    assert recall >= 0.97 and same >= 0.97, (recall, same)


def test_traversal_is_by_distance():
    rng = np.random.default_rng(1)
    index = E.MultiIndex(rng.normal(size=(500, 8)), 7, 0.98, 0.99)
    x = rng.normal(size=(20, 8))
    first, second = index.distances(x)
    for a, b, cells in zip(first, second, index.traverse(x)):
        sums = (a[:, None] + b[None, :]).ravel()
        assert index.k == 7 and len(set(cells.tolist())) == index.visits
        assert np.allclose(np.sort(sums)[:index.visits], sums[cells])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [1.0, 0.0, 0.0], 1), (11, [2.0, 0.0], 1), (11, [2.0, 0.0], 1),
            (None, [1.0, 0.0], 1), (12, [], 1), (13, [-1.0, -0.0], 1), (14, [-1.0, 0.0], 1), (15, [5.0], 1), (16, [3.0], 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = E.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[11] == (3, 1, False)
    assert by[13] == (1, 13, True) and by[14] == (1, 13, False) and by[16] == (1, 15, False) and by[None] == (0, None, False)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12))
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_production_cells_large_label_beside_many_small(spark):
    """One label of 10,000 vectors has 8 x 8 cells with the production parameters; 200 labels of a few vectors have
    one cell each. Links count the same on both sides."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(4000, 16))
    near = base[rng.integers(0, 4000, 6000)]
    u = rng.normal(size=near.shape)
    u -= (u * near).sum(axis=1, keepdims=True) / (near * near).sum(axis=1, keepdims=True) * near
    c = rng.uniform(0.975, 1, size=(6000, 1))
    near = c * near + np.sqrt(1 - c * c) * u / np.linalg.norm(u, axis=1, keepdims=True) * np.linalg.norm(near, axis=1, keepdims=True)
    x = np.concatenate([base, near])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(20_000 + i, (x[i % 3] + 0.01 * rng.normal(size=16)).tolist(), 1 + i % 200) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in E.near_duplicates(df).collect()}
    links, component, pairs = brute(rows)
    wrong = [v for (v, _, _), n in zip(rows, links) if got[v].n_links != n]
    assert sum(got[v].n_links for v, _, _ in rows) >= 0.985 * sum(links)
    assert len(wrong) <= 0.01 * len(rows) and all(v < 20_000 for v in wrong)
    # A lost pair is lost on both of its sides: what is missing adds up in pairs within what is near.
    missing = {v: n - got[v].n_links for (v, _, _), n in zip(rows, links)}
    assert min(missing.values()) >= 0 and sum(missing.values()) % 2 == 0
    for v in wrong:
        assert any(missing[rows[q][0]] for p, q in pairs if rows[p][0] == v)


def test_many_lengths(spark):
    rows = [(100 * n + i, [1.0] * (n - 1) + [1.0 + 0.01 * i], 1) for n in range(1, 25) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df).collect()}
    assert all(got[100 * n + i] == (2, 100 * n) for n in range(1, 25) for i in range(3))
