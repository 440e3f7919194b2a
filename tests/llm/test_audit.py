import itertools
import math
import random
import re

import pytest

from cadence.llm import audit as A


def brute(docs, labels):
    """Every order applied to every document of a part, one after the other. Rows: (doc_id, text, source)."""
    texts = [(i, t or "", s or "") for i, t, s in docs]
    least = {}
    for i, t, _ in texts:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    fails = []
    for i, t, _ in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({c for c, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and i > least[t])) if bad})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {s for _, _, s in texts}:
        mine = [(i, f) for (i, _, s), f in zip(texts, fails) if s == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, c in enumerate(order):
                gone, left = [x for x in left if c in x[1]], [x for x in left if c not in x[1]]
                total[c] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(c in f for _, f in mine) - len(gone), sum(f == {c} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(total[order[k - 1]])
    return out


def rows(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


def test_documents(spark):
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(80)}" for _ in range(rng.choice([10, 55, 90]))) + rng.choice(["", " #", " AB\x0bCDEFGHIJKLMNOP\x1c"])
            for _ in range(25)] + ["", None, " \t\n", "é" * 40 + " É", "A" * 60_000 + " b" * 3000]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice([None, "", "a", "b", "ü"])) for _ in range(300)]
    labels = [(rng.choice([None, *range(70)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(80)]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, source string, n long, part string").repartition(5)
    lab = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, mask int")
    got = rows(A.interaction_audit(A.failure_counts(d, lab)))
    assert got == brute(docs, labels)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.interaction_audit(A.failure_counts(none, labels)).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, source string")
    got = A.interaction_audit(A.failure_counts(one, labels)).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_orders_and_swaps(n):
    order, seen = list(range(n)), [tuple(range(n))]
    rng = random.Random(n)
    counts = {m: tuple(rng.randrange(5) for _ in range(3)) for m in rng.sample(range(1 << n), max(1, (1 << n) * 2 // 3))}
    diagram = A.Diagram(counts, tuple(order))
    for k in A.adjacent_swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.append(tuple(order))
        diagram.swap(k)
        fresh = A.Diagram(counts, tuple(order))
        assert diagram.steps() == fresh.steps()
        assert [len(x) for x in diagram.nodes] == [len(x) for x in fresh.nodes]  # stays reduced
        assert [diagram.only(f) for f in range(n)] == [counts.get(1 << f, (0, 0, 0)) for f in range(n)]
    assert len(seen) == len(set(seen)) == math.factorial(n)


def test_equal_branches_are_one_node():
    counts = {m: (2, 1, 0) for m in range(32)}
    assert [len(x) for x in A.Diagram(counts, (0, 1, 2, 3, 4)).nodes] == [1] * 6
