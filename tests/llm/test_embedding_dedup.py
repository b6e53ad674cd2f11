"""Embedding near-dedup against all pairs, through every path a group can take."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from harborline.llm.embedding_dedup import embedding_near_dedup, layout, near_forest

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("_uid", T.StringType()), T.StructField("root", T.StringType())])


def clusters(seed, many=12, size=6, dim=24):
    """Random vectors, chains and clouds near the threshold, copies, and every unsound vector."""
    rng = np.random.default_rng(seed)
    vectors = []
    for _ in range(many):
        at = rng.standard_normal(dim)
        for _ in range(size):
            vectors.append(at)
            at = at + rng.standard_normal(dim) * rng.choice([0.05, 0.15, 0.2])
    vectors += [vectors[0]] * 40 + [vectors[0] * 3.0] * 2 + [v for v in rng.standard_normal((30, dim))]
    rows = [(i * 7 % 997, [float(np.float32(x)) for x in v], ["a", "b", None][0 if i < 100 else i % 3]) for i, v in enumerate(vectors)]
    first = rows[0][1]
    rows += [(2000, None, "a"), (2001, [], "a"), (2002, [0.0] * dim, "a"), (2003, [math.nan] + first[1:], "a"), (2004, [math.inf] + first[1:], "a"),
             (2005, [None] + first[1:], "a"), (2006, first + [0.0], "a"), (None, first, "a"), (None, [0.0] * dim, "a"), rows[1],
             (2007, [x * 1e-30 for x in first], "a"), (2008, [x * 1e30 for x in first], "a"), (2009, first, "b"), (-5, [-0.0] * dim, None)]
    return [(*r, "i", "u", "r") for r in rows]


def brute(rows):
    n = len(rows)
    unit = []
    for _, v, label, *_ in rows:
        good = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        v = np.array(v, dtype=np.float32).astype(np.float64) if good else None
        unit.append(v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) if good else None)
    link = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.98] for i in range(n)]
    root = list(range(n))
    for i in range(n):
        seen, queue = {i}, [i]
        while queue:
            for j in link[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        root[i] = min(keys) if keys else None
    return sorted(((r[0], len(link[i]), root[i], r[0] == root[i]) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {}), (3, {"group_rows": 2}), (4, {"cell_rows": 2}), (5, {"group_rows": 3, "cell_rows": 3}), (6, {"cell_rows": 10})])
def test_all_pairs(spark, seed, options):
    rows = clusters(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = embedding_near_dedup(frame, **options).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_doubles_of_any_magnitude_and_no_rows(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(1, [1e200, 1e200], 0), (2, [1e-200, 1e-200], 0), (3, [1e200, -1e200], 0)]
    got = {r.key: (r.n_links, r.component_id) for r in embedding_near_dedup(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
    assert embedding_near_dedup(spark.createDataFrame([], schema)).count() == 0
    assert embedding_near_dedup(spark.createDataFrame([(1, None, None)], schema)).collect()[0][1:] == (0, 1, True)
    with pytest.raises(ValueError):
        embedding_near_dedup(spark.createDataFrame([], schema), threshold=1.0)


def test_pairs_at_the_threshold_share_a_key():
    """The promise of ``layout``: of pairs with cosine 0.98 nearly all agree in one key and are inside the budget."""
    rng = np.random.default_rng(0)
    bits, tables, most = layout(5000, 0.98, 1e-4)
    planes = rng.standard_normal((48, bits * tables))
    a = rng.standard_normal((4000, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 48))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * b
    differ = (a @ planes >= 0) != (b @ planes >= 0)
    assert (~differ.reshape(4000, tables, bits).any(axis=2)).any(axis=1).mean() > 0.999
    assert (differ.sum(axis=1) <= most).all()


def test_forest_reaches_what_pairs_reach():
    rng = np.random.default_rng(2)
    signs = rng.integers(0, 1 << 5, (60, 2)).astype(np.uint64)
    i, j = near_forest(signs, 1)
    near = np.bitwise_count(signs[:, None] ^ signs[None]).sum(axis=2) <= 1

    def parts(a, b):
        root = np.arange(60)
        for _ in range(60):
            for x, y in zip(a, b):
                root[x] = root[y] = min(root[x], root[y])
        return root.tolist()

    assert parts(i, j) == parts(*np.nonzero(near)) and len(i) < 60
