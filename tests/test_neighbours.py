"""Nearest neighbours and SMOTE against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sillage.operators import neighbours
from sillage.operators.neighbours import nearest
from sillage.operators.smote import balanced, ranked, smote

COLS = ["a", "b", "c"]


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + 3 * i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")


def brute(x, k):
    d = np.zeros((len(x), len(x)))
    for c in range(x.shape[1]):
        d += (x[:, c, None] - x[:, c]) ** 2
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), d), axis=1)[:, : min(k, len(x) - 1)]
    return {(3 * i, r + 1, 3 * int(j)): d[i, j] for i, row in enumerate(order) for r, j in enumerate(row)}


def vectors(kind):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(900, 3)) * [1, 10, 1000]
    if kind == "copies":  # a third of all rows alike, and groups of a few
        x[:300] = x[0]
        x[300:420] = np.repeat(x[300:330], 4, axis=0)
    if kind == "ties":
        x = rnd.integers(0, 4, (400, 3)).astype(float)
    if kind == "line":  # one column rules all projections
        x[:, :2] = 0
    return x


@pytest.mark.parametrize("kind", ["plain", "copies", "ties", "line"])
def test_nearest_is_exact(spark, kind):
    x = vectors(kind)
    want = brute(x, 5)
    for leaf, visitors in ((10_000, 50_000), (40, 30)):
        got = {(r["id"], r["rang"], r["neighbour"]): r["distance"] for r in nearest(frame(spark, x), "id", COLS, 5, leaf, visitors).collect()}
        assert got == want


def test_nearest_of_few_rows(spark):
    x = vectors("plain")
    for n in (0, 1, 2, 4):
        got = nearest(frame(spark, x[:n]) if n else frame(spark, x[:1]).limit(0), "id", COLS).collect()
        assert len(got) == n * (n - 1)
    odd = spark.createDataFrame([(1, None, 0.0, 1.0), (2, 0.0, -0.0, 1.0), (None, 1.0, 1.0, 1.0)], "id long, a double, b double, c double")
    assert [(r["id"], r["neighbour"], r["distance"]) for r in nearest(odd, "id", COLS).orderBy("id").collect()] == [(1, 2, 0.0), (2, 1, 0.0)]


def test_ranks_number_the_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("v"), "id")
    got = [(r["v"], r["id"]) for r in ranked(df.repartition(7), ["v", "id"], "place").orderBy("place").collect()]
    assert got == sorted(got) and [r["place"] for r in ranked(df, ["v", "id"], "place").orderBy("place").collect()] == list(range(1000))


def test_smote_rows_lie_between_true_neighbours(spark):
    x = vectors("copies")
    y = [1 if i % 3 == 0 else 0 if i % 3 == 1 or i > 600 else 2 for i in range(len(x))]
    df = frame(spark, x).withColumn("y", F.element_at(F.array(*[F.lit(v) for v in y]), (F.col("id") / 3 + 1).cast("int")))
    near = {}
    for c in set(y):
        of = [i for i in range(len(x)) if y[i] == c]
        for (i, _, j) in brute(x[of], 5):
            near.setdefault(3 * of[i // 3], set()).add(3 * of[j // 3])
    counts = {c: y.count(c) for c in set(y)}
    made = smote(df, "y", "id", COLS, leaf=40).collect()
    for c, n in counts.items():
        assert sorted(r["numero"] for r in made if r["y"] == c) == list(range(max(counts.values()) - n))
    for r in made:
        a, b = x[r["base_id"] // 3], x[r["voisin_id"] // 3]
        assert r["voisin_id"] in near[r["base_id"]] and 0 <= r["part"] < 1
        assert np.array_equal([r[c] for c in COLS], a + r["part"] * (b - a))
    per = {r["y"]: r["count"] for r in balanced(df, "y", "id", COLS).groupBy("y").count().collect()}
    assert set(per.values()) == {max(counts.values())}
    again = smote(df.repartition(5), "y", "id", COLS).collect()
    assert sorted(map(tuple, made)) == sorted(map(tuple, again))


def test_smote_of_one_row_and_of_balanced_classes(spark):
    one = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (3, 0, 3.0), (4, 1, 7.0), (5, None, 9.0)], "id long, y int, a double")
    assert [(r["base_id"], r["voisin_id"], r["a"]) for r in smote(one, "y", "id", ["a"]).collect()] == [(4, None, 7.0)] * 2
    assert smote(one.where("id in (1, 4)"), "y", "id", ["a"]).count() == 0
    assert smote(one.limit(0), "y", "id", ["a"]).columns == ["y", "numero", "base_id", "voisin_id", "part", "a"]


@pytest.mark.parametrize("kind", ["plain", "ties", "line"])
def test_parts_of_many_leaves_are_cut_by_aggregates(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "LEAVES", 2)
    x = vectors(kind)
    got = {(r["id"], r["rang"], r["neighbour"]): r["distance"] for r in nearest(frame(spark, x), "id", COLS, 5, 20, 50).collect()}
    assert got == brute(x, 5)


def test_few_leaves_are_visited(spark, monkeypatch):
    """Columns of very different spread: a ball meets few boxes (12,248 visits by slabs of random directions)."""
    rnd = np.random.default_rng(5)
    x = np.column_stack([rnd.normal(size=3000) * 1000, rnd.normal(size=3000) * 100, rnd.integers(0, 3, (3000, 6))])
    cols = list("abcdefgh")
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in cols))
    rows, kept = [], neighbours.materialize

    def counted(df, name):
        out = kept(df, name)
        rows.extend([out._sillage_rows] if name == "visits" else [])
        return out

    monkeypatch.setattr(neighbours, "materialize", counted)
    assert nearest(df, "id", cols, 5, 50).count() == 15_000
    assert len(rows) == 1 and rows[0] < 9_000
