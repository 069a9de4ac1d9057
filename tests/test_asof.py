"""Point-in-time totals against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from sillage.operators.asof import asof_features, running_totals


@pytest.mark.parametrize("parts", [1, 8])
def test_running_totals_equal_plain_python(spark, parts):
    """Ties, null keys and times, and one user with a third of all rows over many ranges."""
    rnd = random.Random(parts)
    rows = [(i, 7 if i % 3 == 0 else rnd.choice([None, 1, 2, 3]), rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2, 5]), 1) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, u int, t long, v long, n long").repartition(parts)
    got = {r["id"]: (r["v_avant"], r["n_avant"]) for r in running_totals(df, "u", "t", ["v", "n"]).collect()}
    for i, u, t, _, _ in rows:
        before = [r for r in rows if u is not None and t is not None and r[1] == u and r[2] is not None and r[2] < t]
        assert got[i] == (sum(r[3] or 0 for r in before), len(before))
    assert len(got) == len(rows)


def test_totals_are_carried_over_range_borders(spark, monkeypatch):
    """Without coalescing of ranges the hot user really lies in several partitions."""
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit(1).alias("u"), F.col("id").alias("t"), F.lit(1).cast("long").alias("n"))
        out = running_totals(df, "u", "t", ["n"])
        assert out.where("n_avant != t").count() == 0 and out.count() == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)


def test_features_never_hold_the_click_itself_or_later_events(spark):
    clicks = spark.createDataFrame([(1, 5, "purchase", 10, 1.0), (2, 5, "view", 20, 2.0), (3, 5, "abandon", None, 2.0), (4, 5, "view", 3, 9.0), (5, None, "view", 3, 9.0), (6, 5, "view", 1, None)],
                                   "event_id long, user_id int, action string, duree_visite int, timestamp double")
    paid = spark.createDataFrame([(5, "succès", 10.5, 1.5), (5, "échoué", 99.0, 1.5), (5, "succès", float("nan"), 2.0)], "user_id int, statut_paiement string, montant_paye double, timestamp double")
    tickets = spark.createDataFrame([(5, "remboursement", 9.0), (5, "question", 8.0)], "user_id int, motif_contact string, timestamp double")
    got = {r["event_id"]: tuple(r)[2:] for r in asof_features(clicks, paid, tickets).collect()}
    nothing = (0, 0, 0, None, 0.0, 0, 0.0, 0, 0.0, 0, 0)
    assert got[1] == got[5] == got[6] == nothing
    assert got[2] == got[3] == (1, 1, 0, 10.0, 1.0, 5, 10.5, 1, 10.5, 0, 0)
    assert got[4] == (3, 1, 1, 15.0, 1 / 3, 5, 10.5, 2, 5.25, 1, 0)
    assert asof_features(clicks.limit(0)).count() == 0
