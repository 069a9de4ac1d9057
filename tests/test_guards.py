"""Tables that lack columns, and encoders for columns with many labels."""

import pytest
from pyspark.sql import functions as F

from sillage.operators import analytics as A
from sillage.operators import ml as M


def test_dashboard_figures_stand_without_columns(spark):
    bare = spark.createDataFrame([("s1", 1), ("s2", 2)], "session_id string, user_id int")
    k = A.kpis(bare, bare, bare).first()
    assert (k["nb_evenements"], k["nb_transactions"], k["nb_tickets"]) == (2, 2, 2)
    assert (k["nb_achats"], k["taux_conversion"], k["revenu_total"], k["nb_echecs"]) == (0, 0.0, 0.0, 0)
    for out in (A.funnel(bare), A.category_actions(bare), A.conversion_by_minute(bare), A.value_counts(bare, "source"), A.distinct_filters(bare),
                A.review_top_words(bare, ["the"])):
        assert out.count() == 0
    assert A.filter_clicks(bare, "X", "google").count() == 2
    some = bare.withColumn("action", F.lit("purchase"))
    assert A.kpis(some).first()["nb_achats"] == 2 and A.funnel(some).first()["nb"] == 2
    assert A.conversion_by_minute(some).count() == 0 and A.category_actions(some).count() == 0


def test_codes_by_table_equal_the_encoder_model(spark, monkeypatch):
    train = spark.createDataFrame([("B", "x", "/p"), ("C", "y", None), (None, "x", "/a")], "category string, source string, page_visitee string")
    df = spark.createDataFrame([(1, "C", "x", "/p"), (2, "Z", None, "/q"), (3, None, "y", None), (4, "B", "x", "/a")], "id int, category string, source string, page_visitee string")
    cols = ["id", *(M.ENCODED[c] for c in M.BASE_ENCODED), "nb_inconnus"]
    want = sorted(map(tuple, M.fit_encoders(train, M.BASE_ENCODED).transform(df).select(*cols).collect()))
    got = M.encode_by_table(train, df, M.BASE_ENCODED)
    assert sorted(map(tuple, got.select(*cols).collect())) == want
    assert set(got.columns) == set(df.columns) | set(cols)
    monkeypatch.setattr(M, "MAX_LABELS", 1)
    with pytest.raises(ValueError):
        M.fit_encoders(train, M.BASE_ENCODED)
