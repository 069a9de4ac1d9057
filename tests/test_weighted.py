"""Weighted statistics against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sillage import schemas as S
from sillage.operators import features as E
from sillage.operators import stats as ST
from sillage.sources import fixtures as FX
from tests.conftest import SMALL


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_weighted_describe_equals_pandas(spark, coalesce):
    rnd = np.random.default_rng(5)
    rows = [(c, float(v) if v is not None else None, int(w)) for c, values in (
        ("a", rnd.normal(size=300).round(2)), ("b", [1.0]), ("c", rnd.integers(0, 3, 50)), ("d", [-0.0, 0.0, 5.0]), ("e", [None, float("nan"), 2.0, 9.0]))
        for v, w in zip(values, rnd.integers(0, 40, len(values)) + (c in "bde"))]
    rows.append(("a", 1e6, 1000))  # a value with a large share of the weight
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)  # false: columns span partitions
    try:
        out = ST.describe_weighted(spark.createDataFrame(rows, "colonne string, valeur double, poids long"), None).toPandas().set_index("colonne")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    for c in "abcde":
        x = pd.Series([v for k, v, w in rows if k == c and v is not None and v == v for _ in range(w)])
        want = x.describe()
        got = out.loc[c].rename({"p25": "25%", "p50": "50%", "p75": "75%"})
        assert got["count"] == len(x)
        for s in ("mean", "std", "min", "25%", "50%", "75%", "max"):
            assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9, nan_ok=True), (c, s)
    assert ST.describe_weighted(spark.createDataFrame([], "colonne string, valeur double, poids long")).count() == 0


def test_feature_weights_are_those_of_the_enriched_clicks(spark):
    j = FX.journey(spark, SMALL)
    odd = j.clicks.withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id"))).withColumn("category", F.when(F.col("event_id") % 11 != 0, F.col("category")))
    got = ST.describe_weighted(E.feature_weights(odd, j.transactions, j.support), 6)
    want = ST.describe(E.enriched_clicks(odd, j.transactions, j.support), S.ENRICHED_COLUMNS, 6)
    a, b = ({r["colonne"]: r for r in x.collect()} for x in (got, want))
    assert set(a) == set(b) == set(S.ENRICHED_COLUMNS)
    for c in a:
        assert list(a[c].asDict().values())[1:] == pytest.approx(list(b[c].asDict().values())[1:], abs=2e-6), c
