
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sillage import schemas as S
from sillage.functions import columns as C
from sillage.operators import analytics as A
from sillage.operators import features as E
from sillage.operators import governance as G
from sillage.operators import ml as M
from sillage.operators import quality as Q
from sillage.operators import sinks as K
from sillage.operators import stats as ST
from sillage.operators import text as T
from sillage.session import scratch_path
from sillage.sources import events as EV
from sillage.sources import fixtures as FX

SMALL = "/root/testdata/sf0.001"

CLICK_DDL = ("session_id string, user_id int, category string, price double, rating double, "
             "action string, duree_visite int, source string, review_text string, timestamp double")


def clicks(spark, rows):
    return spark.createDataFrame(rows, CLICK_DDL)


def test_bad_json_kept_as_null_row_with_corrupt_text(spark):
    df = spark.createDataFrame([("garbage",), (None,), ('{"user_id": 1.5}',),
                                ('{"user_id": "7"}',), ('{"user_id": 7}',)], "value string")
    out = EV.decode(df, S.SUPPORT_SCHEMA).collect()
    assert out[0]["user_id"] is None and out[0]["_corrupt_record"] == "garbage"
    assert out[2]["user_id"] is None and out[2]["_corrupt_record"] is not None
    assert out[4]["user_id"] == 7 and out[4]["_corrupt_record"] is None
    assert len(out) == 5


def test_review_clean_accents_and_vertical_tab(spark):
    df = spark.createDataFrame([("Don't Été good!  9/10",), ("a\u000bb",), (None,)], "review_text string")
    got = [r[0] for r in df.select(C.review_clean()).collect()]
    assert got[0] == "dont t good  "
    assert got[1] == "a\u000bb"  # Java \s keeps the vertical tab
    assert got[2] is None


def test_action_score_and_rules(spark):
    df = spark.createDataFrame([(a,) for a in ["purchase", "add_to_cart", "view", "search",
                                               "abandon", "other", None]], "action string")
    got = [r[0] for r in df.select(C.action_score()).collect()]
    assert got == [5, 3, 1, 1, -1, 0, 0]
    b = [r[0] for r in df.select(C.rule_recommendation(variant="B")).collect()]
    assert b[0] == "Suggerer produits similaires" and b[-1] == "Continuer navigation"


def test_kpis_on_empty_inputs(spark):
    c = clicks(spark, [])
    tx = spark.createDataFrame([], "user_id int, montant_paye double, statut_paiement string")
    sup = spark.createDataFrame([], "user_id int, motif_contact string")
    r = A.kpis(c, tx, sup).first()
    assert r["taux_conversion"] == 0.0 and r["revenu_total"] == 0.0 and r["nb_evenements"] == 0


def test_conversion_exactly_50_is_ok(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "purchase", 5, "google", None, 0.0),
                       ("b", 1, "X", 1.0, 1.0, "abandon", 5, "google", None, 60.0)])
    k = A.kpis(c)
    assert k.first()["taux_conversion"] == 50.0
    al = {r["alerte"]: r for r in A.alerts(k).collect()}
    assert al["conversion"]["declenchee"] is False
    assert "paiements_echoues" not in al  # no payments table → no payment alert


def test_status_spellings(spark):
    tx = spark.createDataFrame([(s, 10.0) for s in ["succès", "succes", "échoué", "echoue",
                                                     "failed", None]],
                               "statut_paiement string, montant_paye double")
    r = A.kpis(clicks(spark, []), tx).first()
    assert r["nb_echecs"] == 3
    assert r["nb_echecs_regex"] == 2  # the dashboard regex misses "échoué"
    assert r["revenu_total"] == 60.0 and r["revenu_succes"] == 10.0
    coh = {x["regle"]: x["nb_anomalies"] for x in Q.coherence({"transactions": tx}).collect()}
    assert coh["statuts_invalides"] == 2  # "failed" and null


def test_null_and_nan_in_quality_rules(spark):
    c = clicks(spark, [("a", 1, "X", float("nan"), float("nan"), None, 5, "g", None, 0.0),
                       ("b", 1, "X", None, 6.0, "view", -1, "g", None, 0.0),
                       ("b", 1, None, -1.0, 1.0, "bogus", 5, "g", None, 0.0)])
    coh = {x["regle"]: x["nb_anomalies"] for x in Q.coherence({"clickstream": c}).collect()}
    assert coh == {"actions_invalides": 2, "prix_negatifs": 1, "ratings_hors_bornes": 1,
                   "durees_negatives": 1}
    dup = Q.duplicates({"clickstream": c}).first()
    assert dup["nb_doublons"] == 1
    comp = {x["colonne"]: x["nb_manquants"] for x in Q.completeness({"clickstream": c}).collect()}
    assert comp["action"] == 1 and comp["category"] == 1 and comp["review_text"] == 3


def test_histogram_constant_and_max(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h = Q.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["nb"] for r in h] == list(np.histogram([2.0, 2.0], bins=4)[0])
    df2 = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    h2 = Q.histogram(df2, "x", 5).orderBy("bin").collect()
    assert [r["nb"] for r in h2] == list(np.histogram([0.0, 1.0, 10.0], bins=5)[0])
    assert h2[-1]["borne_sup"] == 10.0


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 0.25)]).round(3)
    df = spark.createDataFrame([(float(v),) for v in vals], "a double")
    d = {r["colonne"]: r for r in ST.describe(df, ["a"], decimals=None, accuracy=100).collect()}["a"]
    for name, p in (("p25", 25), ("p50", 50), ("p75", 75)):
        assert math.isclose(d[name], float(np.percentile(vals, p)), abs_tol=1e-9)
    assert math.isclose(d["std"], float(np.std(vals, ddof=1)), rel_tol=1e-9)


def test_enriched_null_user_and_category(spark):
    c = clicks(spark, [("a", None, None, 10.0, 1.0, "purchase", 5, "g", None, 0.0),
                       ("b", 2, "X", 20.0, 1.0, "purchase", 7, "g", None, 0.0),
                       ("c", 2, "X", 30.0, 1.0, "view", 9, "g", None, 0.0)])
    out = {r["session_id"]: r for r in E.enriched_clicks(c).collect()}
    a = out["a"]
    assert a["nb_actions_user"] is None and a["nb_achats_user"] == 0
    assert a["taux_achat_user"] == 0.0 and a["taux_achat_categorie"] == 0.0
    assert a["montant_total_depense"] == 0.0
    b = out["b"]
    assert b["nb_actions_user"] == 2 and b["taux_achat_user"] == 0.5
    assert b["score_engagement_total"] == 6 and b["prix_moy_categorie"] == 25.0


def test_pseudonym_known_value(spark):
    df = spark.createDataFrame([(8,), (None,)], "user_id int")
    got = [r[0] for r in G.pseudonymise(df).select("user_id_anonyme").collect()]
    assert got[0] == "2c624232cdd2" and got[1] is None
    salted = G.pseudonymise(df, salt="s").first()["user_id_anonyme"]
    assert salted != "2c624232cdd2" and len(salted) == 12


def test_erase_and_retention(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "view", 1, "g", None, 1704067200.0),
                       ("b", 2, "X", 1.0, 1.0, "view", 1, "g", None, 1712000000.0),
                       ("c", None, "X", 1.0, 1.0, "view", 1, "g", None, 1712000000.0)])
    kept = G.erase(c, [1])
    assert sorted(r["session_id"] for r in kept.collect()) == ["b", "c"]
    assert G.erase_counts({"clickstream": c}, [1]).first()["nb_supprimes"] == 1
    rep = G.retention_report({"clickstream": c}, "2024-04-15 00:00:00").first()
    assert rep["nb_conserves"] == 2 and rep["nb_expires"] == 1


def test_epoch_sink_replay_is_idempotent(spark):
    sink = K.EpochSink(scratch_path(spark, "t-epoch"))
    df = spark.createDataFrame([(1,), (2,)], "x int")
    sink(df, 0)
    sink(df, 0)
    sink(spark.createDataFrame([], "x int"), 1)
    assert sink.read(spark).count() == 2


def test_keyed_upsert_last_write_wins(spark):
    t = K.KeyedTable(scratch_path(spark, "t-keyed"), ["k"])
    t(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    t(spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int"), 1)
    t(spark.createDataFrame([("a", 9)], "k string, v int"), 1)  # replay: ignored
    got = {r["k"]: r["v"] for r in t.read(spark).collect()}
    assert got == {"a": 3, "b": 1}


def test_unseen_label_maps_to_zero(spark):
    train = spark.createDataFrame([("B", "x", "/p"), ("C", "y", None)],
                                  "category string, source string, page_visitee string")
    enc = M.fit_encoders(train, M.BASE_ENCODED)
    test = spark.createDataFrame([("C", "x", "/p"), ("Z", None, "/q")],
                                 "category string, source string, page_visitee string")
    rows = enc.transform(test).select("category_enc", "source_enc", "page_enc",
                                      "nb_inconnus").collect()
    assert tuple(rows[0]) == (1, 0, 0, 0)
    assert tuple(rows[1]) == (0, 0, 0, 3)


def test_split_is_stratified_disjoint_and_complete(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"),
                                   (F.col("id") % 5 == 0).cast("int").alias("y"))
    s = M.stratified_split(df, "y", "k")
    assert s.count() == 20000
    shares = {r["y"]: r["p"] for r in s.groupBy("y").agg(
        F.avg((F.col("split") == "train").cast("double")).alias("p")).collect()}
    assert all(abs(p - 0.8) < 0.01 for p in shares.values())
    for parts in (3, 40):  # the cut does not move with the partitioning
        again = M.stratified_split(df.repartition(parts), "y", "k")
        assert s.join(again, ["k", "y", "split"]).count() == 20000


def test_binary_metrics_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "intention_achat int, prediction int")
    r = {x["classe"]: x for x in M.binary_metrics(df).collect()}
    assert r[1]["precision"] == 0.0 and r[1]["f1"] == 0.0 and r[1]["support"] == 2
    assert r[0]["accuracy"] == 0.0


def test_sentiment_lexicon_phrases(spark):
    df = spark.createDataFrame([("Great quality, fast shipping!",), ("Good value but slow.",),
                                ("Very disappointed, broken on arrival",), (None,)],
                               "review_text string")
    rows = T.with_sentiment(df, T.TEST_LEXICON).collect()
    assert [(r["sentiment"], r["sentiment_score"], r["subjectivite"]) for r in rows] == [
        ("positif", 0.5, 0.675), ("neutre", 0.175, 0.5), ("negatif", -0.575, 0.575),
        ("neutre", 0.0, 0.0)]
    lex = spark.createDataFrame(T.TEST_LEXICON, "word string, polarity double, subjectivity double")
    by_join = T._sentiment_by_join(T.with_sentiment(df, T.TEST_LEXICON).drop(
        "sentiment", "sentiment_score", "subjectivite"), lex, "review_clean").collect()
    assert sorted(r["sentiment_score"] for r in by_join) == sorted(
        r["sentiment_score"] for r in rows)


def test_sentiment_is_the_same_by_map_and_by_join(spark, monkeypatch):
    df = spark.createDataFrame([(0, "good, good slow"), (1, "odd good"), (2, ""), (3, None), (4, "odd")], "i int, review_text string")
    rows = [("good", 1.0, 0.5), ("good", 0.0, None), ("odd", None, 1.0), ("slow", -0.5, 0.0), (None, 1.0, 1.0)]
    lex = spark.createDataFrame(rows, "word string, polarity double, subjectivity double")

    def scores(lexicon):
        return [(r["i"], r["sentiment"], r["sentiment_score"], r["subjectivite"]) for r in T.with_sentiment(df, lexicon).orderBy("i").collect()]

    want = [(0, "neutre", 0.167, 0.333), (1, "positif", 0.5, 0.75), (2, "neutre", 0.0, 0.0),
            (3, "neutre", 0.0, 0.0), (4, "neutre", 0.0, 1.0)]
    assert scores(rows) == scores(lex) == want
    assert [r[2] for r in scores([])] == [0.0] * 5
    monkeypatch.setattr(T, "MAX_LITERAL_ROWS", 0)
    assert scores(lex) == want


def test_default_stop_words_are_english(spark):
    df = spark.createDataFrame([("The shipping and the quality",)], "review_text string")
    assert T.with_nlp(df).first()["tokens"] == ["shipping", "quality"]


def test_tokens_stop_words_lemmas_and_counts(spark):
    df = spark.createDataFrame([("The products and reviews are great great, bad!",)],
                               "review_text string")
    r = T.with_nlp(df, T.TEST_STOP_WORDS, T.TEST_LEMMAS).first()
    assert r["tokens"] == ["product", "review", "are", "great", "great", "bad"]
    assert r["nb_mots_positifs"] == 2 and r["nb_mots_negatifs"] == 1 and r["score_nlp"] == 1


def test_profile_rules_first_match(spark):
    rows = [(0.5, 0, 5, 10, 20, "neutre"), (0.0, 3, 1, 4, 0, "negatif"),
            (0.5, 0, 2, 4, 5, "neutre"), (0.05, 0, 1, 20, 5, "neutre"), (0.2, 0, 1, 5, 5, "neutre")]
    df = spark.createDataFrame(rows, "taux_achat_user double, nb_abandons_user long, "
                                     "nb_achats_user long, nb_actions_user long, "
                                     "score_engagement_total long, sentiment string")
    from sillage.operators.profile import with_profile
    got = [r["profil_comportemental"] for r in with_profile(df).collect()]
    assert got == ["client_fidele", "chasseur_promos", "acheteur_impulsif", "comparateur",
                   "visiteur_standard"]


def test_no_python_udf_in_plans(spark):
    import __spark_entry__ as entry
    from tests.conftest import SMALL
    for name in ["enriched_clicks", "review_sentiment", "kpis", "dq_coherence", "user_profile"]:
        plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


@pytest.mark.parametrize("rounds", [3])
def test_compare_models_small(spark, rounds):
    from sillage.plans import q_ml
    from tests.conftest import SMALL
    cmp = M.compare_models(q_ml._prepared(spark, SMALL), rf_trees=5, rf_depth=5,
                           gbt_rounds=rounds)
    res = cmp.results.collect()
    assert len(res) == 3 and sum(r["meilleur"] for r in res) <= 1
    if cmp.best_model is not None:
        path = scratch_path(spark, "t-model")
        M.save(cmp.best_model, path)
        scored = M.score(M.load(path), q_ml.target_frame(spark, SMALL))
        assert scored.filter(F.col("proba_achat").isNull()).count() == 0


def test_apply_erasure_and_retention_write_new_versions(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "view", 1, "g", None, 1704067200.0),
                       ("b", 2, "X", 1.0, 1.0, "view", 1, "g", None, 1712000000.0)])
    tx = spark.createDataFrame([(1, 5.0, 1712000000.0)], "user_id int, montant_paye double, timestamp double")
    paths = {"clickstream": scratch_path(spark, "t-v-c"), "transactions": scratch_path(spark, "t-v-t")}
    K.VersionedTable(paths["clickstream"]).write(c)
    K.VersionedTable(paths["transactions"]).write(tx)
    rep = {r["table"]: r["nb_supprimes"] for r in G.apply_erasure(spark, paths, [1]).collect()}
    assert rep == {"clickstream": 1, "transactions": 1}
    vc = K.VersionedTable(paths["clickstream"])
    assert vc.versions(spark) == [1]  # versions that hold the erased user are gone
    assert [r["session_id"] for r in vc.read(spark).collect()] == ["b"]
    G.apply_retention(spark, {"clickstream": paths["clickstream"]}, "2024-04-15 00:00:00")
    assert vc.versions(spark) == [1] and vc.read(spark).count() == 1  # nothing has expired
    G.apply_retention(spark, {"clickstream": paths["clickstream"]}, "2025-04-15 00:00:00")
    assert vc.versions(spark) == [2] and vc.read(spark).count() == 0  # and no older version holds the row
    with pytest.raises(ValueError):
        G.apply_erasure(spark, {"x": scratch_path(spark, "t-v-none")}, [1])


def test_erasure_on_live_sinks(spark):
    epochs = K.EpochSink(scratch_path(spark, "t-er-epochs"))
    keyed = K.KeyedTable(scratch_path(spark, "t-er-keyed"), ["s"])
    schema = "s string, user_id int"
    for e, rows in enumerate([[("a", 7), ("b", 2)], [("c", 3), (None, 5), (None, 6)]]):
        epochs(spark.createDataFrame(rows, schema), e)
        keyed(spark.createDataFrame(rows, schema), e)
    assert keyed.read(spark).count() == 5  # rows without a key are all kept
    rep = G.apply_erasure(spark, {"e": epochs.path, "k": keyed.path}, [7])
    assert {r["table"]: r["nb_supprimes"] for r in rep.collect()} == {"e": 1, "k": 1}
    for t in (epochs, keyed):  # gone from every file, not only from the current version
        assert spark.read.option("recursiveFileLookup", True).parquet(t.path).filter("user_id = 7").count() == 0
    keyed(spark.createDataFrame([("d", 4)], schema), 2)  # the stream's next batch is not lost
    keyed(spark.createDataFrame([("x", 9)], schema), 2)  # but its replay is skipped
    assert sorted(r["user_id"] for r in keyed.read(spark).collect()) == [2, 3, 4, 5, 6]


def test_epoch_sink_without_batches_and_half_written(spark):
    sink = K.EpochSink(scratch_path(spark, "t-none"))
    assert sink.read(spark, "x int").columns == ["x"] and sink.read(spark, "x int").count() == 0
    sink(spark.createDataFrame([(1,)], "x int"), 0)
    spark.createDataFrame([(9,)], "x int").write.parquet(f"{sink.path}/epoch=1")
    os.remove(f"{sink.path}/epoch=1/_SUCCESS")
    assert [r["x"] for r in sink.read(spark).collect()] == [1]


def test_money_is_not_rounded_per_row_and_skips_nan(spark):
    from sillage.functions.columns import money_avg, money_sum
    df = spark.createDataFrame([(10.0,), (float("nan"),), (None,), (20.005,), (float("inf"),)], "m double")
    r = df.agg(money_sum("m").alias("s"), money_avg("m").alias("a")).first()
    assert (r["s"], r["a"]) == (30.005, 15.0025)


def test_retention_keeps_undated_rows_and_counts_calendar_years(spark):
    from datetime import datetime, timezone
    ts = [datetime(2020, 2, 29, tzinfo=timezone.utc).timestamp(), datetime(2020, 2, 28, 23, tzinfo=timezone.utc).timestamp(), None]
    df = spark.createDataFrame([(t,) for t in ts], "timestamp double")
    r = G.retention_report({"transactions": df}, "2025-02-28 00:00:00").first()
    assert (r["nb_conserves"], r["nb_expires"], r["nb_sans_date"]) == (2, 0, 1)
    assert G.retention_filter(df, "2025-03-01 00:00:00", (5, 0)).count() == 1


def test_review_texts_are_whole_passages(spark):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").agg(F.max(F.length("text"))).first()[0]
    got = FX.clicks(spark, SMALL).agg(F.max(F.length("review_text"))).first()[0]
    assert got >= bench  # the longest passage and its phrase


def test_hot_user_sort_merge_path_equals_broadcast_path(spark):
    """One user holds a third of the clicks; the sort-merge fallback (AQE skew split
    forced on) gives the same enriched rows as the broadcast path."""
    rows = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else 2 + i % 97
        rows.append((f"s{i}", user, f"C{i % 5}", float(i % 50), 1.0,
                     ["view", "purchase", "abandon", "add_to_cart"][i % 4], i % 30, "g", None,
                     float(i)))
    c = clicks(spark, rows)
    cols = ["session_id", "nb_actions_user", "taux_achat_user", "score_engagement_total",
            "taux_achat_categorie"]
    fast = E.enriched_clicks(c).select(*cols)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        slow = E.enriched_clicks(c, broadcast_max_rows=0).select(*cols)
        plan = slow._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert slow.exceptAll(fast).count() == 0 and fast.exceptAll(slow).count() == 0
        hot = slow.filter("nb_actions_user = 1000").count()
        assert hot == 1000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_user_table_is_one_shuffle_over_three_scans(spark):
    from sillage.sources import fixtures as FX
    from tests.conftest import SMALL
    j = FX.journey(spark, SMALL)
    plan = E.user_table(j.clicks, j.transactions, j.support)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("hashpartitioning(user_id") == 1
    assert plan.count("partial_count") >= 1
    assert plan.count("events.parquet") == 3


def test_exact_quantiles_of_small_groups(spark):
    rnd = np.random.default_rng(9)
    groups = {str(n): rnd.random(n) for n in (1, 2, 3, 10, 201, 283, 1000)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "colonne string, valeur double")
    probs = [0.25, 0.5, 0.8]
    got = {(r["colonne"], r["p"]): r["quantile"] for r in ST.exact_quantiles(df, probs).collect()}
    assert len(got) == len(groups) * len(probs)
    assert all(abs(got[k, p] - np.quantile(vs, p)) < 1e-12 for k, vs in groups.items() for p in probs)


def test_exact_quantiles_with_narrowing(spark):
    from sillage.operators import stats as ST2
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.exponential(size=20000), np.full(3000, 1.5)])
    df = spark.createDataFrame([(float(v),) for v in vals], "a double")
    long = ST2.to_long(df, ["a"])
    # a tiny bracket limit forces several narrowing rounds
    q = {r["qi"]: r["quantile"] for r in
         ST2.exact_quantiles(long, [0.1, 0.5, 0.99], accuracy=50, max_bracket=20).collect()}
    for i, p in enumerate([10, 50, 99]):
        assert math.isclose(q[i], float(np.percentile(vals, p)), rel_tol=0, abs_tol=1e-12)


def test_score_recommendation_texts(spark):
    df = spark.createDataFrame([(1, 85.3, "neutre"), (1, 60.0, "positif"), (0, 30.5, "negatif"),
                                (0, 10.0, "neutre")], "prediction int, proba double, sentiment string")
    got = [r[0] for r in df.select(C.score_recommendation("prediction", "proba", "sentiment")).collect()]
    assert got == [" ACHAT PROBABLE (85.3%) — Suggérer produits similaires",
                   " ACHAT POSSIBLE (60.0%) — Proposer livraison gratuite",
                   "  RISQUE ABANDON (69.5%) — Envoyer coupon -20%",
                   "  NAVIGATION (90.0%) — Continuer navigation"]


def test_filters_funnel_and_distinct_values(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "purchase", 5, "google", None, 0.0),
                       ("b", 1, None, 1.0, 1.0, "teleport", 5, None, None, 0.0),
                       ("c", 1, "Y", 1.0, 1.0, "view", 5, "email", None, 0.0)])
    assert A.filter_clicks(c, "Toutes", "Toutes").count() == 3
    assert A.filter_clicks(c, "X", None).count() == 1
    f = [(r["action"], r["etape"]) for r in A.funnel(c).collect()]
    assert f == [("view", 1), ("purchase", 4), ("teleport", None)]
    vals = {(r["filtre"], r["valeur"]) for r in A.distinct_filters(c).collect()}
    assert ("category", None) in vals and ("source", "email") in vals and len(vals) == 6


def test_minimise_keeps_needed_existing_columns(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "view", 5, "google", "txt", 0.0)])
    assert G.minimise(c).columns == ["session_id", "user_id", "action", "category", "price",
                                     "rating", "source", "timestamp"]
    assert G.minimise(c.drop("rating")).columns[-2:] == ["source", "timestamp"]


def test_csv_roundtrip_quotes_newlines_and_blanks(spark):
    df = spark.createDataFrame([("a,b", 'say "hi"\nnext', " x "), (None, "", "")],
                               "c1 string, c2 string, c3 string")
    path = scratch_path(spark, "t-csv")
    EV.write_csv(df, path)
    back = EV.read_csv(spark, path, df.schema)
    got = sorted(back.collect(), key=str)
    assert got[0] == df.collect()[0]  # commas, quotes, newlines, edge spaces survive
    assert tuple(got[1]) == (None, None, None)  # empty text reads back as null, like pandas


def test_retention_filter_uses_explicit_instant(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "view", 1, "g", None, 1704067200.0),
                       ("b", 2, "X", 1.0, 1.0, "view", 1, "g", None, 1712000000.0)])
    kept = G.retention_filter(c, "2024-04-15 00:00:00", 90)
    assert [r["session_id"] for r in kept.collect()] == ["b"]


def test_feature_list_leaves_out_target_derived_column():
    assert "risque_abandon" not in M.feature_columns()
    assert M.feature_columns(legacy_features=True)[-1] == "risque_abandon"
    assert len(M.feature_columns()) == 27


def test_erasure_list_as_dataframe_uses_anti_join(spark):
    c = clicks(spark, [("a", 1, "X", 1.0, 1.0, "view", 1, "g", None, 0.0),
                       ("b", 2, "X", 1.0, 1.0, "view", 1, "g", None, 0.0),
                       ("c", 3, "X", 1.0, 1.0, "view", 1, "g", None, 0.0),
                       ("d", None, "X", 1.0, 1.0, "view", 1, "g", None, 0.0)])
    ids = spark.createDataFrame([(1,), (3,), (3,), (None,)], "uid long")
    kept = G.erase(c, ids)
    assert sorted(r["session_id"] for r in kept.collect()) == ["b", "d"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    assert G.erase_counts({"clickstream": c}, ids).first()["nb_supprimes"] == 2


def test_keyed_table_ignores_and_rebuilds_an_uncommitted_version(spark):
    import os
    path = scratch_path(spark, "t-crash")
    t = K.KeyedTable(path, ["k"])
    t(spark.createDataFrame([("a", 1)], "k string, v int"), 0)
    # a writer died while producing version 1: files but no _SUCCESS marker
    spark.createDataFrame([("a", 99)], "k string, v int").write.parquet(f"{path}/v=1")
    os.remove(f"{path}/v=1/_SUCCESS")
    assert t.versions(spark) == [0]
    assert t.read(spark).first()["v"] == 1
    t(spark.createDataFrame([("a", 2), ("b", 5)], "k string, v int"), 1)  # the replay
    assert t.versions(spark) == [0, 1]
    assert {r["k"]: r["v"] for r in t.read(spark).collect()} == {"a": 2, "b": 5}


def test_forest_in_groups_saves_and_scores(spark, tmp_path):
    """A large forest is grown in groups of trees whose votes are added up; data fill the cores."""
    from sillage.operators import ml as M
    from sillage.operators.joins import TRAIN_ROWS, materialize, right_size

    cols = [(F.rand(i + 2) * 10).alias(c) for i, c in enumerate(M.feature_columns())]
    df = materialize(spark.range(TRAIN_ROWS + 5_000).select((F.rand(1) < 0.5).cast("int").alias("intention_achat"), F.lit(1.0).alias("poids"), *cols), "t-forest")
    assert right_size(df).rdd.getNumPartitions() > 1
    stages = M.fit_forest(M.classifiers(1, rf_trees=7, rf_depth=3)["Random Forest"], df, [M.filler(), M.assembler()], 3)
    assert [s.getNumTrees for s in stages[2:-1]] == [3, 2, 2]
    M.save(M.PipelineModel(stages=stages), str(tmp_path / "forest"))
    out = M.score(M.load(str(tmp_path / "forest")), df.limit(50)).collect()
    for r in out:
        assert abs(sum(r["rawPrediction"]) - 7) < 1e-9 and abs(r["probability"][1] - r["rawPrediction"][1] / 7) < 1e-9
        assert r["prediction"] == int(r["rawPrediction"][1] > r["rawPrediction"][0])
