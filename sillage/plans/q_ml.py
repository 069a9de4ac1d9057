"""Machine-learning queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import ml as M
from ..operators import profile as PR
from ..operators import text as T
from ..functions.columns import score_recommendation
from ..operators.features import join_features, key_tables
from ..operators.joins import broadcast_if_small, known_rows, materialize, right_size
from ..operators.sinks import EpochSink
from ..operators.smote import smote
from ..session import scratch_path
from ..sources import fixtures as FX
from ..streaming import jobs as J
from . import oracle as O
from .catalog import register
from .q_streaming import land_json
from .q_text import ML_CTES, target_frame

KEY = "session_id"


def _dense(col: str, fill: str) -> str:
    return (f"CAST(dense_rank() OVER (ORDER BY coalesce(CAST({col} AS VARCHAR), '{fill}')) - 1 "
            f"AS INTEGER)")


ENC_SQL = {c: _dense(c, M.FILL_LABEL.get(c, "nan")) for c in M.ENCODED}
ENCODED_CTE = ("encoded AS (SELECT *, " + ", ".join(
    f"{ENC_SQL[c]} AS {M.ENCODED[c]}" for c in M.ENCODED) + " FROM target)")


@register("ml_encoded", O.with_fixtures(
    "SELECT event_id, " + ", ".join(M.ENCODED.values()) + " FROM encoded", *ML_CTES, ENCODED_CTE))
def ml_encoded(spark, sf_dir):
    """M1: the five label codes, encoders fitted on the purchase/abandon rows."""
    tgt = materialize(target_frame(spark, sf_dir), "ml-target")
    enc = M.fit_encoders(tgt, list(M.ENCODED))
    return enc.transform(tgt).select("event_id", *M.ENCODED.values())


#: ``encode_safe`` fits on the rows of one source, so labels of the others are really unseen.
FIT_SOURCE = S.SOURCES[0]

_SAFE_CODES = ", ".join(
    f"coalesce(m_{c}.code, 0) AS {M.ENCODED[c]}" for c in M.BASE_ENCODED)
_SAFE_UNSEEN = " + ".join(f"CAST(m_{c}.code IS NULL AS INTEGER)" for c in M.BASE_ENCODED)
_SAFE_JOINS = " ".join(
    f"LEFT JOIN (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), '{M.FILL_LABEL.get(c, 'nan')}') AS lbl, "
    f"{ENC_SQL[c]} AS code FROM (SELECT DISTINCT {c} FROM target WHERE source = {O._q(FIT_SOURCE)})) m_{c} "
    f"ON m_{c}.lbl = coalesce(CAST(c.{c} AS VARCHAR), '{M.FILL_LABEL.get(c, 'nan')}')"
    for c in M.BASE_ENCODED)


@register("encode_safe", O.with_fixtures(
    f"SELECT c.event_id, {_SAFE_CODES}, {_SAFE_UNSEEN} AS nb_inconnus FROM clicks c {_SAFE_JOINS}",
    *ML_CTES))
def encode_safe(spark, sf_dir):
    """M2: encoders fitted on one source's purchase/abandon rows, applied to every click;
    unseen labels → 0, counted in nb_inconnus."""
    tgt = target_frame(spark, sf_dir).where(F.col("source") == FIT_SOURCE)
    tgt = materialize(tgt.select(*M.BASE_ENCODED), "ml-target")
    enc = M.fit_encoders(tgt, M.BASE_ENCODED)
    return enc.transform(FX.clicks(spark, sf_dir)).select(
        "event_id", *[M.ENCODED[c] for c in M.BASE_ENCODED], "nb_inconnus")


_FEATURES = M.feature_columns(False)


@register("ml_features", O.with_fixtures(
    "SELECT event_id, intention_achat, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _FEATURES) + " FROM encoded",
    *ML_CTES, ENCODED_CTE))
def ml_features(spark, sf_dir):
    """The 27 model features as plain columns (null → 0)."""
    tgt = materialize(target_frame(spark, sf_dir), "ml-target")
    enc = M.fit_encoders(tgt, list(M.ENCODED))
    return M.assemble(enc.transform(tgt)).select("event_id", "intention_achat", *_FEATURES)


_SMOTE_DRAW = "CAST('0x' || substr(md5(concat_ws('|', {}, '{}')), 1, 13) AS BIGINT)"
_SMOTE_DISTANCE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _FEATURES)


@register("ml_smote", O.with_fixtures(f"""
SELECT s.y AS intention_achat, s.i AS numero, a.event_id AS base_id, b.event_id AS voisin_id, s.part, """ + ", ".join(
    f"a.{c} + s.part * (b.{c} - a.{c}) AS {c}" for c in _FEATURES) + """
FROM s JOIN r a ON a.y = s.y AND a.rk = s.base JOIN nn ON nn.event_id = a.event_id AND nn.j = s.rang JOIN r b ON b.event_id = nn.voisin""",
    *ML_CTES, ENCODED_CTE, "f AS MATERIALIZED (SELECT event_id, intention_achat AS y, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _FEATURES) + " FROM encoded)",
    "cnt AS (SELECT y, count(*) AS n, max(count(*)) OVER () AS m FROM f GROUP BY y)",
    f"""r AS MATERIALIZED (SELECT f.*, row_number() OVER (PARTITION BY y ORDER BY {_SMOTE_DRAW.format("event_id", "42")}, event_id) - 1 AS rk
  FROM f JOIN cnt USING (y) WHERE n < m)""",
    f"""nn AS (SELECT event_id, voisin, j FROM (
  SELECT a.event_id, b.event_id AS voisin, row_number() OVER (PARTITION BY a.event_id ORDER BY {_SMOTE_DISTANCE}, b.event_id) AS j
  FROM r a JOIN r b ON a.y = b.y AND a.event_id <> b.event_id) WHERE j <= 5)""",
    f"""s AS (SELECT y, i, {_SMOTE_DRAW.format("y, i", "base|42")} % n AS base, {_SMOTE_DRAW.format("y, i", "voisin|42")} % least(5, n - 1) + 1 AS rang,
    {_SMOTE_DRAW.format("y, i", "part|42")} / 4503599627370496.0::DOUBLE AS part
  FROM (SELECT y, n, unnest(range(m - n)) AS i FROM cnt))"""))
def ml_smote(spark, sf_dir):
    """M4: synthetic rows that balance the purchase/abandon classes over the 27 features."""
    return smote(ml_features(spark, sf_dir), "intention_achat", "event_id", _FEATURES)


@register("ml_split", O.with_fixtures("""
SELECT event_id, intention_achat,
  CASE WHEN rank() OVER w - 1 <= floor(CAST(0.8 AS DOUBLE) * (count(*) OVER (PARTITION BY intention_achat) - 1))
       THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, CAST(action = 'purchase' AS INTEGER) AS intention_achat,
        substr(md5(coalesce(session_id, '') || '|42'), 1, 13) AS h
      FROM clicks WHERE action IN ('purchase', 'abandon'))
WINDOW w AS (PARTITION BY intention_achat ORDER BY h)"""))
def ml_split(spark, sf_dir):
    """M3: stratified, reproducible 80/20 split of the purchase/abandon rows."""
    return _prepared(spark, sf_dir).select("event_id", "intention_achat", "split")


_BASELINE_PRED = "CAST(taux_achat_user > 0.5 AS INTEGER)"


@register("ml_metrics", O.with_fixtures(f"""
SELECT r.classe, r.nom, round(r.prec, 3) AS precision, round(r.rec, 3) AS rappel,
  round(CASE WHEN r.prec + r.rec > 0 THEN 2 * r.prec * r.rec / (r.prec + r.rec) ELSE 0.0 END, 3) AS f1,
  r.support, round(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END, 3)
    AS accuracy
FROM c, (
  SELECT 0 AS classe, 'Abandon' AS nom,
    CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS prec,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS rec, tn + fp AS support FROM c
  UNION ALL
  SELECT 1, 'Achat', CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, tp + fn FROM c) r""",
    *ML_CTES, f"""c AS (SELECT
    count(*) FILTER (WHERE intention_achat = 1 AND {_BASELINE_PRED} = 1) AS tp,
    count(*) FILTER (WHERE intention_achat = 0 AND {_BASELINE_PRED} = 1) AS fp,
    count(*) FILTER (WHERE intention_achat = 1 AND {_BASELINE_PRED} = 0) AS fn,
    count(*) FILTER (WHERE intention_achat = 0 AND {_BASELINE_PRED} = 0) AS tn FROM target)"""))
def ml_metrics(spark, sf_dir):
    """M8 on a prediction table derived from the data: the baseline rule
    'user purchase rate > 0.5' scored against intention_achat."""
    pred = target_frame(spark, sf_dir).withColumn(
        "prediction", (F.col("taux_achat_user") > 0.5).cast("int"))
    return M.binary_metrics(pred)


def _prepared(spark, sf_dir, legacy: bool = False):
    """Purchase/abandon rows with their split, features and profile, for training.

    The split is drawn first.  Unless ``legacy``, the user and category features are
    built only from rows outside the test part — clicks of test rows and the
    payments and tickets of their sessions are left out — so a test row's own
    action never reaches its features (the reference computes them on all rows).
    """
    j = FX.journey(spark, sf_dir)
    a = F.col("action")
    labelled = j.clicks.filter(a.isin("purchase", "abandon")).select(
        "event_id", KEY, (a == "purchase").cast("int").alias("intention_achat"))
    split = materialize(M.stratified_split(labelled, "intention_achat", KEY)
                        .select("event_id", KEY, "split"), "ml-split")
    clicks = j.clicks.join(broadcast_if_small(split.drop(KEY)), "event_id", "left")
    if legacy:
        f_clicks, f_tx, f_sup = clicks, j.transactions, j.support
    else:
        test = broadcast_if_small(split.filter(F.col("split") == "test").select(KEY))
        f_clicks = clicks.filter(F.coalesce(F.col("split"), F.lit("")) != "test")
        f_tx = j.transactions.join(test, KEY, "left_anti")
        f_sup = j.support.join(test, KEY, "left_anti")
    users, cats = key_tables(f_clicks, f_tx, f_sup)
    base = join_features(clicks, users, cats)
    return PR.with_target(nlp_and_profile(base))


def nlp_and_profile(df):
    df = T.with_sentiment(T.with_nlp(df, T.TEST_STOP_WORDS, T.TEST_LEMMAS), T.TEST_LEXICON)
    return PR.with_profile(df)


@register("ml_compare")
def ml_compare(spark, sf_dir):
    """M4-M8 + L6: the three models trained on the oversampled training part of the split,
    compared on the test part."""
    return M.compare_models(_prepared(spark, sf_dir), balance="smote").results


@register("stream_scoring")
def stream_scoring(spark, sf_dir):
    """T7 + M9 + P5: fit → save → load a model, then score the whole clickstream as a
    stream.  Each micro-batch is joined to the user and category feature tables
    (stream-static joins), gets its text features and profile, and is scored on the
    executors; the recommendation comes from the score."""
    prep = right_size(materialize(_prepared(spark, sf_dir), "ml-prepared"))
    train = prep.filter(F.col("split") == "train")
    enc = M.fit_encoders(train, list(M.ENCODED))
    x = right_size(materialize(M.class_weights(enc.transform(train), "intention_achat"), "ml-train"))
    lr = M.classifiers(known_rows(x))["Logistic Regression"]
    fitted = Pipeline(stages=[M.filler(), M.assembler(), lr]).fit(x)
    path = scratch_path(spark, "model")
    M.save(PipelineModel(stages=[*enc.stages, *fitted.stages]), path)
    model = M.load(path)

    j = FX.journey(spark, sf_dir)
    users, cats = key_tables(j.clicks, j.transactions, j.support)
    users, cats = broadcast_if_small(users), broadcast_if_small(cats)
    landing = land_json(FX.clicks(spark, sf_dir, with_event_id=False), S.CLICKSTREAM_SCHEMA,
                        "clickstream")
    stream = J.clicks_stream(spark, {"format": "files", "path": landing}, None)
    feats = (stream.join(users, "user_id", "left").join(cats, "category", "left")
             .na.fill({c: 0 for c in ["nb_achats_user", "nb_abandons_user", "taux_achat_user",
                                      "montant_total_depense", "nb_transactions_reussies",
                                      "panier_moyen", "nb_tickets_support", "nb_remboursements",
                                      "taux_achat_categorie"]}))
    feats = T.with_sentiment(T.with_nlp(feats, T.TEST_STOP_WORDS, T.TEST_LEMMAS), T.TEST_LEXICON)
    feats = PR.with_profile(feats).withColumn("duree_visite", F.col("duree_visite").cast("double"))
    scored = M.score(model, feats)
    out = scored.select("session_id", "user_id", "action", "sentiment", "profil_comportemental",
                        "prediction", "proba_achat",
                        score_recommendation("prediction", "proba_achat", "sentiment")
                        .alias("recommandation"))
    sink = EpochSink(scratch_path(spark, "sink-scoring"))
    J.run_once(out, sink, scratch_path(spark, "ckpt-scoring"), f"scoring_{abs(hash(path)) % 10**8}")
    return sink.read(spark).drop("epoch")
