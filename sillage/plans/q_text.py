"""Derivation, text, profile and target queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import profile as PR
from ..operators import text as T
from ..sources import fixtures as FX
from ..sources.tables import read_table
from . import oracle as O
from .catalog import register
from .q_features import ENRICHED_CTE, enriched

# --- SQL fragments mirroring operators.text -------------------------------------------

RC = O.REVIEW_CLEAN_SQL
WORDS_SQL = f"list_filter(string_split_regex(trim(coalesce({RC}, '')), '\\s+'), lambda t: length(t) > 0)"


def _tokens_sql(stop, lemmas=None) -> str:
    toks = (f"list_filter({WORDS_SQL}, lambda t: regexp_full_match(t, '[a-z]+') "
            f"AND NOT list_contains({O.sql_array(stop)}, t))")
    if lemmas:
        case = " ".join(f"WHEN {O._q(k)} THEN {O._q(v)}" for k, v in lemmas.items())
        toks = f"list_transform({toks}, lambda t: CASE t {case} ELSE t END)"
    return toks


def _lex_mean_sql(idx: int) -> str:
    case = " ".join(f"WHEN {O._q(w[0])} THEN CAST({w[idx]!r} AS DOUBLE)" for w in T.TEST_LEXICON)
    found = f"list_filter(list_transform({WORDS_SQL}, lambda t: CASE t {case} ELSE NULL END), lambda x: x IS NOT NULL)"
    return f"(CASE WHEN len({found}) > 0 THEN list_sum({found}) / len({found}) ELSE 0.0 END)"


TOKENS_SQL = _tokens_sql(T.TEST_STOP_WORDS, T.TEST_LEMMAS)
POL_SQL, SUB_SQL = _lex_mean_sql(1), _lex_mean_sql(2)
SENTIMENT_SQL = (f"CASE WHEN {POL_SQL} > 0.2 THEN 'positif' WHEN {POL_SQL} < -0.2 THEN 'negatif' "
                 f"ELSE 'neutre' END")


def _count_in_sql(words) -> str:
    return (f"CAST(len(list_filter({TOKENS_SQL}, lambda t: list_contains({O.sql_array(words)}, t))) "
            f"AS INTEGER)")


NLP_CTE = f"""
nlp AS (
  SELECT *, CAST(len({TOKENS_SQL}) AS INTEGER) AS nb_tokens,
    {_count_in_sql(S.POSITIVE_WORDS)} AS nb_mots_positifs,
    {_count_in_sql(S.NEGATIVE_WORDS)} AS nb_mots_negatifs,
    {_count_in_sql(S.POSITIVE_WORDS)} - {_count_in_sql(S.NEGATIVE_WORDS)} AS score_nlp,
    {SENTIMENT_SQL} AS sentiment,
    round({POL_SQL}, 3) AS sentiment_score,
    round({SUB_SQL}, 3) AS subjectivite
  FROM enriched
)"""

PROFILE_SQL = """CASE
  WHEN coalesce(taux_achat_user, 0.0) > 0.4 AND coalesce(score_engagement_total, 0) > 10 THEN 'client_fidele'
  WHEN coalesce(nb_abandons_user, 0) > coalesce(nb_achats_user, 0) AND sentiment = 'negatif' THEN 'chasseur_promos'
  WHEN coalesce(nb_achats_user, 0) > 0
       AND greatest(coalesce(nb_actions_user, 1), 1) / greatest(coalesce(nb_achats_user, 0), 1) < 3
       THEN 'acheteur_impulsif'
  WHEN greatest(coalesce(nb_actions_user, 1), 1) > 10 AND coalesce(taux_achat_user, 0.0) < 0.1
       THEN 'comparateur'
  ELSE 'visiteur_standard' END"""

PROFILED_CTE = f"profiled AS (SELECT *, {PROFILE_SQL} AS profil_comportemental FROM nlp)"
TARGET_CTE = """target AS (
  SELECT *, CAST(action = 'purchase' AS INTEGER) AS intention_achat,
    CAST(action = 'abandon' AND sentiment = 'negatif' AS INTEGER) AS risque_abandon
  FROM profiled WHERE action IN ('purchase', 'abandon'))"""
ML_CTES = (ENRICHED_CTE, NLP_CTE, PROFILED_CTE, TARGET_CTE)


# --- Spark side --------------------------------------------------------------------------

def nlp_frame(spark, sf_dir, base=None):
    """Enriched clicks with N1-N7 columns (test stop words, lemmas and lexicon)."""
    df = base if base is not None else enriched(spark, sf_dir)
    df = T.with_nlp(df, T.TEST_STOP_WORDS, T.TEST_LEMMAS)
    return T.with_sentiment(df, T.TEST_LEXICON)


def profiled_frame(spark, sf_dir):
    return PR.with_profile(nlp_frame(spark, sf_dir))


def target_frame(spark, sf_dir):
    return PR.with_target(profiled_frame(spark, sf_dir))


def _clicks_with(spark, sf_dir, *cols):
    c = FX.clicks(spark, sf_dir)
    return c.select("event_id", *cols)


register("review_clean", O.with_fixtures(f"SELECT event_id, {RC} AS review_clean FROM clicks"))(
    lambda spark, sf_dir: _clicks_with(spark, sf_dir, C.review_clean("review_text").alias("review_clean")))

register("action_score", O.with_fixtures(
    f"SELECT event_id, action, {O.action_score_sql()} AS action_score FROM clicks"))(
    lambda spark, sf_dir: _clicks_with(spark, sf_dir, "action",
                                       C.action_score("action").alias("action_score")))


def _reco_sql(variant: str) -> str:
    t = S.RECO_TEXTS[variant]
    return O.with_fixtures(
        f"SELECT event_id, action, CASE WHEN action = 'abandon' THEN {O._q(t['abandon'])} "
        f"WHEN action = 'add_to_cart' THEN {O._q(t['add_to_cart'])} "
        f"WHEN action = 'purchase' THEN {O._q(t['purchase'])} ELSE {O._q(t['other'])} END "
        f"AS {S.RECO_COLUMN[variant]} FROM clicks")


for _v, _key in (("A", "reco_rules_a"), ("B", "reco_rules_b")):
    register(_key, _reco_sql(_v))(
        lambda spark, sf_dir, v=_v: _clicks_with(
            spark, sf_dir, "action", C.rule_recommendation("action", v).alias(S.RECO_COLUMN[v])))


register("review_tokens", O.with_fixtures(
    f"SELECT event_id, array_to_string({_tokens_sql(T.TEST_STOP_WORDS)}, ' ') AS tokens, "
    f"CAST(len({_tokens_sql(T.TEST_STOP_WORDS)}) AS INTEGER) AS nb_tokens FROM clicks"))(
    lambda spark, sf_dir: _clicks_with(
        spark, sf_dir,
        F.concat_ws(" ", T.tokens(C.review_clean(), T.TEST_STOP_WORDS)).alias("tokens"),
        F.size(T.tokens(C.review_clean(), T.TEST_STOP_WORDS)).alias("nb_tokens")))

register("token_lemmas", O.with_fixtures(
    f"SELECT event_id, array_to_string({TOKENS_SQL}, ' ') AS lemmes FROM clicks"))(
    lambda spark, sf_dir: _clicks_with(
        spark, sf_dir,
        F.concat_ws(" ", T.tokens(C.review_clean(), T.TEST_STOP_WORDS, T.TEST_LEMMAS)).alias("lemmes")))


#: For the query: the forms are all words of ``documents``, and a lemma cuts two letters off.
_DOC_WORDS_SQL = "unnest(string_split_regex(lower(text), '[^a-z]+'))"


@register("token_lemmas_table", O.with_fixtures(f"""
SELECT event_id, array_to_string(list_transform(list_sort(list(struct_pack(pos := pos, t := coalesce(lemma, t)))), lambda r: r.t), ' ') AS lemmes
FROM (SELECT event_id, generate_subscripts(toks, 1) AS pos, unnest(toks) AS t FROM (SELECT event_id, {_tokens_sql(T.TEST_STOP_WORDS)} AS toks FROM clicks))
LEFT JOIN (SELECT DISTINCT w AS form, substr(w, 1, greatest(3, length(w) - 2)) AS lemma FROM (SELECT {_DOC_WORDS_SQL} AS w FROM documents) WHERE w != '') l ON l.form = t
GROUP BY event_id
UNION ALL SELECT event_id, '' FROM (SELECT event_id, {_tokens_sql(T.TEST_STOP_WORDS)} AS toks FROM clicks) WHERE len(toks) = 0"""))
def _token_lemmas_table(spark, sf_dir):
    """N2 with a lemma table as large as the vocabulary of all documents."""
    words = read_table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("form")).where("form != ''").distinct()
    table = words.select("form", F.expr("substr(form, 1, greatest(3, length(form) - 2))").alias("lemma"))
    reviews = _clicks_with(spark, sf_dir, T.tokens(C.review_clean(), T.TEST_STOP_WORDS).alias("tokens"))
    return T.lemmatise_by(reviews, "tokens", table, "event_id").select("event_id", F.concat_ws(" ", "lemmes").alias("lemmes"))


@register("review_nlp", O.with_fixtures(
    "SELECT event_id, nb_tokens, nb_mots_positifs, nb_mots_negatifs, score_nlp FROM nlp",
    "enriched AS (SELECT * FROM clicks)", NLP_CTE))
def _review_nlp(spark, sf_dir):
    df = T.with_nlp(FX.clicks(spark, sf_dir), T.TEST_STOP_WORDS, T.TEST_LEMMAS)
    return df.select("event_id", "nb_tokens", "nb_mots_positifs", "nb_mots_negatifs", "score_nlp")


@register("review_sentiment", O.with_fixtures(
    f"SELECT event_id, {SENTIMENT_SQL} AS sentiment, round({POL_SQL}, 3) AS sentiment_score, "
    f"round({SUB_SQL}, 3) AS subjectivite FROM clicks"))
def _review_sentiment(spark, sf_dir):
    df = T.with_sentiment(FX.clicks(spark, sf_dir), T.TEST_LEXICON)
    return df.select("event_id", "sentiment", "sentiment_score", "subjectivite")


@register("reco_from_score", O.with_fixtures(f"""
SELECT event_id, prediction, proba_achat, sentiment,
  CASE WHEN prediction = 1 AND proba_achat > 80
         THEN ' ACHAT PROBABLE (' || CAST(proba_achat AS VARCHAR) || '%) — Suggérer produits similaires'
       WHEN prediction = 1
         THEN ' ACHAT POSSIBLE (' || CAST(proba_achat AS VARCHAR) || '%) — Proposer livraison gratuite'
       WHEN sentiment = 'negatif'
         THEN '  RISQUE ABANDON (' || CAST(round(100.0 - proba_achat, 1) AS VARCHAR) || '%) — Envoyer coupon -20%'
       ELSE '  NAVIGATION (' || CAST(round(100.0 - proba_achat, 1) AS VARCHAR) || '%) — Continuer navigation'
  END AS recommandation
FROM (SELECT event_id, sentiment, round(100.0 * taux_achat_user, 1) AS proba_achat,
             CAST(taux_achat_user > 0.5 AS INTEGER) AS prediction FROM nlp)""",
    ENRICHED_CTE, NLP_CTE))
def _reco_from_score(spark, sf_dir):
    """P5 over a score table derived from the data: the user's purchase rate as the
    probability, prediction = rate > 0.5 (a stand-in for a model's output)."""
    df = nlp_frame(spark, sf_dir).select(
        "event_id", "sentiment",
        F.round(F.col("taux_achat_user") * 100.0, 1).alias("proba_achat"),
        (F.col("taux_achat_user") > 0.5).cast("int").alias("prediction"))
    return df.select("event_id", "prediction", "proba_achat", "sentiment",
                     C.score_recommendation("prediction", "proba_achat", "sentiment")
                     .alias("recommandation"))


register("nlp_summary", O.with_fixtures("""
SELECT count(*) FILTER (WHERE sentiment = 'positif') AS nb_positif,
  count(*) FILTER (WHERE sentiment = 'negatif') AS nb_negatif,
  count(*) FILTER (WHERE sentiment = 'neutre') AS nb_neutre,
  round(avg(nb_tokens), 1) AS tokens_moyens, round(avg(subjectivite), 3) AS subjectivite_moyenne
FROM nlp""", ENRICHED_CTE, NLP_CTE))(lambda spark, sf_dir: T.nlp_summary(nlp_frame(spark, sf_dir)))

register("user_profile", O.with_fixtures(
    "SELECT event_id, user_id, profil_comportemental FROM profiled",
    ENRICHED_CTE, NLP_CTE, PROFILED_CTE))(
    lambda spark, sf_dir: profiled_frame(spark, sf_dir)
    .select("event_id", "user_id", "profil_comportemental"))

register("profile_counts", O.with_fixtures(
    "SELECT profil_comportemental, count(*) AS nb FROM profiled GROUP BY 1",
    ENRICHED_CTE, NLP_CTE, PROFILED_CTE))(
    lambda spark, sf_dir: PR.profile_counts(profiled_frame(spark, sf_dir)))

register("ml_target", O.with_fixtures(
    "SELECT event_id, action, intention_achat, risque_abandon FROM target", *ML_CTES))(
    lambda spark, sf_dir: target_frame(spark, sf_dir)
    .select("event_id", "action", "intention_achat", "risque_abandon"))

register("target_distribution", O.with_fixtures("""
SELECT CAST(coalesce(sum(intention_achat), 0) AS BIGINT) AS nb_achat,
  CASE WHEN count(*) > 0 THEN round(sum(intention_achat) * 100.0 / count(*), 1) ELSE 0.0 END AS pct_achat,
  CAST(count(*) - coalesce(sum(intention_achat), 0) AS BIGINT) AS nb_abandon,
  CASE WHEN count(*) > 0 THEN round((count(*) - sum(intention_achat)) * 100.0 / count(*), 1)
       ELSE 0.0 END AS pct_abandon,
  CAST(coalesce(sum(risque_abandon), 0) AS BIGINT) AS nb_risque_abandon
FROM target""", *ML_CTES))(lambda spark, sf_dir: PR.target_distribution(target_frame(spark, sf_dir)))
