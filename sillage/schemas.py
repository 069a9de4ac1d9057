"""Event schemas and the fixed value lists the operators depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


CLICKSTREAM_SCHEMA = _struct(
    ("session_id", StringType()),
    ("user_id", IntegerType()),
    ("product_id", IntegerType()),
    ("product_title", StringType()),
    ("category", StringType()),
    ("price", FloatType()),
    ("rating", FloatType()),
    ("action", StringType()),
    ("page_visitee", StringType()),
    ("duree_visite", IntegerType()),
    ("source", StringType()),
    ("review_text", StringType()),
    ("timestamp", DoubleType()),
)

TRANSACTION_SCHEMA = _struct(
    ("session_id", StringType()),
    ("user_id", IntegerType()),
    ("product_id", IntegerType()),
    ("product_title", StringType()),
    ("category", StringType()),
    ("montant_paye", FloatType()),
    ("methode_paiement", StringType()),
    ("statut_paiement", StringType()),
    ("timestamp", DoubleType()),
)

SUPPORT_SCHEMA = _struct(
    ("session_id", StringType()),
    ("user_id", IntegerType()),
    ("motif_contact", StringType()),
    ("canal", StringType()),
    ("resolu", BooleanType()),
    ("timestamp", DoubleType()),
)

SCHEMAS = {
    "clickstream": CLICKSTREAM_SCHEMA,
    "transactions": TRANSACTION_SCHEMA,
    "service_client": SUPPORT_SCHEMA,
}

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced, kept verbatim.
# ---------------------------------------------------------------------------

# Event domains.
ACTIONS = ["view", "add_to_cart", "purchase", "abandon", "search"]
PAGES = ["/accueil", "/produit", "/panier", "/checkout", "/recherche"]
SOURCES = ["google", "direct", "email", "pub", "reseaux_sociaux"]
PAYMENT_METHODS = ["carte", "paypal", "virement"]
PAYMENT_STATUSES_VALID = ["succes", "echoue", "en_attente", "succès", "échoué"]
SUPPORT_REASONS = ["remboursement", "livraison", "produit_défectueux", "question"]
CHANNELS = ["chat", "email", "telephone"]

# Engagement score per action (anything else, null included, scores 0).
ACTION_SCORES = {"purchase": 5, "add_to_cart": 3, "view": 1, "search": 1, "abandon": -1}

# Rule recommendations, two text sets (document-store and keyed-store variants).
RECO_TEXTS = {
    "A": {
        "abandon": "Envoyer coupon -20%",
        "add_to_cart": "Livraison gratuite",
        "purchase": "Produits similaires",
        "other": "Continuer navigation",
    },
    "B": {
        "abandon": "Envoyer coupon -20%",
        "add_to_cart": "Proposer livraison gratuite",
        "purchase": "Suggerer produits similaires",
        "other": "Continuer navigation",
    },
}
RECO_COLUMN = {"A": "recommendation", "B": "recommandation"}

# Recommendation from a model score: texts (``%s`` is the percentage) and threshold.
SCORE_RECO_TEXTS = {
    "probable": " ACHAT PROBABLE (%s%%) — Suggérer produits similaires",
    "possible": " ACHAT POSSIBLE (%s%%) — Proposer livraison gratuite",
    "risque": "  RISQUE ABANDON (%s%%) — Envoyer coupon -20%%",
    "navigation": "  NAVIGATION (%s%%) — Continuer navigation",
}
SCORE_RECO_PROBABLE_ABOVE = 80

# Funnel stage order.
FUNNEL_ORDER = ["view", "search", "add_to_cart", "purchase", "abandon"]

# Sentiment word lists (training variant has 18 positive words; streaming has the
# first 14).  Negative words are the same in both.
POSITIVE_WORDS = [
    "great", "excellent", "good", "happy", "satisfied",
    "awesome", "love", "perfect", "recommended", "pleased",
    "impressed", "wonderful", "fantastic", "amazing",
    "quality", "fast", "shipping", "value",
]
POSITIVE_WORDS_STREAM = POSITIVE_WORDS[:14]
NEGATIVE_WORDS = [
    "poor", "bad", "disappointed", "unhappy", "terrible",
    "worst", "dissatisfied", "waste", "awful", "horrible",
    "useless", "broken", "cheap", "slow", "expensive",
]

# Sentiment label thresholds on polarity.
POSITIVE_THRESHOLD = 0.2
NEGATIVE_THRESHOLD = -0.2

# Data-minimisation column lists.
NEEDED_COLUMNS = ["session_id", "user_id", "action", "category", "price", "rating",
                  "source", "timestamp"]
SENSITIVE_COLUMNS = ["review_text", "page_visitee", "duree_visite"]

# Retention periods per table: (calendar years, days).  Enriched clicks are clicks.
RETENTION = {"clickstream": (0, 90), "transactions": (5, 0), "service_client": (3, 0),
             "clickstream_enrichi": (0, 90)}

# Dashboard alert thresholds.
ALERT_CONVERSION_MIN = 50.0
ALERT_FAILED_PAYMENTS_MAX = 10
FAILED_STATUS_REGEX = "(?i)choue|failed"
FAILED_STATUSES = ["échoué", "echoue", "failed"]
SUCCESS_STATUS = "succès"

# Profile names and the thresholds of their rules (first matching rule wins):
# client_fidele: purchase rate > 0.4 and engagement > 10; acheteur_impulsif:
# actions per purchase < 3; comparateur: more than 10 actions and rate < 0.1.
PROFILES = ["client_fidele", "chasseur_promos", "acheteur_impulsif", "comparateur",
            "visiteur_standard"]
LOYAL_RATE_ABOVE = 0.4
LOYAL_SCORE_ABOVE = 10
IMPULSIVE_ACTIONS_PER_PURCHASE_BELOW = 3
BROWSER_ACTIONS_ABOVE = 10
BROWSER_RATE_BELOW = 0.1

# The 28 model features, in the trained order (the last one leaks the target and
# is only kept with ``legacy_features=True``).
FEATURES_BASE = ["price", "rating", "duree_visite", "category_enc", "source_enc", "page_enc"]
FEATURES_NLP = ["sentiment_enc", "sentiment_score", "subjectivite", "nb_tokens",
                "nb_mots_positifs", "nb_mots_negatifs", "score_nlp"]
FEATURES_PROFILE = ["profil_enc"]
FEATURES_ENRICHED = [
    "nb_actions_user", "nb_achats_user", "nb_abandons_user",
    "duree_moy_user", "taux_achat_user", "score_engagement_total",
    "montant_total_depense", "nb_transactions_reussies", "panier_moyen",
    "nb_tickets_support", "nb_remboursements",
    "taux_achat_categorie", "prix_moy_categorie",
]
LEAKY_FEATURE = "risque_abandon"

# The 13 enrichment columns, in output order.
ENRICHED_COLUMNS = list(FEATURES_ENRICHED)
