"""Column expressions shared by batch and streaming operators.

All are built from ``pyspark.sql.functions`` so they compile into whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

# Letters and the whitespace characters of Java's ``\s`` (space, tab, newline,
# vertical tab, form feed, carriage return), spelled out so every engine agrees.
NON_LETTER_OR_SPACE = "[^a-zA-Z \t\n\u000b\f\r]"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def review_clean(text: str | Column = "review_text") -> Column:
    """Lower-cased review with everything but ASCII letters and whitespace removed."""
    return F.lower(F.regexp_replace(col_(text), NON_LETTER_OR_SPACE, ""))


def action_score(action: str | Column = "action") -> Column:
    a = col_(action)
    expr = None
    for name, score in S.ACTION_SCORES.items():
        expr = F.when(a == name, score) if expr is None else expr.when(a == name, score)
    return expr.otherwise(0)


def rule_recommendation(action: str | Column = "action", variant: str = "A") -> Column:
    """Recommendation text from the action alone; ``variant`` picks the text set."""
    t = S.RECO_TEXTS[variant]
    a = col_(action)
    return (F.when(a == "abandon", t["abandon"])
            .when(a == "add_to_cart", t["add_to_cart"])
            .when(a == "purchase", t["purchase"])
            .otherwise(t["other"]))


def score_recommendation(prediction: str | Column, proba: str | Column,
                         sentiment: str | Column) -> Column:
    """Recommendation from a model score (prediction 0/1, purchase probability in %)."""
    p, pr, s = col_(prediction), col_(proba), col_(sentiment)
    inv = F.round(F.lit(100.0) - pr, 1)
    t = S.SCORE_RECO_TEXTS
    return (
        F.when((p == 1) & (pr > S.SCORE_RECO_PROBABLE_ABOVE), F.format_string(t["probable"], pr))
        .when(p == 1, F.format_string(t["possible"], pr))
        .when(s == "negatif", F.format_string(t["risque"], inv))
        .otherwise(F.format_string(t["navigation"], inv))
    )


def behaviour_profile(taux: Column, abandons: Column, achats: Column, actions: Column,
                      score: Column, sentiment: Column) -> Column:
    """First matching rule wins; ``actions`` is floored at 1 like the reference."""
    acts = F.greatest(F.coalesce(actions, F.lit(1)), F.lit(1))
    fidele, promos, impulsif, comparateur, standard = S.PROFILES
    return (
        F.when((taux > S.LOYAL_RATE_ABOVE) & (score > S.LOYAL_SCORE_ABOVE), fidele)
        .when((abandons > achats) & (sentiment == "negatif"), promos)
        .when((achats > 0) & (acts / F.greatest(achats, F.lit(1))
                              < S.IMPULSIVE_ACTIONS_PER_PURCHASE_BELOW), impulsif)
        .when((acts > S.BROWSER_ACTIONS_ABOVE) & (taux < S.BROWSER_RATE_BELOW), comparateur)
        .otherwise(standard)
    )


def sentiment_label(polarity: str | Column) -> Column:
    p = col_(polarity)
    return (F.when(p > S.POSITIVE_THRESHOLD, "positif")
            .when(p < S.NEGATIVE_THRESHOLD, "negatif")
            .otherwise("neutre"))


def pseudonym(user_id: str | Column = "user_id", salt: str | None = None,
              length: int = 12) -> Column:
    """First ``length`` hex chars of SHA-256 of the id's decimal text (optionally salted).

    The id is cast to bigint first so a nullable integer never hashes as "8.0".
    """
    text = col_(user_id).cast("bigint").cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.substring(F.sha2(text, 256), 1, length)


def event_time(ts_seconds: str | Column = "timestamp") -> Column:
    """Epoch seconds (double) → timestamp."""
    return F.timestamp_micros(F.round(col_(ts_seconds) * 1_000_000).cast("bigint"))


def minute_of(ts_seconds: str | Column = "timestamp") -> Column:
    """Epoch seconds → start of its minute, as a zone-less timestamp."""
    secs = F.floor(col_(ts_seconds) / 60) * 60
    return F.timestamp_seconds(secs).cast("timestamp_ntz")


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den, 0 when the denominator is 0 or null."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def valid_in(c: str | Column, domain: list[str]) -> Column:
    """Membership that counts null as invalid (pandas ``isin`` semantics)."""
    return F.coalesce(col_(c).isin(*domain), F.lit(False))


def no_nan(c: str | Column) -> Column:
    """NaN → null, so comparisons and averages skip it like pandas does."""
    x = col_(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


# Currency: summed as decimals with ten places, so nothing is rounded to cents row by row
# and totals and means don't depend on summation order (so on partitioning and engine).
# NaN and infinite amounts are missing values, in the sum and in the count alike.
MONEY = "decimal(38,10)"


def money_sum(c: str | Column) -> Column:
    """Exact sum of a currency column, as double; null when no value."""
    return F.sum(no_nan(c).try_cast(MONEY)).cast("double")


def money_avg(c: str | Column) -> Column:
    """Mean of a currency column from the exact sum; null when no value."""
    amount = no_nan(c).try_cast(MONEY)
    n = F.count(amount)
    return F.when(n > 0, F.sum(amount).cast("double") / n)


def optional(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` of ``df``, or a null of type ``kind`` where the table has none."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)
