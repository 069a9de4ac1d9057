"""The three event tables (clicks, transactions, support) derived from test tables.

The reference stores JSON events from three topics.  The shared test data has an
``events`` table plus ``part`` and ``benchmark``; FIXTURES.md fixes a deterministic
mapping of those onto the event schemas.  Everything here is a lazy plan: two
equi-joins on small dimension tables (AQE picks broadcast or sort-merge by the
measured size of each side) and per-row expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import ensure_utc
from .tables import read_table, spread

# Fixed review phrases appended to the benchmark text, by event_id % 6
# (3 means "no review").
PHRASES = {
    0: "Great quality, fast shipping!",
    1: "Terrible product, waste of money.",
    2: "Good value but slow.",
    4: "Very disappointed, broken on arrival",
    5: "",
}
PAGE_BY_MOD5 = ["/accueil", "/produit", "/panier", "/checkout", "/recherche"]
SOURCE_BY_MOD7 = ["google", "direct", "email", "pub"]  # else reseaux_sociaux
METHOD_BY_MOD3 = ["carte", "paypal", "virement"]
REASON_BY_MOD4 = ["remboursement", "livraison", "produit_défectueux", "question"]
CHANNEL_BY_MOD3 = ["chat", "email", "telephone"]


def _pick(index: Column, values: list[str], default: str | None = None) -> Column:
    """``values[index]`` as a CASE expression (stays inside codegen)."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _action(user: Column, etype: Column) -> Column:
    u = user % 4
    return (
        F.when((u == 1) & etype.isin("purchase", "click", "signup"), "purchase")
        .when((u == 2) & (etype == "purchase"), "view")
        .when((u == 3) & etype.isin("purchase", "click"), "purchase")
        .when(etype == "click", "add_to_cart")
        .when(etype == "signup", "search")
        .when(etype == "error", "abandon")
        .otherwise(etype)
    )


def clicks(spark: SparkSession, sf_dir: str, with_event_id: bool = True,
           columns: list[str] | None = None) -> DataFrame:
    """Clickstream view; one row per ``events`` row (``ts`` is read as UTC).

    ``columns`` names the columns wanted (default: all); a dimension table none of them
    comes from is not joined."""
    needs = set(columns or [f.name for f in S.CLICKSTREAM_SCHEMA.fields])
    ensure_utc(spark)
    ev = spread(read_table(spark, sf_dir, "events"), "event_id").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    bench = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    j = ev
    if needs & {"product_title", "category", "price", "rating"}:
        j = j.join(part, ev.k == part.p_partkey, "left")
    if "review_text" in needs:
        # every benchmark row in turn: its number of rows is a scalar subquery
        items = bench.agg(F.count(F.lit(1))).scalar()
        j = j.withColumn("item", F.col("event_id") % items).join(bench, F.col("item") == bench.item_id, "left")
    eid = F.col("event_id")
    phrase = _pick(eid % 6, [PHRASES[0], PHRASES[1], PHRASES[2], None, PHRASES[4], PHRASES[5]])
    # columns of tables that were not joined are left out below, before they are resolved
    rules = [
        F.lpad(F.lower(F.hex(eid)), 8, "0").alias("session_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.col("k").cast("int").alias("product_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("double").alias("price"),
        (F.col("p_size") % 6).cast("double").alias("rating"),
        _action(F.col("user_id"), F.col("event_type")).alias("action"),
        _pick(eid % 5, PAGE_BY_MOD5).alias("page_visitee"),
        F.floor("value").cast("int").alias("duree_visite"),
        _pick(eid % 7, SOURCE_BY_MOD7, "reseaux_sociaux").alias("source"),
        F.when(eid % 6 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("text"), F.lit(" "), phrase))
         .alias("review_text"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("timestamp"),
    ]
    cols = [c for f, c in zip(S.CLICKSTREAM_SCHEMA.fields, rules, strict=True) if f.name in needs]
    if with_event_id:
        cols = [eid] + cols
    return j.select(*cols)


#: What payments and tickets take from their clicks; payments also need the price.
TX_FROM_CLICKS = ["session_id", "user_id", "product_id", "product_title", "category", "timestamp"]
SUPPORT_FROM_CLICKS = ["session_id", "user_id", "timestamp"]


def transactions(spark: SparkSession, sf_dir: str, with_event_id: bool = True,
                 columns: list[str] | None = None) -> DataFrame:
    """One payment per purchase click; ``columns`` as in ``clicks``."""
    needs = set(columns or [f.name for f in S.TRANSACTION_SCHEMA.fields])
    given = [c for c in TX_FROM_CLICKS if c in needs] + (["price"] if "montant_paye" in needs else [])
    c = clicks(spark, sf_dir, columns=["action", *given]).filter(F.col("action") == "purchase")
    eid = F.col("event_id")
    rules = {
        "montant_paye": F.round(F.col("price") * (F.lit(0.8) + F.lit(0.02) * (eid % 11)), 2),
        "methode_paiement": _pick(eid % 3, METHOD_BY_MOD3),
        "statut_paiement": F.when(eid % 5 == 3, "échoué").when(eid % 5 == 4, "en_attente").otherwise("succès"),
    }
    cols = [rules[f.name].alias(f.name) if f.name in rules else F.col(f.name) for f in S.TRANSACTION_SCHEMA.fields if f.name in needs]
    if with_event_id:
        cols = [eid] + cols
    return c.select(*cols)


def support(spark: SparkSession, sf_dir: str, with_event_id: bool = True,
            columns: list[str] | None = None) -> DataFrame:
    """Support tickets for 20 % of sessions; ``columns`` as in ``clicks``."""
    needs = set(columns or [f.name for f in S.SUPPORT_SCHEMA.fields])
    c = clicks(spark, sf_dir, columns=[c for c in SUPPORT_FROM_CLICKS if c in needs]).filter((F.col("event_id") * 7) % 10 < 2)
    eid = F.col("event_id")
    rules = {"motif_contact": _pick(eid % 4, REASON_BY_MOD4), "canal": _pick(eid % 3, CHANNEL_BY_MOD3), "resolu": eid % 2 == 0}
    cols = [rules[f.name].alias(f.name) if f.name in rules else F.col(f.name) for f in S.SUPPORT_SCHEMA.fields if f.name in needs]
    if with_event_id:
        cols = [eid] + cols
    return c.select(*cols)


def defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with injected defects plus 20 duplicated sessions, for quality checks."""
    c = clicks(spark, sf_dir, columns=["session_id", "user_id", "action", "category", "price", "rating", "duree_visite"])
    eid = F.col("event_id")
    changed = c.select(
        "event_id", "session_id", "user_id",
        F.when(eid % 101 == 0, F.lit(None).cast("string"))
         .when(eid % 103 == 0, F.lit("bogus")).otherwise(F.col("action")).alias("action"),
        F.when(eid % 127 == 0, F.lit(None).cast("string")).otherwise(F.col("category")).alias("category"),
        F.when(eid % 107 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
        F.when(eid % 109 == 0, F.lit(7.0)).otherwise(F.col("rating")).alias("rating"),
        F.when(eid % 113 == 0, F.lit(-1)).otherwise(F.col("duree_visite")).alias("duree_visite"),
    )
    return changed.unionByName(c.filter(eid < 20))


@dataclass
class Journey:
    """The three event tables of one data directory."""

    clicks: DataFrame
    transactions: DataFrame
    support: DataFrame

    def tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.clicks, self.transactions, self.support


def journey(spark: SparkSession, sf_dir: str) -> Journey:
    return Journey(clicks(spark, sf_dir), transactions(spark, sf_dir), support(spark, sf_dir))
