"""Point-in-time features — what was known of a user just before each click.

Clicks, payments and tickets become one union sorted by user and time; a row's features are
the totals of its user's strictly earlier rows, so nothing that a click leads to reaches
its own features.  The sort is by range, so a user with a third of all rows lies in many
partitions: each partition adds up its own rows, and the totals of a user's earlier
partitions are carried into the later ones.  Only users that lie across a border carry
anything, so the carried table has fewer rows than there are partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import MONEY, action_score, event_time, no_nan, safe_ratio
from .joins import materialize


def running_totals(rows: DataFrame, key: str, time: str, sums: list[str]) -> DataFrame:
    """``rows`` with ``<c>_avant`` for each column of ``sums``: its total over the rows of
    equal ``key`` whose ``time`` (a long) is strictly earlier, 0 if there are none.

    Rows without key or time have nothing before them and count for no other row.
    """
    names = [f"{c}_avant" for c in sums]
    placed = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    loose = rows.where(F.col(key).isNull() | F.col(time).isNull())
    ranged = placed.repartitionByRange(key, time).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "asof")  # equal (key, time) share a range, so no tie spans a border
    per = ranged.groupBy(key, "_part").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select(key, "_part", F.count(F.lit(1)).over(earlier).alias("_parts"), *[F.sum(c).over(earlier).alias(f"{c}_porte") for c in sums])
    carried = carried.where("_parts > 0").drop("_parts")
    before = Window.partitionBy(key, "_part").orderBy(time).rangeBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.sum(c).over(before).alias(n) for c, n in zip(sums, names)])
    out = out.join(F.broadcast(materialize(carried, "carried")), [key, "_part"], "left")
    zero = {c: F.lit(0).cast(rows.schema[c].dataType) for c in sums}
    out = out.select(*rows.columns, *[(F.coalesce(F.col(n), zero[c]) + F.coalesce(F.col(f"{c}_porte"), zero[c])).alias(n) for c, n in zip(sums, names)])
    none = loose.select("*", *[zero[c].cast(out.schema[n].dataType).alias(n) for c, n in zip(sums, names)])
    return out.unionByName(none)


COUNTED = ["actions", "achats", "abandons", "durees", "duree", "score", "succes", "montant", "tickets", "remboursements"]


def _moments(df: DataFrame, **values) -> DataFrame:
    """A table's rows as terms of the user totals; what it doesn't give is 0."""
    kinds = {"montant": MONEY}
    zero = {c: F.lit(0).cast(kinds.get(c, "long")) for c in COUNTED}
    terms = [F.coalesce(F.col(values[c]) if isinstance(values.get(c), str) else values[c], zero[c]).cast(kinds.get(c, "long")).alias(c)
             if c in values else zero[c].alias(c) for c in COUNTED]
    click = F.col("event_id") if "event_id" in values else F.lit(None).cast("long")
    return df.select(F.col("user_id").cast("int").alias("user_id"), F.unix_micros(event_time("timestamp")).alias("instant"),
                     click.alias("event_id"), *terms)


def asof_features(clicks: DataFrame, transactions: DataFrame | None = None, support: DataFrame | None = None) -> DataFrame:
    """The user features E1-E11 of every click as of just before it: (event_id, ...).

    A user's first click has zeros and a null mean visit."""
    one = F.lit(1)

    def flag(condition):
        return condition.cast("long")

    a = F.col("action")
    parts = [_moments(clicks, event_id=True, actions=one, achats=flag(a == "purchase"), abandons=flag(a == "abandon"),
                      durees=flag(F.col("duree_visite").isNotNull()), duree="duree_visite", score=action_score("action"))]
    if transactions is not None:
        paid = transactions.where(F.col("statut_paiement") == S.SUCCESS_STATUS)
        parts.append(_moments(paid, succes=one, montant=no_nan("montant_paye").try_cast(MONEY)))
    if support is not None:
        parts.append(_moments(support, tickets=one, remboursements=flag(F.col("motif_contact") == "remboursement")))
    rows = running_totals(reduce(DataFrame.unionByName, parts), "user_id", "instant", COUNTED)
    v = {c: F.col(f"{c}_avant") for c in COUNTED}
    amount = v["montant"].cast("double")
    return rows.where("event_id is not null").select(
        "event_id", "user_id", v["actions"].alias("nb_actions_user"), v["achats"].alias("nb_achats_user"), v["abandons"].alias("nb_abandons_user"),
        F.when(v["durees"] > 0, v["duree"] / v["durees"]).alias("duree_moy_user"),
        safe_ratio(v["achats"], v["actions"]).alias("taux_achat_user"), v["score"].alias("score_engagement_total"),
        amount.alias("montant_total_depense"), v["succes"].alias("nb_transactions_reussies"),
        safe_ratio(amount, v["succes"]).alias("panier_moyen"), v["tickets"].alias("nb_tickets_support"), v["remboursements"].alias("nb_remboursements"))
