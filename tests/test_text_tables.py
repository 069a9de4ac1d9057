"""Lemma tables of any size."""

from pyspark.sql import functions as F

from sillage.operators import text as T


def test_lemma_table_of_100_000_forms_both_ways(spark):
    table = spark.range(100_000).select(F.concat(F.lit("w"), "id").alias("form"), F.concat(F.lit("l"), F.col("id") % 977).alias("lemma"))
    table = table.unionByName(spark.createDataFrame([("w5", "a-least"), (None, "x"), ("w6", None), ("same", "same")], "form string, lemma string"))
    rows = [(i, [f"w{(i * 31 + k) % 130_000}" for k in range(i % 9)]) for i in range(3000)] + [(9001, ["w5", "w6", "same", "none", "w5"]), (9002, []), (9003, None)]
    df = spark.createDataFrame(rows, "id long, toks array<string>")

    def lemma(t):
        n = int(t[1:]) if t[1:].isdigit() else None
        return t if n is None or n >= 100_000 else "a-least" if n == 5 else f"l{n % 977}"

    want = {i: None if toks is None else [lemma(t) for t in toks] for i, toks in rows}
    for max_bytes in (T.MAX_DICTIONARY_BYTES, 0):
        out = T.lemmatise_by(df, "toks", table, "id", max_bytes=max_bytes)
        assert out.columns == ["id", "toks", "lemmes"]
        assert {r["id"]: r["lemmes"] for r in out.collect()} == want
    plan = T.lemmatise_by(df, "toks", table, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan and "SortMergeJoin" not in plan.split("Subquery")[0]
    assert T.lemmatise_by(df, "toks", table.limit(0), "id").where("lemmes != toks").count() == 0
