"""Column operators against plain-Python references on many generated values."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from sillage.functions import columns as C
from sillage.operators import quality as Q
from sillage.operators import text as T


def test_pseudonym_equals_hashlib(spark):
    ids = list(range(-5, 2000)) + [2**31 - 1, -(2**31)]
    df = spark.createDataFrame([(i,) for i in ids], "user_id int")
    got = {r[0]: r[1] for r in df.select("user_id", C.pseudonym("user_id")).collect()}
    for i in ids:
        assert got[i] == hashlib.sha256(str(i).encode()).hexdigest()[:12]


def test_review_clean_equals_python_regex(spark):
    rnd = random.Random(3)
    alphabet = "abcXYZ éÉç'!?,.09\t\n\u000b\f\r-_ñß"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "review_text string")
    got = [r[0] for r in df.select(C.review_clean()).collect()]
    want = [re.sub(r"[^a-zA-Z \t\n\x0b\f\r]", "", t).lower() for t in texts]
    assert got == want


def test_tokens_equal_python_reference(spark):
    rnd = random.Random(5)
    words = ["great", "the", "products", "reviews", "bad", "slow", "x", "and", "value", ""]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12))) for _ in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts], "review_text string")
    rows = T.with_nlp(df, T.TEST_STOP_WORDS, T.TEST_LEMMAS).select(
        "tokens", "nb_mots_positifs").collect()
    for t, r in zip(texts, rows):
        toks = [w for w in t.split() if w.isalpha() and w not in T.TEST_STOP_WORDS]
        toks = [T.TEST_LEMMAS.get(w, w) for w in toks]
        assert r["tokens"] == toks
        assert r["nb_mots_positifs"] == sum(1 for w in toks if w in ("great", "value"))


def test_histograms_equal_numpy(spark):
    rng = np.random.default_rng(11)
    a = np.concatenate([rng.normal(50, 20, size=5000).round(2), [0.1 * k for k in range(300)]])
    b = np.concatenate([rng.integers(0, 6, size=5000).astype(float), np.zeros(300)])
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    h = Q.histograms(df, {"a": 30, "b": 20}).orderBy("colonne", "bin").collect()
    for col, vals, bins in (("a", a, 30), ("b", b, 20)):
        mine = [r["nb"] for r in h if r["colonne"] == col]
        counts, edges = np.histogram(vals, bins=bins)
        assert mine == list(counts)
        lo = [r["borne_inf"] for r in h if r["colonne"] == col]
        assert lo == list(edges[:-1])
        assert [r["borne_sup"] for r in h if r["colonne"] == col] == list(edges[1:])
