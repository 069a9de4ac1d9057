"""Review text: tokens, lemmas, lexicon word counts, polarity and subjectivity.

The reference runs tokenizer, lemmatizer and a sentiment library row by row in
Python.  Here each step is a higher-order array expression evaluated inside the
JVM on the row that holds the review: no shuffle, no Python worker, and the cost
of a review grows only with its own length.

Small dictionaries (stop words, lemma pairs, lexicon) become literal arrays or maps
in the plan.  Map lookups scan the keys, so a lexicon given as a DataFrame is used
that way only when its row count is proven below ``MAX_LITERAL_ROWS``; a larger one
is hash-joined instead (each distinct review text is exploded to words and joined
with the lexicon, then the per-text means are joined back).  Both give the same scores: a
repeated word first becomes one row of its mean scores, and null scores are left out.

A lemma table of any size (``lemmatise_by``) is first cut down to the forms that the texts
hold, each joined once.  What is left goes to the tasks as a hash table of small maps, so a
lookup scans a handful of keys and no text is shuffled; only a dictionary beyond
``MAX_DICTIONARY_BYTES`` is joined to the exploded tokens instead.

Sentiment is the mean polarity (and subjectivity) of the review words found in
the lexicon, 0.0 when none is found.  Unlike the reference's library, intensifiers
and negations are not modelled, so scores are not bit-equal to it; the thresholds
(> 0.2 positive, < -0.2 negative, on the unrounded mean) and 3-decimal rounding are
the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import col_, review_clean, sentiment_label
from .joins import BROADCAST_MAX_BYTES, known_rows, materialize, row_count_at_most

MAX_LITERAL_ROWS = 1_000
#: Bytes of a dictionary that is handed to every task; keys in one map of its hash table.
MAX_DICTIONARY_BYTES, BUCKET_KEYS = 32 * 1024 * 1024, 4

# Test lexicon (word, polarity, subjectivity); made up, see FIXTURES.md §4.
TEST_LEXICON = [
    ("great", 0.8, 0.75),
    ("fast", 0.2, 0.6),
    ("good", 0.7, 0.6),
    ("slow", -0.35, 0.4),
    ("terrible", -1.0, 1.0),
    ("waste", -0.2, 0.1),
    ("disappointed", -0.75, 0.75),
    ("broken", -0.4, 0.4),
]
TEST_STOP_WORDS = ["the", "and", "of", "for", "with", "that", "in", "on", "to", "but", "very"]
TEST_LEMMAS = {"products": "product", "reviews": "review"}


def _lit_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


@lru_cache(1)
def english_stop_words() -> tuple[str, ...]:
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def words(clean: str | Column = "review_clean") -> Column:
    """Whitespace split of cleaned text; empty pieces dropped; null text → []."""
    parts = F.split(F.trim(F.coalesce(col_(clean), F.lit(""))), r"\s+")
    return F.filter(parts, lambda t: F.length(t) > 0)


def tokens(clean: str | Column = "review_clean", stop_words: Sequence[str] | None = None,
           lemmas: Mapping[str, str] | None = None) -> Column:
    """Alphabetic tokens, stop words removed (None: Spark's English list), then
    lemmatised by the lemma map."""
    stop = _lit_array(list(english_stop_words() if stop_words is None else stop_words))
    toks = F.filter(words(clean), lambda t: t.rlike("^[a-z]+$") & ~F.array_contains(stop, t))
    return lemmatise(toks, lemmas) if lemmas else toks


def lemmatise(toks: Column, lemmas: Mapping[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for kv in lemmas.items() for x in kv])
    return F.transform(toks, lambda t: F.coalesce(F.try_element_at(m, t), t))


def hash_table(entries: DataFrame, key: str, value: str) -> tuple[Column, int]:
    """``entries`` (materialised, of checked size, unique non-null keys) as an array of small
    maps, a constant of the plan, and its length; ``look_up`` reads it."""
    n = max(1, -(-(known_rows(entries) or entries.count()) // BUCKET_KEYS))
    every = entries.sparkSession.range(n).select(F.col("id").cast("int").alias("b"))
    place = F.pmod(F.hash(key), F.lit(n))
    maps = (every.join(entries.select(place.alias("b"), F.struct(key, value).alias("e")), "b", "left").groupBy("b")
            .agg(F.map_from_entries(F.collect_list("e")).alias("m")))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("b", F.to_json("m").alias("m")))), lambda r: r["m"])
    text = maps.agg(F.concat(F.lit("["), F.array_join(in_order, ","), F.lit("]"))).first()[0]
    kind = entries.schema[value].dataType.simpleString()
    return F.from_json(F.lit(text), f"array<map<string,{kind}>>"), n


def look_up(table: tuple[Column, int], word: Column) -> Column:
    """The value of ``word`` in a ``hash_table``, null if it has none."""
    maps, n = table
    return F.try_element_at(F.get(maps, F.pmod(F.hash(word), F.lit(n))), word)


def lemmatise_by(df: DataFrame, toks: str, lemmas: DataFrame, id_col: str, out: str = "lemmes",
                 max_bytes: int = MAX_DICTIONARY_BYTES) -> DataFrame:
    """``df`` with ``out``, the tokens of the array column ``toks`` replaced by their
    lemmas of the table ``lemmas`` (form, lemma); a token without one stays.

    A form that stands several times in the table has its least lemma; null forms and
    lemmas don't count.  ``id_col`` identifies a row; it is used for a large dictionary only.
    """
    one = lemmas.where("form is not null and lemma is not null").groupBy("form").agg(F.min("lemma").alias("lemma"))
    forms = df.select(F.explode(F.array_distinct(toks)).alias("form")).distinct()
    found = materialize(forms.join(one, "form").where("form != lemma"), "lemmas")
    size = found.agg(F.sum(F.octet_length("form") + F.octet_length("lemma") + 64)).first()[0] or 0
    if size <= max_bytes:
        table = hash_table(found, "form", "lemma")
        return df.withColumn(out, F.transform(toks, lambda t: F.coalesce(look_up(table, t), t)))
    placed = df.select(F.col(id_col).alias("_id"), F.posexplode(toks).alias("_pos", "form")).join(found, "form", "left")
    rows = placed.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("lemma", "form").alias("t")))).alias("_r"))
    none = F.array().cast("array<string>")
    return (df.join(rows, F.col(id_col) == F.col("_id"), "left")
            .withColumn(out, F.when(F.col(toks).isNotNull(), F.coalesce(F.transform("_r", lambda r: r["t"]), none))).drop("_id", "_r"))


def count_in(toks: Column, word_list: Sequence[str]) -> Column:
    """How many tokens (with repeats) are in ``word_list``."""
    lst = _lit_array(list(word_list))
    return F.size(F.filter(toks, lambda t: F.array_contains(lst, t)))


def with_nlp(df: DataFrame, stop_words: Sequence[str] | None = None,
             lemmas: Mapping[str, str] | None = None,
             positive: Sequence[str] = S.POSITIVE_WORDS,
             negative: Sequence[str] = S.NEGATIVE_WORDS) -> DataFrame:
    """Tokens, nb_tokens, positive / negative counts, score_nlp."""
    if "review_clean" not in df.columns:
        df = df.withColumn("review_clean", review_clean("review_text"))
    df = df.withColumn("tokens", tokens("review_clean", stop_words, lemmas))
    return (df.withColumn("nb_tokens", F.size("tokens"))
            .withColumn("nb_mots_positifs", count_in(F.col("tokens"), positive))
            .withColumn("nb_mots_negatifs", count_in(F.col("tokens"), negative))
            .withColumn("score_nlp", F.col("nb_mots_positifs") - F.col("nb_mots_negatifs")))


def _finish(df: DataFrame, pol: str, subj: str) -> DataFrame:
    return (df.withColumn("sentiment", sentiment_label(F.col(pol)))
            .withColumn("sentiment_score", F.round(F.col(pol), 3))
            .withColumn("subjectivite", F.round(F.col(subj), 3))
            .drop(pol, subj))


def with_sentiment(df: DataFrame, lexicon: Sequence[tuple[str, float, float]] | DataFrame,
                   clean_col: str = "review_clean") -> DataFrame:
    """Sentiment label, sentiment_score and subjectivite from a lexicon."""
    if clean_col not in df.columns:
        df = df.withColumn(clean_col, review_clean("review_text"))
    if isinstance(lexicon, DataFrame):
        lexicon = _one_row_a_word(lexicon)
        if not row_count_at_most(lexicon, MAX_LITERAL_ROWS):
            return _sentiment_by_join(df, lexicon, clean_col)
        lexicon = [tuple(r) for r in lexicon.collect()]
    else:
        seen: dict[str, list] = {}
        for word, *scores in lexicon:
            if word is not None:
                seen.setdefault(word, []).append(scores)
        lexicon = [(w, *map(_mean, zip(*rows))) for w, rows in seen.items()]
    table = F.create_map(*[x for w, p, s in lexicon for x in (
        F.lit(w), F.struct(F.lit(p).cast("double").alias("p"), F.lit(s).cast("double").alias("s")))])
    if not lexicon:
        table = table.cast("map<string, struct<p: double, s: double>>")
    zero = F.struct(F.lit(0.0).alias("p"), F.lit(0).alias("np"), F.lit(0.0).alias("s"), F.lit(0).alias("ns"))

    def add(acc: Column, word: Column) -> Column:
        x = F.try_element_at(table, word)
        return F.struct(
            (acc["p"] + F.coalesce(x["p"], F.lit(0.0))).alias("p"), (acc["np"] + x["p"].isNotNull().cast("int")).alias("np"),
            (acc["s"] + F.coalesce(x["s"], F.lit(0.0))).alias("s"), (acc["ns"] + x["s"].isNotNull().cast("int")).alias("ns"))

    out = df.withColumn("_sum", F.aggregate(words(clean_col), zero, add))
    for name, total, n in (("_pol", "_sum.p", "_sum.np"), ("_sub", "_sum.s", "_sum.ns")):
        out = out.withColumn(name, F.when(F.col(n) > 0, F.col(total) / F.col(n)).otherwise(F.lit(0.0)))
    return _finish(out.drop("_sum"), "_pol", "_sub")


def _mean(values: Sequence[float | None]) -> float | None:
    known = [float(v) for v in values if v is not None]
    return sum(known) / len(known) if known else None


def _one_row_a_word(lexicon: DataFrame) -> DataFrame:
    """(word, polarity, subjectivity): means of a repeated word's rows, null scores left out."""
    return lexicon.where(F.col("word").isNotNull()).groupBy("word").agg(
        F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity"))


def _sentiment_by_join(df: DataFrame, lexicon: DataFrame, clean_col: str) -> DataFrame:
    """Large-lexicon path: distinct texts → words → equi-join → mean per text → join back."""
    texts = df.select(F.col(clean_col).alias("_txt")).where("_txt != ''").distinct()
    exploded = texts.select("_txt", F.explode(words(F.col("_txt"))).alias("word"))
    scored = (exploded.join(lexicon.select("word", "polarity", "subjectivity"), "word")
              .groupBy("_txt").agg(F.avg("polarity").alias("_pol"),
                                   F.avg("subjectivity").alias("_sub")))
    # One row per distinct scored text: broadcast when its bytes, as measured, are few, else a
    # sort-merge join in which AQE splits a hot text (e.g. a very common review).
    scored = materialize(scored, "sentiment-texts")
    size = scored.agg(F.sum(F.octet_length("_txt") + 32)).first()[0] or 0
    scored = F.broadcast(scored) if size <= BROADCAST_MAX_BYTES else scored
    out = (df.withColumn("_txt", F.nullif(F.col(clean_col), F.lit("")))
           .join(scored, "_txt", "left")
           .na.fill({"_pol": 0.0, "_sub": 0.0}).drop("_txt"))
    return _finish(out, "_pol", "_sub")


def nlp_summary(df: DataFrame) -> DataFrame:
    """Reviews per sentiment, mean token count, mean subjectivity (one row)."""
    s = F.col("sentiment")
    return df.agg(
        F.count_if(s == "positif").alias("nb_positif"),
        F.count_if(s == "negatif").alias("nb_negatif"),
        F.count_if(s == "neutre").alias("nb_neutre"),
        F.round(F.avg("nb_tokens"), 1).alias("tokens_moyens"),
        F.round(F.avg("subjectivite"), 3).alias("subjectivite_moyenne"),
    )
