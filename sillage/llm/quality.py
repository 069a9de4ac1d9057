"""Quality classifier: hierarchical empirical Bayes over document, path and host.

Three levels:

1. Document evidence: a logistic model over surface features of the whole text
   (repeated words and lines, junk marks, capitals, table bars, word shape), fitted on at
   most ``MAX_FIT_ROWS`` labelled rows that are not held out (a documented bound).
2. Host posterior: a host's mean evidence, shrunk towards the global mean as if
   ``kappa`` more documents of the global mean had been seen; ``kappa`` is estimated from the
   spread between hosts (method of moments), so noise between small hosts is not
   taken for quality.
3. Path posterior: the same, from path towards host.

A document's posterior odds are its evidence odds times the odds ratio of its path to
the global mean.  All sums are grouped aggregates with map-side partial sums (a host with
a third of all rows is no hot key); the site table is broadcast only when proven small.

In ``documents`` the host is ``source`` and the path is ``lang`` within it.

Edge cases: null host or path is a group of its own; null and empty texts have the
features of no words; null labels are ignored and a document labelled more than once is
good only if all labels are; repeated rows are scored alike; with no labelled rows of
both classes the evidence is PRIOR and everything is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small, materialize
from .common import small_batches

MAX_FIT_ROWS = 30_000
RIDGE = 1.0
THRESHOLD = 0.5
PRIOR = 0.8
#: Evidence and rates stay this far from 0 and 1 when odds are taken.
EDGE = 1e-6

FEATURES = ("bias", "log_words", "distinct", "repeated", "repeated_lines", "capitals", "letters", "digits",
            "marks", "bars", "word_length", "spaces", "junk_words")
_MARKS = frozenset(b"!$%&#*@^~<>{}[]\\=_")
_KIND = np.zeros(256, np.uint8)
for _c in range(256):
    _KIND[_c] = (1 if 65 <= _c <= 90 else 2 if 97 <= _c <= 122 or _c >= 128 else 3 if 48 <= _c <= 57 else
                 4 if _c in _MARKS else 5 if _c == 124 else 6 if _c in (32, 9, 10, 11, 12, 13) else 0)
_JUNK = tuple("!$%&#*|")


def features(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n = len(words)
    if n == 0:
        return [1.0] + [0.0] * (len(FEATURES) - 1)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=7) / len(raw)
    lines = [x for x in text.split("\n") if x]
    junk = sum(w.endswith(_JUNK) for w in words) / n
    return [1.0, math.log1p(n), len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n,
            1 - len(set(lines)) / max(len(lines), 1), kinds[1], kinds[2], kinds[3], kinds[4], kinds[5],
            len(text) / n / 10, kinds[6], junk]


@dataclass
class Logistic:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float | None = None

    def __call__(self, rows: list[list[float]]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(rows), self.prior)
        x = (np.array(rows, np.float64).reshape(-1, len(self.mean)) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -12, 12)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> Logistic:
    """Ridge logistic regression by Newton steps on a bounded matrix."""
    if len(y) == 0 or y.min() == y.max():
        return Logistic(np.zeros(len(FEATURES)), np.zeros(len(FEATURES)), np.ones(len(FEATURES)), PRIOR)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -12, 12)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(w, mean, scale)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = MAX_FIT_ROWS) -> Logistic:
    """The document model, from at most about ``max_rows`` labelled rows picked by a hash."""
    small_batches(docs.sparkSession)
    marks = materialize(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
                        .groupBy(F.col(id_col).alias("lid")).agg(F.min(label_col).cast("int").alias("label")), "quality-labels")
    share = min(1.0, max_rows / max(marks._sillage_rows, 1))
    picked = marks.where(F.pmod(F.xxhash64("lid", F.lit(9)), F.lit(1_000_000)) < int(share * 1_000_000))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(features, batch.column(2).to_pylist()), pa.list_(pa.float64()))],
                                             ["lid", "label", "x"])

    rows = (docs.select(F.col(id_col).alias("lid"), F.col(text_col).alias("body")).join(F.broadcast(picked), "lid")
            .select("lid", "label", "body").mapInArrow(scan, f"lid {docs.schema[id_col].dataType.simpleString()}, label int, x array<double>"))
    got = sorted((r["lid"], r["label"], tuple(r["x"])) for r in rows.collect())  # the bounded sample, numbers only
    return fit_logistic(np.array([g[2] for g in got]).reshape(-1, len(FEATURES)), np.array([g[1] for g in got], np.float64))


def with_evidence(docs: DataFrame, model: Logistic, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns ``keep``, or all) with a column ``evidence``: the document
    model's probability that the row is good."""
    small_batches(docs.sparkSession)
    names = list(docs.columns) if keep is None else keep
    schema = docs.select(*names).schema.add("evidence", "double")
    at = names.index(text_col) if text_col in names else len(names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model([features(t) for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(p)], [*names, "evidence"])

    return docs.select(*names, *([] if text_col in names else [text_col])).mapInArrow(scan, schema)


def _kappa(groups: DataFrame, parent: str) -> float:
    """Pseudo-documents of shrinkage: within-group over between-group variance (ANOVA)."""
    row = groups.agg(
        F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * F.col("n")),
        F.sum("ss_within"), F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col(parent)) ** 2)).first()
    groups_, n, n2, within, between = (float(x or 0) for x in row)
    if n <= groups_ or groups_ < 2:
        return 1.0
    inside = max(within / (n - groups_), EDGE)
    spread = (between - (groups_ - 1) * inside) / max(n - n2 / n, 1.0)
    return min(max(inside / spread if spread > 0 else 1e6, 1.0), 1e6)


def sites(evidence: DataFrame, host_col: str = "source", path_col: str = "lang") -> tuple[DataFrame, float]:
    """(host, path, host_rate, path_rate) and the global mean, from rows with ``evidence``."""
    paths = materialize(evidence.groupBy(F.col(host_col).alias("host"), F.col(path_col).alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("s"), F.sum(F.col("evidence") * F.col("evidence")).alias("q")), "paths")
    total = paths.agg(F.sum("s"), F.sum("n")).first()
    overall = float(total[0] / total[1]) if total[1] else PRIOR
    ss = (F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("ss_within")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    hosts = hosts.select("host", "n", "s", ss, F.lit(overall).alias("parent"))
    k = _kappa(hosts, "parent")
    hosts = materialize(hosts.select("host", ((F.col("s") + k * overall) / (F.col("n") + k)).alias("host_rate")), "hosts")
    joined = paths.join(broadcast_if_small(hosts).withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
    joined = joined.select("host", "path", "n", "s", ss, "host_rate")
    k = _kappa(joined, "host_rate")
    return materialize(joined.select("host", "path", "host_rate", (
        (F.col("s") + k * F.col("host_rate")) / (F.col("n") + k)).alias("path_rate")), "sites"), overall


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(q / (1 - q))


def posterior(rows: DataFrame, table: DataFrame, overall: float, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``rows`` with ``host_rate``, ``path_rate`` and ``posterior`` (names the input must not use)."""
    table = table.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "host_rate", "path_rate")
    joined = rows.join(broadcast_if_small(table), F.col(host_col).eqNullSafe(F.col("__host")) & F.col(path_col).eqNullSafe(F.col("__path")), "left")
    odds = _logit(F.col("evidence")) + _logit(F.coalesce("path_rate", F.lit(overall))) - _logit(F.lit(overall))
    return joined.drop("__host", "__path").withColumn("posterior", 1 / (1 + F.exp(-odds)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, evidence, host_rate, path_rate, posterior, kept) for every row."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("host_"), F.col(path_col).alias("path_"))
    seen = materialize(with_evidence(narrow, model, "text", ["doc_id", "host_", "path_"]), "evidence")
    table, overall = sites(seen, "host_", "path_")
    return posterior(seen, table, overall, "host_", "path_").select(
        "doc_id", held_out("doc_id").alias("held_out"), "evidence", "host_rate", "path_rate", "posterior",
        (F.col("posterior") >= THRESHOLD).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose posterior reaches THRESHOLD.

    The evidence is computed twice (for the site table, then per row): cheaper than
    shuffling all texts to join it back."""
    own = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)])  # no clashing names below
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    text, host, path = at[text_col], at[host_col], at[path_col]
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    seen = materialize(with_evidence(own, model, text, [host, path]), "evidence")
    table, overall = sites(seen, host, path)
    kept = posterior(with_evidence(own, model, text), table, overall, host, path).where(F.col("posterior") >= THRESHOLD)
    return kept.select(*[F.col(at[c]).alias(c) for c in docs.columns])
