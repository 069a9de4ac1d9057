"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text (presence, hashed into 2**BITS cells): its words, word stems (first
letters), bigrams and one-skip bigrams.  Presence makes a text of any length comparable:
a few telling words weigh the same in 20 words as in 20,000.

Training runs on about ``MAX_FIT_ROWS`` labelled rows at most (a documented bound, chosen
by a hash of the id).  Their features are made where the rows are; FTRL, which learns from
one row after the other, then runs ``EPOCHS`` passes over that bounded sample in one task,
with per-coordinate rates and L1/L2 penalties.  L1 leaves few non-zero weights, so the
model is compact enough to broadcast: never more than 2**BITS numbers.  Scoring is one
narrow scan of all texts.

Edge cases: null and empty texts score the bias alone; rows with a null id are scored
and never used for training; ids labelled more than once count as toxic if any label
is; null labels are ignored; with no labelled rows every score is PRIOR.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import materialize
from .common import LETTERS, Words, distinct, mix64, small_batches

BITS = 20
STEM = 5
MAX_FIT_ROWS = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 1.0
THRESHOLD = 0.3
PRIOR = 0.1


def cells_of(column: pa.Array, bits: int = BITS) -> list[np.ndarray]:
    """Per text: its sorted distinct feature cells."""
    words = Words(pc.utf8_lower(column.cast(pa.large_string())), LETTERS, STEM)
    h, at = words.hashes, words.at.tolist()

    def cells(x: np.ndarray) -> np.ndarray:
        return (mix64(x) >> np.uint64(64 - bits)).astype(np.int32)

    one, stem = cells(h), cells(words.stems + np.uint64(1))
    two, skip = cells(h[:-1] * np.uint64(3) + h[1:]), cells(h[:-2] * np.uint64(5) + h[2:])
    return [distinct(np.concatenate((one[a:b], stem[a:b], two[a : max(a, b - 1)], skip[a : max(a, b - 2)]))) for a, b in zip(at, at[1:])]


class Ftrl:
    """FTRL-proximal state: z and n per coordinate; weights are solved on demand."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, cells: np.ndarray) -> np.ndarray:
        z, n = self.z[cells], self.n[cells]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, cells: np.ndarray, label: int) -> None:
        w = self.weights(cells)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[cells]
        self.z[cells] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[cells] = n + g * g


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_FIT_ROWS) -> dict[int, float]:
    """Non-zero weights by cell (cell 2**BITS is the bias), learnt from labelled rows that
    are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("lid")).agg(F.max(label_col).cast("int").alias("label")))
    marks = materialize(marks, "toxic-labels")
    share = min(1.0, max_rows / max(marks._sillage_rows, 1))
    picked = marks.where(F.pmod(F.xxhash64("lid", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    # about max_rows narrow rows by the bound above: a proven size
    rows = (docs.select(F.col(id_col).alias("lid"), F.col(text_col).alias("body"))
            .join(F.broadcast(picked), "lid").select("lid", "label", "body"))

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cells_of(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in cells], pa.binary())],
                                             ["lid", "label", "cells"])

    def fit(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        model, bias = Ftrl(1 << BITS), np.array([1 << BITS], np.int32)
        sample = sample.sort_values(["lid", "cells"], kind="stable")
        cells = [np.concatenate((np.frombuffer(c, np.int32), bias)) for c in sample["cells"]]
        marks_, order = sample["label"].to_numpy(), np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in order.permutation(len(cells)):
                model.learn(cells[i], marks_[i])
        used = np.flatnonzero(model.n)
        w = model.weights(used)
        return pd.DataFrame({"cell": used[w != 0], "w": w[w != 0]})

    id_type = docs.schema[id_col].dataType.simpleString()
    sample = rows.mapInArrow(featurize, f"lid {id_type}, label int, cells binary")
    out = sample.groupBy(F.lit(0).alias("all")).applyInPandas(fit, "cell bigint, w double")
    return {r["cell"]: r["w"] for r in out.collect()}  # at most 2**BITS + 1 rows


def score(docs: DataFrame, weights: dict[int, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    spark = docs.sparkSession
    small_batches(spark)
    table = np.zeros((1 << BITS) + 1, np.float32)
    table[list(weights)] = list(weights.values())
    shared = spark.sparkContext.broadcast(table)
    trained, bits = bool(weights), BITS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            margin = np.array([w[c].sum(dtype=np.float64) + w[-1] for c in cells_of(batch.column(1), bits)], np.float64)
            value = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) if trained else np.full(len(margin), PRIOR)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], [id_col, "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return (docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {id_type}, score double")
            .select(id_col, held_out(id_col).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
