"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are short, documents long, so resemblance of whole sets says nothing; what is
searched is the share of an *item's* shingles that a document holds.  Items are
partitioned by the size of their shingle set (powers of two).  An item's signature is its
bottom-k MinHash sketch: the k shingles of least hash, k fixed per partition so that
more than (1 - threshold) of the largest set in it is sketched.  A document that holds
``threshold`` of an item's shingles then holds at least one shingle of the sketch: the
search has no false negatives.  Candidates are verified on whole word shingles, exactly.

Items come in blocks of bounded size (``BLOCK_ITEMS`` items, ``BLOCK_CHARS`` characters):
each block is a broadcast index of proven size, and each block scans all documents once.
Words are runs of ASCII letters and digits and of characters beyond ASCII, lower-cased, so
case, ASCII punctuation and line breaks don't hide a passage.  An item of fewer words than a shingle is one shingle of its own
length.

Edge cases: null, empty and wordless items match nothing; null and empty documents hold
nothing; repeated items and documents are reported row by row; an empty item table
leaves all documents clean.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, Words, distinct, mix64, shingles, small_batches

WIDTH = 5
THRESHOLD = 0.8
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000

_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall(lowered(pa.array([text or ""]))[0].as_py().encode())


def grams(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    size = min(width, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


class Index:
    """Sketches of a block of items, by shingle length and size partition."""

    def __init__(self, items: list[tuple[object, str | None]], width: int, threshold: float):
        self.threshold = threshold
        self.items: list[tuple[object, int, frozenset]] = []
        sketch: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        texts = pa.array([t for _, t in items], pa.large_string())
        for (item_id, text), own in zip(items, Words(lowered(texts), LETTERS).shingles(width)):
            words = words_of(text)
            if not words:
                continue
            own, size = distinct(own), min(width, len(words))
            part = int(own.size).bit_length()  # sizes 2**(part-1) .. 2**part - 1
            most = 2**part - 1
            k = most - math.ceil(threshold * most - 1e-9) + 1  # one more than may be missed, as matches() counts
            for h in own[np.argsort(mix64(own))][:k].tolist():
                sketch[size][h].append(len(self.items))
            self.items.append((item_id, size, frozenset(grams(words, size))))
        self.sketch = {size: dict(table) for size, table in sketch.items()}
        self.keys = {size: np.sort(np.fromiter(table, np.uint64, len(table))) for size, table in self.sketch.items()}

    def matches(self, column: pa.Array) -> Iterator[tuple[int, object, int, int]]:
        """(place in the column, item, size, common) of every item that a text contains."""
        words = Words(lowered(column), LETTERS)
        found: dict[int, set[int]] = defaultdict(set)
        for size, keys in self.keys.items():
            if len(words.hashes) < size:
                continue
            own = shingles(words.hashes, size)  # those across two texts fall to the exact check
            at = np.searchsorted(keys, own)
            at[at == len(keys)] = 0
            hits = np.flatnonzero(keys[at] == own)
            for place, h in zip((np.searchsorted(words.at, hits, side="right") - 1).tolist(), own[hits].tolist()):
                found[place].update(self.sketch[size][h])
        for place in sorted(found):
            held, own_words = {}, words_of(column[place].as_py())
            for k in sorted(found[place]):
                item_id, size, wanted = self.items[k]
                if size not in held:
                    held[size] = set(grams(own_words, size)) if len(own_words) >= size else set()
                common = len(wanted & held[size])
                if common >= self.threshold * len(wanted) - 1e-9:
                    yield place, item_id, len(wanted), common


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str | None]]]:
    """The items as lists of bounded size, one at a time."""
    held, chars = [], 0
    for row in items.select(id_col, text_col).toLocalIterator():
        size = len(row[1] or "")
        if held and (len(held) >= BLOCK_ITEMS or chars + size > BLOCK_CHARS):
            yield held
            held, chars = [], 0
        held.append((row[0], row[1]))
        chars += size
    yield held


def find(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common) for each document row and item row where the
    document holds at least ``threshold`` of the item's shingles."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    doc_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (items, item_col)))
    out = None
    for block in blocks(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index(block, width, threshold))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows_, item_ids, sizes, common = [], [], [], []
                for place, item_id, n, c in index.matches(batch.column(1)):
                    rows_.append(place)
                    item_ids.append(item_id)
                    sizes.append(n)
                    common.append(c)
                if rows_:
                    yield pa.RecordBatch.from_arrays(
                        [pc.take(batch.column(0), pa.array(rows_)), pa.array(item_ids, items_arrow),
                         pa.array(sizes, pa.int64()), pa.array(common, pa.int64())],
                        ["doc_id", "item_id", "n_shingles", "n_common"])

        items_arrow = pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string()
        found = rows.mapInArrow(scan, f"doc_id {doc_type}, item_id {item_type}, n_shingles bigint, n_common bigint")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD,
          text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item: decided row by row in the
    scan, so no join and no shuffle of the texts."""
    spark = docs.sparkSession
    small_batches(spark)
    for block in blocks(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index(block, width, threshold))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                keep_ = np.ones(batch.num_rows, bool)
                keep_[[place for place, *_ in index.matches(batch.column(text_col))]] = False
                yield batch.filter(pa.array(keep_))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
