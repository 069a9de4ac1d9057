"""Line dedup: repeated runs of lines by distributed prefix doubling, in DataFrame operations.

The corpus is a sequence of line ids.  A run of lines qualifies when it has at least
``min_words`` words; a line goes when some qualifying run around it stands earlier in the
corpus (by document id, then line).  What goes are thus the later copies of the maximal
repeated runs; the earliest copy of everything stays.  A run that overlaps its own earliest
copy (equal or periodic lines) is no copy of it: of 20 equal lines of ten words five stay.

Suffix order.  Lines that occur once end every repeated run, so only repeated lines enter.
Rank 0 of a suffix is the place of its first line in the sorted list of repeated lines.
Rank k+1 is the place of (rank k, rank k of the suffix 2**k lines on) in the sorted list of
such pairs: equal ranks mean equal first 2**(k+1) lines, and ranks keep the suffixes' order.
Each round is a join, a grouped count and a range sort over distributed tables; a suffix
whose rank nobody shares leaves the rounds.  Rounds end when the longest run that must be
told apart is covered.

Intervals.  Suffixes that share a prefix of l lines are an interval of the suffix array
whose longest common prefix is at least l: the group of equal (l, rank of the first 2**k
lines, rank of the last 2**k lines), 2**k <= l < 2**(k+1).  It is enough to look at the
shortest qualifying runs from each line on and up to each line: any qualifying run is a
union of them, so their union over all lines gives the maximal runs.  The least position
of a group is found by partial aggregation, so a line in a third of all documents is no
hot key.

Edge cases: null and empty texts have no line to lose; an empty line has no words but can
lie inside a run; rows that repeat id and text are one document, not copies of each other;
null ids come last; a document may lose all its lines (its text is then empty).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialize
from .common import WORD, row_key

MIN_WORDS = 50
#: The table of lines that go is broadcast up to this size, else joined by shuffle.
BROADCAST_BYTES = 64 << 20


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, doc_id, pos, a, b, w): a line's place, 128-bit id and number of words."""
    rows = docs.where(F.col(text_col).isNotNull()).select(
        *row_key(id_col, text_col), F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))
    return rows.select("k1", "k2", "doc_id", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
                       F.regexp_count("line", F.lit(WORD)).alias("w"))


def _ranked(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct ``keys`` with ``rank``: ascending in the order of ``by`` over all partitions."""
    return materialize(keys.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("rank", F.monotonically_increasing_id()), name)


def _runs(survivors: DataFrame, min_words: int) -> DataFrame:
    """(k1, k2, doc_id, start, len): the shortest qualifying runs from and up to each line."""
    island = Window.partitionBy("k1", "k2", "island").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lists = (survivors.withColumn("cw", F.sum("w").over(island))
             .groupBy("k1", "k2", "island").agg(F.first("doc_id").alias("doc_id"), F.sum("w").alias("words"),
                                                F.sort_array(F.collect_list(F.struct("pos", "cw", "w"))).alias("arr"))
             .where(F.col("words") >= min_words))
    rounds = "sequence(1, cast(ceil(log2(size(arr) + 1)) as int))"

    def search(test: str) -> str:
        mid = "shiftright(s.lo + s.hi, 1)"
        return (f"aggregate({rounds}, named_struct('lo', 0, 'hi', size(arr)), (s, _) -> if(s.lo >= s.hi, s, if({test.replace('@', mid)}, "
                f"named_struct('lo', {mid} + 1, 'hi', s.hi), named_struct('lo', s.lo, 'hi', {mid}))), s -> s.lo)")

    # from each line on: the first line where the words reach min_words
    on = search(f"arr[@].cw < x.cw - x.w + {min_words}")
    # up to each line: the last line from where they still do
    up = search(f"arr[@].cw - arr[@].w <= x.cw - {min_words}")
    starts = F.expr(f"filter(transform(arr, (x, i) -> named_struct('start', x.pos, 'len', if({on} < size(arr), {on} - i + 1, 0))), r -> r.len > 0)")
    ends = F.expr(f"filter(transform(arr, (x, i) -> named_struct('start', arr[0].pos + {up} - 1, 'len', if({up} > 0, i - {up} + 2, 0))), r -> r.len > 0)")
    return (lists.select("k1", "k2", "doc_id", F.explode(F.array_distinct(F.concat(starts, ends))).alias("r"))
            .select("k1", "k2", "doc_id", F.col("r.start").alias("start"), F.col("r.len").alias("len")))


def find_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, gone): per document that loses lines, their sorted places."""
    lines = materialize(lines_of(docs, id_col, text_col), "lines")
    repeated = _ranked(lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b"), ["a", "b"], "line-ranks")
    place = Window.partitionBy("k1", "k2").orderBy("pos")
    survivors = (lines.join(repeated, ["a", "b"]).select("k1", "k2", "doc_id", "pos", "w", "rank")
                 .dropDuplicates(["k1", "k2", "pos"])
                 .withColumn("island", F.col("pos") - F.row_number().over(place)))
    survivors = materialize(survivors, "repeated-lines")
    runs = materialize(_runs(survivors, min_words), "runs")
    longest = runs.agg(F.max("len")).first()[0] or 1
    # only lines inside some run need ranks beyond the first
    now = materialize(survivors.select("k1", "k2", "pos", "rank"), "rank-0")
    ranks = now.withColumn("level", F.lit(0))
    level = 0
    while 2 ** (level + 1) <= longest and now._sillage_rows:
        ahead = now.select("k1", "k2", (F.col("pos") - 2**level).alias("pos"), F.col("rank").alias("second"))
        pairs = now.join(ahead, ["k1", "k2", "pos"])
        shared = _ranked(pairs.groupBy("rank", "second").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select(F.col("rank").alias("first"), "second"), ["first", "second"], f"pair-ranks-{level + 1}")
        named = pairs.withColumnRenamed("rank", "first").join(shared, ["first", "second"])
        now = materialize(named.select("k1", "k2", "pos", "rank"), f"rank-{level + 1}")
        level += 1
        ranks = ranks.unionByName(now.withColumn("level", F.lit(level)))
    k = F.floor(F.log2(F.col("len").cast("double")) + 1e-9).cast("int")
    runs = runs.withColumn("level", k)
    head = ranks.select("k1", "k2", F.col("pos").alias("start"), "level", F.col("rank").alias("head"))
    tail = ranks.select("k1", "k2", F.col("pos").alias("last"), "level", F.col("rank").alias("tail"))
    named = (runs.join(head, ["k1", "k2", "start", "level"])
             .withColumn("last", (F.col("start") + F.col("len") - F.pow(F.lit(2.0), F.col("level"))).cast("int"))
             .join(tail, ["k1", "k2", "last", "level"])
             .select("k1", "k2", "doc_id", "start", "len", "head", "tail"))
    named = materialize(named, "named-runs")
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "start")
    first = (named.groupBy("len", "head", "tail").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    # in the earliest copy's own document only what starts behind that copy is another one
    later = named.join(first, ["len", "head", "tail"]).where(
        ~((F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2")) & (F.col("start") < F.col("first.start") + F.col("len"))))
    spans = later.select("k1", "k2", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    # overlapping runs of a document: each line once
    return materialize(spans.select("k1", "k2", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"))
                       .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("gone")), "gone")


def remove_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``text_col`` rid of later copies, and ``n_lines`` and
    ``n_removed`` of each row beside it (as ``__n_lines`` and ``__n_removed``)."""
    gone = find_copies(docs, min_words, id_col, text_col)
    places = gone.agg(F.sum(F.size("gone"))).first()[0] or 0
    small = 64 * gone._sillage_rows + 4 * places <= BROADCAST_BYTES  # measured, not estimated
    gone = gone.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("gone").alias("__gone"))
    gone = F.broadcast(gone) if small else gone
    k1, k2 = row_key(id_col, text_col)
    rows = docs.join(gone, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left").drop("__k1", "__k2")
    rows = rows.withColumn("__lines", F.split(text_col, "\n", -1))
    # between two lines that go lies one slice of lines that stay
    kept = F.expr("array_join(flatten(transform(sequence(0, size(__gone)), j -> slice(__lines, "
                  "if(j = 0, 1, get(__gone, j - 1) + 2), "
                  "if(j = size(__gone), size(__lines), get(__gone, j)) - if(j = 0, 0, get(__gone, j - 1) + 1)))), '\\n')")
    return (rows.withColumn("__n_lines", F.when(F.col("__lines").isNull(), 0).otherwise(F.size("__lines")).cast("long"))
            .withColumn("__n_removed", F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long"))
            .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept))
            .drop("__lines", "__gone"))
