"""Event sources: JSON decode, derivations, stream readers, CSV.

The reference subscribes to three Kafka topics.  The source here is a parameter:
``kafka`` (needs the connector on the cluster) or a folder of JSON-lines files
(the test source).  Either way each record's ``value`` is decoded with a fixed
schema in PERMISSIVE mode: a malformed line becomes a row of nulls with the raw
text kept in ``_corrupt_record`` (the reference stores the nulls silently).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S
from ..functions.columns import action_score, review_clean, rule_recommendation
from . import topic

CORRUPT = "_corrupt_record"


def with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def to_json_lines(df: DataFrame, schema: StructType) -> DataFrame:
    """One ``value`` string per row: the row's schema fields as a JSON object."""
    return df.select(F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("value"))


def decode(df: DataFrame, schema: StructType, keep_corrupt: bool = True,
           value_col: str = "value") -> DataFrame:
    """bytes/string ``value`` → typed columns (PERMISSIVE, corrupt text kept)."""
    sch = with_corrupt(schema) if keep_corrupt else schema
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(F.from_json(F.col(value_col).cast("string"), sch, opts).alias("data"))
    return parsed.select("data.*")


def derive_clicks(df: DataFrame, variant: str | None = "A") -> DataFrame:
    """review_clean, action_score and (optionally) the rule recommendation."""
    out = (df.withColumn("review_clean", review_clean("review_text"))
           .withColumn("action_score", action_score("action")))
    if variant:
        out = out.withColumn(S.RECO_COLUMN[variant], rule_recommendation("action", variant))
    return out


def read_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Streaming DataFrame with a ``value`` column.

    ``source`` is ``{"format": "kafka", "servers": ..., "topic": ...}``,
    ``{"format": "topic", "path": ..., "startingOffsets": ..., "group": ...}`` (a landing
    folder with a broker's offsets, ``sources/topic.py``) or
    ``{"format": "files", "path": ..., "maxFilesPerTrigger": n}`` (JSON lines, from the first).
    """
    fmt = source.get("format", "files")
    if fmt == "kafka":
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", source["servers"])
                .option("subscribe", source["topic"])
                .option("startingOffsets", source.get("startingOffsets", "latest"))
                .option("failOnDataLoss", "false")
                .load())
    if fmt == "topic":
        topic.register(spark)
        return (spark.readStream.format(topic.NAME).option("path", source["path"])
                .option("startingOffsets", source.get("startingOffsets", "latest"))
                .option("group", source.get("group", "default")).load())
    if fmt != "files":
        raise ValueError(f"unknown stream source {fmt!r}")
    if source.get("startingOffsets", "earliest") != "earliest":
        raise ValueError("a plain file source starts at the first file; use the topic format for other offsets")
    reader = spark.readStream.schema("value string")
    if source.get("maxFilesPerTrigger"):
        reader = reader.option("maxFilesPerTrigger", int(source["maxFilesPerTrigger"]))
    return reader.text(source["path"])


# Header line, quotes escaped by doubling, whitespace kept as is on both sides.
_CSV_OPTS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False}


#: Line breaks and the escape sign itself, as ``write_csv`` stores them in text fields.
_CSV_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
             escaped: bool = True) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass over the data).

    A file is split over tasks.  ``multi_line`` reads files whose quoted fields hold line
    breaks, which only one task per file can do; ``escaped`` (files of ``write_csv``) turns
    the stored escapes of text fields back."""
    df = spark.read.options(**_CSV_OPTS).option("multiLine", multi_line).schema(schema).csv(path)
    if multi_line or not escaped:
        return df
    texts = {f.name for f in schema.fields if isinstance(f.dataType, StringType)}
    back = F.regexp_replace  # pairs are undone from the left, so an escaped backslash stays one

    def plain(c):
        parts = F.split(c, r"\\\\", -1)
        return F.array_join(F.transform(parts, lambda p: back(back(p, r"\\n", "\n"), r"\\r", "\r")), "\\")

    return df.select(*[plain(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """K5: CSV export with a header line, quoted fields, no index column.  Line breaks in
    text fields are stored as escapes, so the files can be split when they are read.

    As with a pandas export, an empty string and a null are both an empty field and
    both read back as null.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    for c in texts:
        for sign, stored in _CSV_ESCAPES:
            df = df.withColumn(c, F.replace(F.col(c), F.lit(sign), F.lit(stored)))
    df.write.mode("overwrite").options(**_CSV_OPTS).csv(path)
