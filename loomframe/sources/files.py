"""Readers for the text, CSV, libsvm and encoded files the jobs start from."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header, every column a string; no pass for inference."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with inferred types: one more pass over the files, so for exploration."""
    return spark.read.option("header", header).option("inferSchema", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = False) -> DataFrame:
    """CSV or TSV with a declared schema."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """``label, features`` from libsvm text; naming the width saves the pass that finds it."""
    return spark.read.format("libsvm").option("numFeatures", str(features)).load(path)


def write_libsvm(df: DataFrame, path: str, label: str, features: str) -> None:
    df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")).write.format("libsvm").save(
        path
    )


def parse_ratings(lines: DataFrame, sep: str = "::", fields: int = 4, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``value`` lines to ``(user, item, rating[, ts])`` and the rejected lines.

    ``strict`` fails the job on the first malformed line instead.
    """
    pattern = "\\Q" + sep + "\\E"
    parts = F.split("value", pattern)
    kinds = [("user", "bigint"), ("item", "bigint"), ("rating", "float"), ("ts", "bigint")][:fields]
    parsed = lines.withColumn("_p", parts).select(
        "value",
        F.size("_p").alias("_n"),
        *[F.get("_p", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)],
    )
    whole = F.col("_n") == fields
    for name, _ in kinds:
        whole = whole & F.col(name).isNotNull()
    names = [name for name, _ in kinds]
    if strict:
        fail = F.raise_error(F.concat(F.lit("malformed rating line: "), F.col("value")))
        checked = parsed.withColumn("user", F.when(whole, F.col("user")).otherwise(fail.cast("bigint")))
        return checked.select(*names), parsed.filter(F.lit(False)).select("value")
    return parsed.filter(whole).select(*names), parsed.filter(~whole).select("value")


def parse_baskets(lines: DataFrame) -> DataFrame:
    """``value`` lines to item arrays, split on white space."""
    return lines.select(F.split("value", r"\s+").alias("items"))


def parse_labelled(lines: DataFrame, sep: str) -> tuple[DataFrame, DataFrame]:
    """``label<sep>text`` lines to ``(label, text, tokens)`` and the lines without a separator.

    The line is cut once, so the whole message stays, whatever separators it holds.
    """
    cut = F.split("value", "\\Q" + sep + "\\E", 2)
    parsed = lines.withColumn("_p", cut)
    good = parsed.filter(F.size("_p") == 2).select(
        F.trim(F.col("_p")[0]).alias("label"), F.trim(F.col("_p")[1]).alias("text")
    )
    bad = parsed.filter(F.size("_p") < 2).select("value")
    return good.withColumn("tokens", F.split("text", r"\s+")), bad


def unknown_labels(df: DataFrame, column: str, allowed: Sequence[str], sep: str = r"\s+") -> DataFrame:
    """Rows whose first token is none of the allowed labels."""
    return df.withColumn("label", F.split(column, sep, 2)[0]).filter(~F.col("label").isin(*allowed))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_number, value)`` with line numbers counted inside each file, from 1.

    Lines are numbered inside each file block; the counts of the earlier blocks are then added, so a large
    file is numbered by as many tasks as it has blocks.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_order"),
        "value",
    )
    inside = Window.partitionBy("file", "block").orderBy("_order")
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = lines.withColumn("_row", F.row_number().over(inside)).join(offsets, ["file", "block"])
    return numbered.select("file", (F.col("_row") + F.col("_before")).alias("line_number"), "value")


def read_encoded_lines(spark: SparkSession, path: str, charset: str = "gb2312") -> tuple[DataFrame, DataFrame]:
    """``(file, text)`` of the lines that a charset can decode and ``(file, raw)`` of the others.

    Files are cut at newline bytes by Spark's own reader, so a large file is read by as many tasks as it has blocks; a
    charset must not use that byte within a character, as UTF-16 does (ValueError). Lines are decoded by the batch.
    """
    if "\n".encode(charset) != b"\n" or len("\n\n".encode(charset)) != 2:
        raise ValueError(f"lines of {charset} do not end in a newline byte")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str | None] = []
            for raw in batch.column("raw").to_pylist():
                try:
                    texts.append(raw.decode(charset))
                except UnicodeDecodeError:
                    texts.append(None)
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], ["file", "raw", "text"])

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("raw"))
    decoded = lines.mapInArrow(run, "file string, raw binary, text string")
    return decoded.where("text IS NOT NULL").select("file", "text"), decoded.where("text IS NULL").select("file", "raw")


def write_encoded_lines(lines: DataFrame, path: str, column: str, charset: str = "gb2312") -> None:
    """A text column as lines in a charset; what it cannot hold raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if t is None else t.encode(charset) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(raw, pa.binary())], ["raw"])

    encoded = lines.select(F.col(column).alias("text")).mapInArrow(run, "raw binary")
    encoded.select(F.coalesce(F.col("raw").cast("string"), F.lit("")).alias("value")).write.text(path)
