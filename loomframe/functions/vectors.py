"""Vector columns: between arrays, long rows and ``VectorUDT``, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

_VECTOR_ROW = T.StructType([T.StructField("v", VectorUDT())])


def array_vector(column: str | Column) -> Column:
    """Numeric array -> dense vector."""
    column = F.col(column) if isinstance(column, str) else column
    return array_to_vector(column.cast("array<double>"))


def dense_vector(columns: Sequence[str | Column]) -> Column:
    """Dense vector from scalar columns."""
    return array_to_vector(F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in columns]))


def vector_array(column: str | Column) -> Column:
    """Vector -> array<double> of full width."""
    return vector_to_array(column)


def spread(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per position."""
    rest = [c for c in df.columns if c != vector]
    staged = df.select(*rest, vector_to_array(vector).alias("_v"))
    return staged.select(*rest, *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])


def explode_vector(df: DataFrame, keep: Sequence[str], vector: str, dense: bool = True) -> DataFrame:
    """One row ``(*keep, pos, value)`` per position.

    With ``dense=False`` only the stored entries of a sparse vector come out, so a vector over a large
    vocabulary costs as many rows as it has entries.
    """
    if dense:
        return df.select(*keep, F.posexplode(vector_to_array(vector)).alias("pos", "value"))
    raw = df.select(*keep, F.unwrap_udt(F.col(vector)).alias("_u"))
    positions = F.coalesce(F.col("_u.indices"), F.sequence(F.lit(0), F.size("_u.values") - 1))
    entries = raw.filter(F.size("_u.values") > 0).select(
        *keep, F.explode(F.arrays_zip(positions.alias("pos"), F.col("_u.values").alias("value"))).alias("_e")
    )
    return entries.select(*keep, F.col("_e.pos").alias("pos"), F.col("_e.value").alias("value"))


def sparse_vectors(df: DataFrame, key: str, pos: str, value: str, size: int, out: str = "features") -> DataFrame:
    """Sparse vector per key from long rows; values at the same position are added.

    The first aggregation is partial on the map side, so a key's group never exceeds ``size`` entries.
    """
    cells = df.groupBy(key, pos).agg(F.sum(value).alias("_value"))
    rows = cells.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).cast("int").alias("p"), F.col("_value").alias("x")))).alias("_c")
    )
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.col("_c.p").alias("indices"),
        F.col("_c.x").alias("values"),
    )
    text = F.to_json(F.struct(parts.alias("v")))
    return rows.select(key, F.from_json(text, _VECTOR_ROW)["v"].alias(out))


def dot(left: str | Column, right: str | Column) -> Column:
    """Dot product of two numeric arrays."""
    left = F.col(left) if isinstance(left, str) else left
    right = F.col(right) if isinstance(right, str) else right
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(column: str | Column) -> Column:
    return F.sqrt(dot(column, column))


def euclidean(left: str | Column, right: str | Column) -> Column:
    """Distance between two numeric arrays."""
    left = F.col(left) if isinstance(left, str) else left
    right = F.col(right) if isinstance(right, str) else right
    gaps = F.zip_with(left, right, lambda a, b: F.pow(a.cast("double") - b.cast("double"), F.lit(2)))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x))


def argmax(column: str | Column) -> Column:
    """First position of the largest entry, as a double."""
    column = F.col(column) if isinstance(column, str) else column
    return (F.array_position(column, F.array_max(column)) - 1).cast("double")


def explode_matrix(df: DataFrame, matrix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Dense matrix column to long rows ``(*keep, i, j, value)``."""
    raw = df.select(*keep, F.unwrap_udt(F.col(matrix)).alias("_m"))
    cells = raw.select(*keep, "_m.numRows", "_m.numCols", "_m.isTransposed", F.posexplode("_m.values").alias("_k", "value"))
    by_row = F.col("isTransposed")
    i = F.when(by_row, F.floor(F.col("_k") / F.col("numCols"))).otherwise(F.col("_k") % F.col("numRows"))
    j = F.when(by_row, F.col("_k") % F.col("numCols")).otherwise(F.floor(F.col("_k") / F.col("numRows")))
    return cells.select(*keep, i.cast("int").alias("i"), j.cast("int").alias("j"), "value")
