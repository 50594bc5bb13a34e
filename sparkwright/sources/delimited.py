"""Delimited-text sources.

Every reader hands Spark a path and a declared schema where one is known, so
the scan is split by file blocks, typed in the JVM and pruned by later
projections.  Bad numbers become null (PERMISSIVE / try_cast), never a failed
job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from sparkwright.operators.relational import select_cast


def positional_schema(names: list[str], types: dict[str, DataType] | None = None,
                      default: DataType | None = None) -> StructType:
    """Names by position; per-name types, else ``default`` (string)."""
    types = types or {}
    default = default or StringType()
    return StructType([StructField(n, types.get(n, default), True) for n in names])


def read_positional_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
                        partitions: int | None = None) -> DataFrame:
    """Headerless delimited text; columns named and typed by position."""
    df = (spark.read.schema(schema).option("header", False).option("sep", sep)
          .option("mode", "PERMISSIVE").csv(path))
    return df.repartition(partitions) if partitions else df


def read_header_csv(spark: SparkSession, path: str, infer: bool = True, sampling_ratio: float = 1.0,
                    sep: str = ",", widen: bool = True) -> DataFrame:
    """Header CSV with inferred types (one extra pass over the sample).
    ``widen`` maps inferred int/float to bigint/double, as a data-frame
    library's 64-bit inference would (Spark picks int when values fit)."""
    df = (spark.read.option("header", True).option("sep", sep)
          .option("inferSchema", infer).option("samplingRatio", sampling_ratio).csv(path))
    if not widen:
        return df
    wide = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    return df.select(*[F.col(f"`{c}`").cast(wide[t]).alias(c) if t in wide else F.col(f"`{c}`")
                       for c, t in df.dtypes])


def read_string_csv(spark: SparkSession, path: str, casts: dict[str, DataType | str] | None = None,
                    sep: str = ",") -> DataFrame:
    """S3: header CSV read as strings; only the listed columns are cast."""
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return select_cast(df, casts, keep_others=True).select(*df.columns) if casts else df


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Impose a declared schema on an existing DataFrame (distributed; no
    driver-side copy of the rows)."""
    return select_cast(df, schema)
