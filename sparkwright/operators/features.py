"""Feature preparation (H1-H5, F10): label converters as ML Transformers,
frequency string index, one-hot by name, standardisation, stable row ids.

Fitted state (categories, means) is fitted on one table and applied to
another, so train and test get the same columns.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.exprs import safe_div
from sparkwright.operators.ordering import row_number_exact
from sparkwright.operators.relational import map_lookup

# ------------------------------------------------------- H1: label stages


class BinaryLabel(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Collapse every label except ``keep`` (matched as a prefix) into ``other``."""

    keep = Param(Params._dummy(), "keep", "label kept as is", TypeConverters.toString)
    other = Param(Params._dummy(), "other", "label for everything else", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="labels", outputCol="labels2", keep="normal", other="attack"):
        super().__init__()
        self._setDefault(keep="normal", other="attack")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = F.col(self.getInputCol())
        keep, other = self.getOrDefault(self.keep), self.getOrDefault(self.other)
        return df.withColumn(self.getOutputCol(),
                             F.when(c.startswith(keep), c).when(c.isNotNull(), F.lit(other)))


class GroupLabel(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Map a raw label to its group by a dictionary (literal map, no UDF).
    ``unknown``: 'null' | 'error' | 'default' (uses ``default``)."""

    mapping = Param(Params._dummy(), "mapping", "raw label -> group", TypeConverters.identity)
    unknown = Param(Params._dummy(), "unknown", "policy for unknown labels", TypeConverters.toString)
    default = Param(Params._dummy(), "default", "group for unknown labels", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="labels", outputCol="labels5", mapping=None, unknown="error", default=None):
        super().__init__()
        self._setDefault(mapping={}, unknown="error", default=None)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return map_lookup(df, self.getInputCol(), self.getOrDefault(self.mapping), self.getOutputCol(),
                          unknown=self.getOrDefault(self.unknown), default=self.getOrDefault(self.default))


# --------------------------------------------------- H2: frequency index


def frequency_index(train: DataFrame, column: str) -> DataFrame:
    """Fitted index table (value, index): most frequent value gets 0.0,
    ties alphabetical (StringIndexer frequencyDesc).  Counts are combined
    map-side; the numbering is a distributed sort of the distinct values."""
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg((-F.count(F.lit(1))).alias("_less"))
    ranked = row_number_exact(counts, ["_less", column], out="_rn")
    return ranked.select(column, (F.col("_rn") - 1).cast("double").alias("index"))


def apply_index(df: DataFrame, index: DataFrame, column: str, out: str) -> DataFrame:
    """Attach the fitted index; unseen values -> null."""
    idx = index.select(F.col(column).alias("_v"), F.col("index").alias(out))
    return df.join(idx, F.col(column) == F.col("_v"), "left").drop("_v")


# ------------------------------------------------------------ H3: one-hot


#: Values of a column that may become columns of the wide form.
MOST_CATEGORIES = 10_000


def fit_categories(train: DataFrame, columns: list[str]) -> dict[str, list]:
    """Sorted distinct values per nominal column, for the wide form: each
    becomes a column.  More than ``MOST_CATEGORIES`` are an error; columns with
    more values go through ``stages.OneHotByFrequency``, which keeps them in a
    table and gives sparse vectors."""
    out = {}
    for c in columns:
        found = train.select(c).where(F.col(c).isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect()
        if len(found) > MOST_CATEGORIES:
            raise ValueError(f"{c} has more than {MOST_CATEGORIES} values; use stages.OneHotByFrequency")
        out[c] = sorted(r[0] for r in found)
    return out


def one_hot_vector(df: DataFrame, index: DataFrame, column: str, out: str) -> DataFrame:
    """One-hot as (size, slot): a sparse 0/1 row of any width.  ``slot`` is the
    fitted index of the value, null for unseen and null values; ``size`` is
    the number of fitted values."""
    size = F.lit(index.count()).alias("size")
    got = apply_index(df, index, column, "_slot")
    return got.withColumn(out, F.struct(size, F.col("_slot").cast("bigint").alias("slot"))).drop("_slot")


def one_hot(df: DataFrame, categories: dict[str, list], drop_input: bool = True) -> tuple[DataFrame, list[str]]:
    """0/1 double columns ``<col>_<value>`` in one projection; a value not seen
    in fit gives all zeros; a null gives all zeros."""
    new_cols, names = [], []
    for c, vals in categories.items():
        for v in vals:
            n = f"{c}_{v}"
            new_cols.append(F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0).alias(n))
            names.append(n)
    keep = [F.col(c) for c in df.columns if not (drop_input and c in categories)]
    return df.select(*keep, *new_cols), names


# ----------------------------------------------------- H4/H5: scaling


def fit_standardizer(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Mean and sample stddev per column from ONE aggregate; the single
    result row (2 numbers per column) is the fitted state."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__avg"), F.stddev_samp(c).alias(f"{c}__std")]
    return train.agg(*aggs).first().asDict()


def standardize(df: DataFrame, stats: dict[str, float], columns: list[str], with_mean: bool = True,
                zero_std: float | None = 0.0) -> DataFrame:
    """(x - mean) / std, or x / std without mean, with the fitted scalars as
    literals (no join).  A zero or null std gives null, replaced by
    ``zero_std`` when not None."""
    out = []
    for c in df.columns:
        if c in columns:
            mean, std = stats[f"{c}__avg"], stats[f"{c}__std"]
            num = F.col(c) - F.lit(mean) if with_mean else F.col(c)
            v = safe_div(num, F.lit(std).cast("double"))
            if zero_std is not None:
                v = F.coalesce(v, F.when(F.col(c).isNotNull(), F.lit(zero_std)))
            out.append(v.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ------------------------------------------------------ F10: stable ids


def stable_id(df: DataFrame, columns: list[str], key: list[str], out: str = "row_id") -> DataFrame:
    """Content hash id: the same row gets the same id under any partitioning.
    Returns the ``key`` columns, the hash and ``copy``, which numbers rows of
    one hash 1..k in key order, so (row_id, copy) is unique.  The hashed
    columns stay behind; a hash shared by a third of all rows still spreads
    over many tasks."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    x = df.select(*key, F.sha2(F.concat_ws("\u0001", *parts), 256).alias(out))
    return row_number_exact(x, key, part_cols=[out], out="copy")
