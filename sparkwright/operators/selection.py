"""Exact selection without sorting: the k-th smallest value of every group.

Values become order-preserving integers, and an integer is read in digits of
``DIGIT`` bits.  A pass counts the rows of every wanted (group, leading digits)
by their next digit (a partial aggregate, so a hot group is counted map-side)
and descends into the digit that holds the wanted position.  64 bits take four
passes over narrow rows.  Nothing is sorted, sampled or windowed; a group is
never gathered, only its counters (at most 2^16 a pass and wanted place) are.
``quantiles`` gathers the keys of groups of at most ``GATHER`` rows, in one
exchange; only larger groups are counted by digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.exprs import join_groups
from sparkwright.session import materialize

DIGIT = 16
#: Rows of a group whose keys may be gathered in one list.
GATHER = 4096
_FRACTION = 52
_TOP = 2047 << _FRACTION


def order_bits(value: Column) -> Column:
    """A double as a bigint with the same order (its bits; -0 equals 0, NaN is
    the largest).  Null stays null."""
    v = value.cast("double")
    a = F.abs(v)
    # floor(log2) may be off by one next to a power of two.
    guess = F.floor(F.log2(a))
    part = a / F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(part >= 2, 1).when(part < 1, -1).otherwise(0)
    fraction = (a / F.pow(F.lit(2.0), exponent) - 1) * float(1 << _FRACTION)
    normal = F.shiftleft((exponent + 1023).cast("bigint"), _FRACTION) + fraction.cast("bigint")
    small = (a * 2.0 ** 537 * 2.0 ** 537).cast("bigint")
    bits = (F.when(F.isnan(v), F.lit(_TOP + 1)).when(a == float("inf"), F.lit(_TOP))
            .when(a >= 2.0 ** -1022, normal).otherwise(small))
    return F.when(v.isNull(), F.lit(None).cast("bigint")).when(v < 0, -bits).otherwise(bits)


def from_order_bits(bits: Column) -> Column:
    """The double of ``order_bits``."""
    a = F.abs(bits)
    exponent = F.shiftright(a, _FRACTION)
    fraction = a.bitwiseAND(F.lit((1 << _FRACTION) - 1)).cast("double")
    size = (F.when(a > _TOP, F.lit(float("nan"))).when(a == _TOP, F.lit(float("inf")))
            .when(exponent == 0, fraction * F.lit(2.0 ** -1074))
            .otherwise((fraction / float(1 << _FRACTION) + 1) * F.pow(F.lit(2.0), exponent - 1023)))
    return F.when(bits < 0, -size).otherwise(size)


def select_kth(rows: DataFrame, wanted: DataFrame, part_cols: list[str], key: str = "key", k: str = "k",
               bits: int = 64) -> DataFrame:
    """(*part_cols, k, key, rest): for every wanted (group, k) the k-th smallest
    ``key`` (bigint, from 1) of the group in ``rows``, and which of the rows
    equal to it the k-th one is.  Positions outside a group are left out; a
    null group is a group.  There is at least one group column.  ``rows`` is read once per pass, so it should be a
    stored table; ``bits`` below 64 (keys from 0) saves passes."""
    state = wanted.select(*part_cols, k).where(F.col(k) >= 1).distinct().withColumn("_rest", F.col(k).cast("bigint"))
    shared: list[str] = []
    for shift in range(bits - DIGIT, -1, -DIGIT):
        source = rows.select(*part_cols, F.shiftright(key, shift).alias("_next"),
                             *([F.shiftright(key, shift + DIGIT).alias("_lead")] if shared else []))
        if shared:
            source = join_groups(source, state.select(*part_cols, "_lead").distinct(), [*part_cols, "_lead"], "inner")
        cells = source.groupBy(*part_cols, *shared, "_next").agg(F.count(F.lit(1)).alias("_n"))
        counters = cells.groupBy(*part_cols, *shared).agg(F.array_sort(F.collect_list(F.struct("_next", "_n"))).alias("_cells"))
        state = join_groups(state, counters, [*part_cols, *shared], "inner")
        state = materialize(state.select(*part_cols, k, _descend().alias("_at"))
                            .where("_at.lead is not null")
                            .select(*part_cols, k, F.col("_at.lead").alias("_lead"), F.col("_at.rest").alias("_rest")))
        shared = ["_lead"]
    return state.select(*part_cols, k, F.col("_lead").alias(key), F.col("_rest").alias("rest"))


def _descend(kind: str = "bigint") -> Column:
    """Of counters (_next, _n) in order, the one that holds the wanted position,
    and the position inside it."""
    none = F.lit(None).cast(kind)
    start = F.struct(F.col("_rest").alias("rest"), none.alias("lead"))

    def step(at, cell):
        inside = at["lead"].isNull() & (at["rest"] <= cell["_n"])
        before = at["lead"].isNull()
        return F.struct(
            F.when(before & ~inside, at["rest"] - cell["_n"]).otherwise(at["rest"]).alias("rest"),
            F.when(inside, cell["_next"]).otherwise(at["lead"]).alias("lead"))

    return F.aggregate("_cells", start, step)


def place_among(rows: DataFrame, part_cols: list[str], column: str, rest: str = "rest") -> DataFrame:
    """(*part_cols, column): the ``rest``-th smallest value of ``column`` in each
    group, for groups with few different values; equal values are counted
    first.  ``rest`` is the same in all rows of a group."""
    kind = dict(rows.dtypes)[column]
    cells = rows.groupBy(*part_cols, rest, F.col(column).alias("_next")).agg(F.count(F.lit(1)).alias("_n"))
    lists = (cells.groupBy(*part_cols, F.col(rest).alias("_rest"))
             .agg(F.array_sort(F.collect_list(F.struct("_next", "_n"))).alias("_cells")))
    return lists.select(*part_cols, _descend(kind)["lead"].alias(column))


def _places(n: Column, prob: Column) -> tuple[Column, Column, Column]:
    """Positions (from 1) of the two rows around a quantile of ``n`` rows, and
    the part of the way between them."""
    height = (n - 1) * prob
    return F.floor(height) + 1, F.ceil(height) + 1, height - F.floor(height)


def _neighbours_gathered(rows: DataFrame, probs: list[float], groups: list[str]) -> DataFrame:
    """(*groups, prob, _a, _b, _part): the keys around every quantile, from the
    sorted list of a group's keys."""
    keys = F.col("_keys")
    cells = []
    for p in probs:
        low, high, part = _places(F.size(keys).cast("bigint"), F.lit(float(p)))
        cells.append(F.struct(F.lit(float(p)).alias("prob"), F.element_at(keys, low.cast("int")).alias("_a"),
                              F.element_at(keys, high.cast("int")).alias("_b"), part.alias("_part")))
    lists = rows.groupBy(*groups).agg(F.array_sort(F.collect_list("key")).alias("_keys"))
    return lists.select(*groups, F.explode(F.array(*cells)).alias("_c")).select(*groups, "_c.*")


def _neighbours_counted(rows: DataFrame, sizes: DataFrame, probs: list[float], groups: list[str]) -> DataFrame:
    """The same by ``select_kth``; ``sizes`` has the rows of every group."""
    low, high, part = _places(F.col("_n"), F.col("prob"))
    places = materialize(sizes.select(*groups, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
                         .select(*groups, "prob", part.alias("_part"), low.alias("_low"), high.alias("_high")))
    found = select_kth(rows, places.select(*groups, F.explode(F.array("_low", "_high")).alias("k")), groups)
    out = places
    for place, v in (("_low", "_a"), ("_high", "_b")):
        out = join_groups(out, found.select(*groups, F.col("k").alias(place), F.col("key").alias(v)), [*groups, place],
                          "inner")
    return out.select(*groups, "prob", "_a", "_b", "_part")


def quantiles(df: DataFrame, value: str, probs: list[float], part_cols=()) -> DataFrame:
    """(*part_cols, prob, quantile): exact quantiles with linear interpolation
    (numpy/pandas default, DuckDB quantile_cont) of the non-null values of each
    group; a null group is a group."""
    part_cols = list(part_cols)
    groups = part_cols or ["_g"]
    rows = df.where(F.col(value).isNotNull())
    rows = rows.select(*part_cols, *([] if part_cols else [F.lit(0).alias("_g")]), order_bits(F.col(value)).alias("key"))
    rows = materialize(rows)
    sizes = materialize(rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")))
    large = sizes.where(F.col("_n") > GATHER)
    n_small, n_large = sizes.agg(F.count_if(F.col("_n") <= GATHER), F.count_if(F.col("_n") > GATHER)).first()
    if n_small and n_large:
        # A large group has over GATHER rows, which bounds the list of them.
        names = F.broadcast(large.select(*groups))
        parts = [_neighbours_gathered(join_groups(rows, names, groups, "left_anti"), probs, groups),
                 _neighbours_counted(join_groups(rows, names, groups, "left_semi"), large, probs, groups)]
        out = parts[0].unionByName(parts[1])
    elif n_large:
        out = _neighbours_counted(rows, large, probs, groups)
    else:
        out = _neighbours_gathered(rows, probs, groups)
    out = out.withColumns({c: from_order_bits(F.col(c)) for c in ("_a", "_b")})
    exact = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")
    # Equal neighbours need no arithmetic (infinities).
    return out.select(*part_cols, "prob", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(exact).alias("quantile"))
