"""Value domains of code columns, and profiles kept per snapshot date.

The course lists, for each code column, the values that occur and what they
mean, and for each table its row count and date range.  Here both come from
mergeable sketches: every task summarises its rows, the summaries are merged,
and only summaries are shuffled.

* ``value_domain``: the values of many columns with their counts, in one pass.
  Domains of up to ``limit`` values are complete and their counts exact; larger
  ones are reported by their most frequent values with a stated error bound.
* ``snapshot_states`` / ``merged_profile``: the sketches of each snapshot date
  are stored, and a profile over any dates is the merge of their states.  A new
  date costs a pass over that date's rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACKED = 4_096   # values that a frequent-items sketch is asked to track
SLOTS = 8_192     # places that it has for this: the power of two above TRACKED / 0.75
LIMIT = 1_000     # values of a domain that is listed in full
TOP = 20          # values listed of a larger one
THETA_LG = 12     # a theta sketch counts up to 2^12 distinct values exactly
HLL_LG = 12
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_LG / 2)  # three standard errors, about 4.9 %
RANK_ERROR = 0.0133 * 3                   # of a quantile's rank, kll sketches with k = 200

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def _text(c: str, dt: T.DataType) -> Column:
    """A value as text: one form for each value, in time order for times."""
    col = F.col(f"`{c}`")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        col = col + F.lit(0.0).cast(dt)  # -0.0 and 0.0 are one value
    return col.cast("string")


def value_domain(df: DataFrame, cols: Sequence[str], limit: int = LIMIT, top: int = TOP) -> DataFrame:
    """One row per column and value: how many rows hold it.

    ``column_name, value, n_rows, domain_size, exact, max_error``; NULL is a
    value.  ``exact`` says that the column has at most ``limit`` values: all of
    them are listed, ``n_rows`` is exact and ``domain_size`` their number.
    Otherwise the ``top`` most frequent are listed, ``n_rows`` may be too high
    by ``max_error`` (3.5 / SLOTS of all rows), a value held by more rows than
    ``max_error`` is never missed unless more than ``top`` are so frequent, and
    ``domain_size`` is estimated (2 % standard error).

    One scan of the named columns; each task sends two small sketches for each
    column.  A frequent-items sketch with room for 0.75 x SLOTS values has lost
    nothing while a column has fewer, and a theta sketch tells exactly whether
    it has: it counts by 64-bit hashes and is exact up to 2^12 values.  Values
    are compared as text, so columns of long texts do not belong here.
    """
    if not 0 < limit < TRACKED:
        raise ValueError(f"limit must lie between 1 and {TRACKED - 1}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = df.select(*[_text(c, kinds[c]).alias(f"v{i}") for i, c in enumerate(cols)])
    sketches = [F.count(F.lit(1)).alias("rows")]
    for i, _ in enumerate(cols):
        sketches += [F.expr(f"approx_top_k(v{i}, {limit + 1}, {TRACKED})").alias(f"t{i}"),
                     F.expr(f"theta_sketch_estimate(theta_sketch_agg(v{i}, {THETA_LG}))").alias(f"d{i}"),
                     F.count(f"v{i}").alias(f"n{i}")]
    one = texts.agg(*sketches)

    def entry(i: int, c: str) -> Column:
        size = F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("long") + F.when(F.col(f"n{i}") < F.col("rows"), 1).otherwise(0)
        return F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"), size.alias("domain_size"), (size <= limit).alias("exact"),
                        F.when(size <= limit, 0).otherwise(F.ceil(F.col("rows") * 3.5 / SLOTS)).cast("long").alias("max_error"),
                        F.when(size <= limit, F.col(f"t{i}")).otherwise(F.slice(f"t{i}", 1, top)).alias("items"))

    per_column = one.select(F.explode(F.array(*[entry(i, c) for i, c in enumerate(cols)])).alias("e")).select("e.*")
    return per_column.select("column_name", F.explode("items").alias("item"), "domain_size", "exact", "max_error").select(
        "column_name", F.col("item.item").alias("value"), F.col("item.count").alias("n_rows"), "domain_size", "exact", "max_error")


def snapshot_states(df: DataFrame, date_col: str, cols: Sequence[str]) -> DataFrame:
    """One row per date and column: counts, least and greatest value, sketches.

    ``distinct_state`` (HyperLogLog), ``quantile_state`` (KLL, numbers only) and
    ``items_state`` (frequent items) can be stored and merged.  One pass over
    ``df``, grouped by the date: a task sends one state for each date and column
    that it has seen, so a hot date is no hot task.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    views, aggs = [], [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        number = isinstance(kinds[c], _NUMBER)
        views.append(_text(c, kinds[c]).alias(f"v{i}"))
        views.append((F.col(f"`{c}`").cast("double") if number else F.lit(None).cast("double")).alias(f"x{i}"))
        views.append((F.col(f"`{c}`").cast("long") if isinstance(kinds[c], _WHOLE) else F.lit(None).cast("long")).alias(f"w{i}"))
        aggs += [F.count(f"v{i}").alias(f"n{i}"), F.min(f"w{i}").alias(f"lw{i}"), F.max(f"w{i}").alias(f"hw{i}"),
                 F.min(f"x{i}").alias(f"lx{i}"), F.max(f"x{i}").alias(f"hx{i}"),
                 (F.lit(None).cast("string") if number else F.min(f"v{i}")).alias(f"lv{i}"),
                 (F.lit(None).cast("string") if number else F.max(f"v{i}")).alias(f"hv{i}"),
                 F.hll_sketch_agg(f"v{i}", HLL_LG).alias(f"h{i}"),
                 (F.kll_sketch_agg_double(f"x{i}") if number else F.lit(None).cast("binary")).alias(f"q{i}"),
                 F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED})").alias(f"t{i}")]
    states = df.select(F.col(f"`{date_col}`").alias("__date"), *views).groupBy("__date").agg(*aggs)

    def entry(i: int, c: str) -> Column:
        named = {"row_count": "rows", "non_null": f"n{i}", "min_whole": f"lw{i}", "max_whole": f"hw{i}", "min_num": f"lx{i}", "max_num": f"hx{i}",
                 "min_text": f"lv{i}", "max_text": f"hv{i}", "distinct_state": f"h{i}", "quantile_state": f"q{i}", "items_state": f"t{i}"}
        return F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c].simpleString()).alias("data_type"), *[F.col(s).alias(n) for n, s in named.items()])

    return states.select(F.col("__date").alias(date_col), F.explode(F.array(*[entry(i, c) for i, c in enumerate(cols)])).alias("e")).select(date_col, "e.*")


def merged_profile(states: DataFrame, top: int = TOP) -> DataFrame:
    """The profile of all dates of ``states`` (filter them first): one row per column.

    Counts, least and greatest values are exact.  ``distinct_values`` is within
    ``HLL_ERROR`` (three standard errors), ``quartiles`` (numbers only) are
    values whose rank is within ``RANK_ERROR``, and ``top_values`` lists the most
    frequent values with counts that may be too high by 3.5 / SLOTS of all rows.
    """
    merged = states.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("non_null").alias("non_null"),
        F.min("min_whole").alias("min_whole"), F.max("max_whole").alias("max_whole"), F.min("min_num").alias("min_num"), F.max("max_num").alias("max_num"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("distinct_values"),
        F.kll_merge_agg_double("quantile_state").alias("__q"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(items_state, {TRACKED}), {top})").alias("__top"))
    number = F.col("max_num").isNotNull()
    quartiles = F.when(number, F.array(*[F.kll_sketch_get_quantile_double(F.col("__q"), F.lit(q)) for q in (0.25, 0.5, 0.75)]))
    values = F.transform("__top", lambda t: F.struct(t["item"].alias("value"), t["count"].alias("n_rows")))
    return merged.select("column_name", "data_type", "row_count", "non_null", "distinct_values", "min_whole", "max_whole", "min_num", "max_num",
                         "min_text", "max_text", quartiles.alias("quartiles"), values.alias("top_values"))
