"""Table profile and integrity checks (S7-S10), each a distributed job.

The course states these facts in prose (row counts, value domains, NOT NULL,
primary key, documented foreign keys); here they are computed from the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relq.operators.filters import all_of
from relq.operators.joins import key_probe

_FLOATING = (T.FloatType, T.DoubleType)
_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """One row per column: type, rows, non-NULL, distinct, min and max.

    Two kinds of job, both fully distributed:

    * one global aggregate over a single scan gives row count, non-NULL
      count, min and max of every column (one partial row per task);
    * the distinct count of each column is its own single-distinct aggregate
      over that column alone (a columnar read of one column): values are
      de-duplicated map-side, shuffled by value, counted.  Keeping them apart
      avoids the expand-by-column-count and wide sort that several
      ``COUNT(DISTINCT)`` in one aggregate would force.
      ``exact_distinct=False`` uses HyperLogLog++ sketches in the first pass
      instead and shuffles nothing per value.

    Floating-point columns report ``min_num``/``max_num``; all others report
    ``min_text``/``max_text`` in full: whole numbers and decimals digit by
    digit, time as ``yyyy-MM-dd HH:mm:ss``.
    """
    cols = list(cols or df.columns)
    fields = {f.name: f.dataType for f in df.schema.fields}

    def shown(c, value):
        # time values are formatted once per group (min/max), not per row
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss") if isinstance(fields[c], _TIME) else value

    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        src = F.col(c)
        aggs += [F.count(src).alias(f"__nn{i}"), shown(c, F.min(src)).alias(f"__mn{i}"),
                 shown(c, F.max(src)).alias(f"__mx{i}")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(src).alias(f"__nd{i}"))
    one_row = df.agg(*aggs)

    entries = []
    for i, c in enumerate(cols):
        dt = fields[c]
        numeric = isinstance(dt, _FLOATING)
        mn, mx = F.col(f"__mn{i}"), F.col(f"__mx{i}")
        none_num, none_text = F.lit(None).cast(T.DoubleType()), F.lit(None).cast(T.StringType())
        fields_out = [
            F.lit(i).alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.lit(dt.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"),
            F.col(f"__nn{i}").alias("non_null"),
            (mn.cast(T.DoubleType()) if numeric else none_num).alias("min_num"),
            (mx.cast(T.DoubleType()) if numeric else none_num).alias("max_num"),
            (none_text if numeric else mn.cast(T.StringType())).alias("min_text"),
            (none_text if numeric else mx.cast(T.StringType())).alias("max_text"),
        ]
        if not exact_distinct:
            fields_out.append(F.col(f"__nd{i}").cast(T.LongType()).alias("distinct_values"))
        entries.append(F.struct(*fields_out))
    stats = one_row.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
    if not exact_distinct:
        return stats

    distinct = None
    for i, c in enumerate(cols):
        part = df.agg(F.lit(i).alias("ordinal"), F.count_distinct(F.col(c)).alias("distinct_values"))
        distinct = part if distinct is None else distinct.unionByName(part)
    # Both sides hold one row per profiled column.
    return stats.join(distinct, "ordinal").select(
        "ordinal", "column_name", "data_type", "row_count", "non_null", "distinct_values",
        "min_num", "max_num", "min_text", "max_text")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NOT NULL check (S8): one row per column with its NULL count and the row count.

    ``COUNT(*) - COUNT(c)`` for all columns in one pass, without a shuffle of
    values.  Over ``tables.read_footers`` Spark answers it from the Parquet
    footers and reads no column at all.
    """
    cols = list(cols or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(f"__n{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("column_name"), (F.col("__rows") - F.col(f"__n{i}")).alias("null_count"),
                        F.col("__rows").alias("row_count")) for i, c in enumerate(cols)]
    return counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def validate(df: DataFrame, name: str, not_null: Sequence[str], keys: Sequence[str],
             counted: DataFrame | None = None, compact: bool | None = None) -> DataFrame:
    """Check one table against its declaration: its NOT NULL columns (S8) and key.

    One row for each declared column with its NULL count, and one for the key
    (``a,b``) with the number of key values that more than one row holds.
    NULLs are counted in one pass without a shuffle (``counted``: the same
    table read by its footers, else ``df``); the key goes through
    ``duplicate_keys`` (``compact`` as there: tiles are not worth their passes
    on a code table).
    """
    source = df if counted is None else counted
    n = [f"__n{i}" for i in range(len(not_null))]
    nulls = source.agg(F.count(F.lit(1)).alias("__all"), F.lit(0).cast("long").alias("__twice"),
                       *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(x) for c, x in zip(not_null, n)])
    zero = F.lit(0).cast("long")
    twice = duplicate_keys(df, keys, "__rows", compact).agg(F.count(F.lit(1)).alias("__twice")).select(
        zero.alias("__all"), "__twice", *[zero.alias(x) for x in n])
    one = nulls.unionByName(twice).agg(*[F.max(c).alias(c) for c in ("__all", "__twice", *n)])

    def entry(rule: str, columns: str, count: str) -> Column:
        return F.struct(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), F.lit(columns).alias("columns"),
                        F.col(count).alias("violations"), F.col("__all").alias("row_count"))

    entries = [entry("not null", c, x) for c, x in zip(not_null, n)] + [entry("unique", ",".join(keys), "__twice")]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# --- repeated keys: tiles of 64 key values --------------------------------------

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TILE_BITS = 6            # 64 key values to a tile
BROADCAST_TILES = 100_000  # of two numbers each


def _tile_bits(keys: Sequence[str]) -> dict[str, int]:
    """How many low bits of each key column say the place within a tile: all
    six of a single column, else three of each of the last two."""
    if len(keys) == 1:
        return {keys[0]: TILE_BITS}
    return {k: TILE_BITS // 2 if k in keys[-2:] else 0 for k in keys}


def _counted(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(alias)).filter(F.col(alias) > 1)


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "n_rows", compact: bool | None = None) -> DataFrame:
    """Primary-key check (S9): every key value held by more than one row.

    NULL keys are grouped and reported like any other value.

    *Whole-number keys* (``compact``, the default for them) are summarised in
    tiles of 64 neighbouring values before anything is shuffled: each task
    keeps, for a tile, which values occur (OR of bits), which occur an odd
    number of times (XOR) and how many rows there are.  Keys that lie together
    in the files -- ids, as a rule -- make one small row for 64 keys instead of
    64 rows.  Merged, ``rows = |OR| + |OR and not XOR|`` holds exactly where no
    value occurs more than twice; then the values in OR but not in XOR are the
    repeated ones, twice each, and nothing more is read.  Only rows of the other
    tiles are shuffled by their key and counted, in a second pass over the key
    columns; up to ``BROADCAST_TILES`` such tiles are broadcast, and beyond that
    (a table most of whose keys occur three times or more) the plan counts all
    keys plainly.  Which of the two holds is decided within the plan.

    *Other keys*, and ``compact=False``, are counted by a two-phase aggregate;
    a key repeated by a third of the table is summed map-side.
    """
    keys = list(keys)
    kinds = [df.schema[k].dataType for k in keys]
    if compact is None:
        compact = all(isinstance(dt, _WHOLE) for dt in kinds)
    if not compact:
        return _counted(df, keys, alias)
    if not all(isinstance(dt, _WHOLE) for dt in kinds):
        raise ValueError("tiles need whole-number keys")
    slim = df.select(*[F.col(f"`{k}`") for k in keys])
    whole = all_of(*[F.col(f"`{k}`").isNotNull() for k in keys])
    some = slim.filter(whole)

    bits = _tile_bits(keys)
    tile = [f"__t{i}" for i in range(len(keys))]
    high = [F.shiftright(F.col(f"`{k}`").cast("long"), bits[k]).alias(t) for k, t in zip(keys, tile)]
    place, width = F.lit(0).cast("int"), 0
    for k in reversed(keys):
        low = F.col(f"`{k}`").cast("long").bitwiseAND(F.lit((1 << bits[k]) - 1).cast("long")).cast("int")
        place, width = place + F.shiftleft(low, width), width + bits[k]
    bit = F.expr("shiftleft(1L, __place)")
    tiles = some.select(*high, place.alias("__place")).groupBy(*tile).agg(
        F.bit_or(bit).alias("__or"), F.bit_xor(bit).alias("__xor"), F.count(F.lit(1)).alias("__rows"))
    even = F.col("__or").bitwiseAND(F.bitwise_not(F.col("__xor")))
    told = F.col("__rows") == F.bit_count("__or") + F.bit_count(even)

    spots = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", even, i) == 1)
    twice = tiles.filter(told & (even != 0)).select(*tile, F.explode(spots).alias("__place"))
    values, width = [], 0
    for k, t in zip(reversed(keys), reversed(tile)):
        low = F.shiftright(F.col("__place"), width).bitwiseAND(F.lit((1 << bits[k]) - 1))
        values.append((F.shiftleft(F.col(t), bits[k]) + low).cast(df.schema[k].dataType).alias(k))
        width += bits[k]
    twice = twice.select(*reversed(values), F.lit(2).cast("long").alias(alias))

    unclear = tiles.filter(~told)
    few = unclear.agg(F.count(F.lit(1)) <= BROADCAST_TILES).scalar()
    listed = F.broadcast(unclear.select(*[F.col(t).alias(f"__u{i}") for i, t in enumerate(tile)]).limit(BROADCAST_TILES))
    rows = some.filter(few).withColumns(dict(zip(tile, [h for h in high])))
    rows = rows.join(listed, all_of(*[rows[t] == listed[f"__u{i}"] for i, t in enumerate(tile)]), "left_semi").drop(*tile)
    # most tiles unclear: all keys counted
    rest = slim.filter(~whole | ~few)
    return twice.filter(few).unionByName(_counted(rows.unionByName(rest), keys, alias))


def orphans(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str],
            dim_keys: Sequence[str] | None = None, report_nulls: bool = False) -> DataFrame:
    """Reference check (S10): fact rows whose key has no row in ``dim``.

    A row with a NULL in its key refers to nothing and passes, as a foreign
    key constraint has it; ``report_nulls`` reports it as well.  An anti join
    against the distinct dimension keys: repeated keys are collapsed before
    they are shuffled, and a hot fact key is split.
    """
    missing = key_probe(fact, list(fact_keys), dim, list(dim_keys or fact_keys), "left_anti")
    if report_nulls:
        return missing
    return missing.filter(all_of(*[F.col(k).isNotNull() for k in fact_keys]))
