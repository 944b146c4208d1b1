"""Joins (J1-J11) and the Cartesian-product guard.

Every function is a lazy transformation: none runs a job or looks at sizes.
The physical strategy is Spark's: a side whose files are below the session's
broadcast threshold is broadcast, anything else is shuffled, and adaptive
execution re-plans from measured sizes.

Adaptive execution splits an oversized partition (a hot key) only where the
join brings a shuffle of its own to both sides, and only on a side that may be
split: both for INNER, the preserved one for LEFT, the left one for ANTI/SEMI.
Two things follow:

* a side that is already partitioned by the join key -- aggregated or
  de-duplicated by it -- would spare its shuffle and with it the splitting of
  the other side.  ``spread_keys`` adds a hash of the keys to the condition, so
  that both sides are shuffled for the join (that side holds a row for each
  key, the shuffle is small);
* where a hot key may sit on a side that can't be split -- either side of FULL
  OUTER, the optional side of LEFT/RIGHT over a raw table -- the plan itself
  looks for hot keys and deals their rows to several cells, in one native outer
  join (``full_outer_join``, ``left_outer_join``, ``right_outer_join``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relq.operators.filters import all_of


def _as_list(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _condition(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str]) -> Column:
    if not lkeys or len(lkeys) != len(rkeys):
        # A join without ON is a Cartesian product; refuse it.
        raise ValueError("join needs a non-empty, equal-length key list on both sides")
    return all_of(*[left[lk] == right[rk] for lk, rk in zip(lkeys, rkeys)])


_LEFT_HASH, _RIGHT_HASH = "__left_spread", "__right_spread"


def spread_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                right_keys: Sequence[str]) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a hash of their keys, and the condition on hash and keys.

    Spark shuffles a side for a join unless it is partitioned by all of the
    join's keys already; no earlier step partitions by the hash.
    """
    types = [dict(left.dtypes)[a] == dict(right.dtypes)[b] for a, b in zip(left_keys, right_keys)]
    alike = [F.col(f"`{k}`") if same else F.col(f"`{k}`").cast("string") for k, same in zip(left_keys, types)]
    other = [F.col(f"`{k}`") if same else F.col(f"`{k}`").cast("string") for k, same in zip(right_keys, types)]
    left = left.withColumn(_LEFT_HASH, F.xxhash64(*alike))
    right = right.withColumn(_RIGHT_HASH, F.xxhash64(*other))
    cond = all_of(left[_LEFT_HASH] == right[_RIGHT_HASH],
                  *[left[a] == right[b] for a, b in zip(left_keys, right_keys)])
    return left, right, cond


def aggregated_join(left: DataFrame, aggregated: DataFrame, left_keys: str | Sequence[str],
                    right_keys: str | Sequence[str] | None = None, how: str = "inner") -> DataFrame:
    """``left <how> JOIN aggregated`` with a right side of one row for each key
    (inner or left).  A hot key of ``left`` is split; see the module text.
    With equal key names and no ``right_keys`` there is one key column."""
    lkeys = _as_list(left_keys)
    using = right_keys is None
    rkeys = lkeys if using else _as_list(right_keys)
    if using:
        rkeys = [f"__right_{k}" for k in lkeys]
        aggregated = aggregated.withColumnsRenamed(dict(zip(lkeys, rkeys)))
    a, b, cond = spread_keys(left, aggregated, lkeys, rkeys)
    out = a.join(b, cond, how).drop(_LEFT_HASH, _RIGHT_HASH)
    return out.drop(*rkeys) if using else out


def key_probe(df: DataFrame, keys: Sequence[str], other: DataFrame, other_keys: Sequence[str], how: str) -> DataFrame:
    """``df`` semi- or anti-joined (``how``) with the distinct keys of ``other``.

    A key repeated in ``other`` is collapsed in each task before it is
    shuffled; a key repeated in ``df`` is split.
    """
    names = [f"__key_{i}" for i in range(len(other_keys))]
    probe = other.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(other_keys, names)]).distinct()
    a, b, cond = spread_keys(df, probe, keys, names)
    return a.join(b, cond, how).drop(_LEFT_HASH)


def equi_join(left: DataFrame, right: DataFrame, left_keys: str | Sequence[str],
              right_keys: str | Sequence[str] | None = None, how: str = "inner",
              right_filter: Column | None = None) -> DataFrame:
    """``left <how> JOIN right ON l.k1 = r.k1 [AND l.k2 = r.k2 ..] [AND <right_filter>]``.

    J1 inner, J3 left, J4 right, J7 composite keys.  ``right_filter`` is a
    constant predicate on the right side written inside ON (J2).  For INNER
    and LEFT joins that is the same as filtering ``right`` first, which is
    what happens here; for RIGHT/FULL joins an ON predicate on the preserved
    side only turns matches into non-matches, so it is refused.

    With equal key names on both sides and no ``right_keys``, the join is a
    USING join and the output has one key column.
    """
    lkeys = _as_list(left_keys)
    if right_filter is not None:
        if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti"):
            raise ValueError("an ON predicate on the preserved side is not a filter; use where()")
        right = right.filter(right_filter)
    if right_keys is None:
        if not lkeys:
            raise ValueError("join needs a non-empty key list")
        return left.join(right, on=lkeys, how=how)
    return left.join(right, _condition(left, right, lkeys, _as_list(right_keys)), how)


def dim_lookup(fact: DataFrame, dim: DataFrame, fact_key: str | Sequence[str],
               dim_key: str | Sequence[str], how: str = "inner",
               dim_filter: Column | None = None) -> DataFrame:
    """Fact-to-code-dimension join (J2, J10), ``ON f.code = d.id [AND d.group = 'g']``.

    The dimension is filtered first.  A code table is below Spark's broadcast
    threshold, so the fact side is not shuffled for it; one that has outgrown
    the threshold is joined by a shuffle.
    """
    if dim_filter is not None:
        dim = dim.filter(dim_filter)
    return equi_join(fact, dim, fact_key, dim_key, how)


# --- outer joins: hot keys found and dealt out inside the plan ------------------

TRACKED_KEYS = 10_000  # items that a task's summary of a join key holds
HOT_KEYS = 1_000       # of a side at most: the bound of what is broadcast
CELLS_PER_PARTITION = 4
_EXACT_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.BooleanType, T.DateType,
               T.TimestampType, T.TimestampNTZType, T.FloatType, T.DoubleType)


def _comparable(dt: T.DataType) -> bool:
    """Whether equal keys of this type have equal text (after ``_normal``)."""
    return isinstance(dt, _EXACT_KEYS) or dt == T.StringType()


def _normal(c: Column, dt: T.DataType) -> Column:
    """-0.0 equals 0.0 in a join, but not as text."""
    return c + F.lit(0.0).cast(dt) if isinstance(dt, (T.FloatType, T.DoubleType)) else c


def _sketch_key(df: DataFrame, keys: list[str], kinds: list[T.DataType]) -> Column:
    """One value that is equal for rows with equal keys, NULL if any key is."""
    own = [_normal(F.col(f"`{k}`").cast(dt), dt) for k, dt in zip(keys, kinds)]
    if len(own) == 1:
        return own[0]
    named = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(own)])
    return F.when(all_of(*[c.isNotNull() for c in own]), F.to_json(named))


def hot_keys(df: DataFrame, key: Column, partitions: int) -> DataFrame:
    """(key, cells): the keys of ``df`` that fill more than an average partition.

    A frequent-items summary: each task keeps at most ``TRACKED_KEYS`` keys and
    the summaries are merged, so one small row for each task is shuffled and
    at most ``HOT_KEYS`` rows come out.  A key's count may be overstated by
    rows / TRACKED_KEYS or so; every key reported does occur.
    """
    found = df.select(key.alias("__k")).agg(
        F.count("__k").alias("__rows"), F.expr(f"approx_top_k(__k, {HOT_KEYS}, {TRACKED_KEYS})").alias("__top"))
    items = found.select("__rows", F.explode("__top").alias("__t")).select(
        F.col("__t.item").alias("key"), F.try_divide(F.col("__t.count") * partitions, F.col("__rows")).alias("__share"))
    return items.filter(F.col("key").isNotNull() & (F.col("__share") >= 1)).select(
        "key", F.ceil(F.col("__share") * CELLS_PER_PARTITION).cast("int").alias("cells"))


_KEY, _CELL, _COPIES = "key", "cell", "copies"


def _dealt(df: DataFrame, side: str, key: Column, hot: DataFrame | None, spread: list[str]) -> DataFrame:
    """``df`` with the cell of each row (and of each copy) and its copies.

    Rows of a key that is hot on this side are dealt to its cells by a hash of
    their ``spread`` columns; where it is hot on the other side, a row goes to
    all of that side's cells.  A NULL key matches nothing and is dealt freely.
    """
    own_hash = F.xxhash64(*[F.col(f"`{c}`") for c in spread])
    name = {n: f"__{side}_{n}" for n in (_KEY, _CELL, _COPIES)}
    if hot is None:
        return df.withColumns({name[_CELL]: F.when(key.isNull(), own_hash).otherwise(F.lit(0).cast("long")),
                               name[_COPIES]: F.lit(1)})
    mine, theirs = ("left_cells", "right_cells") if side == "left" else ("right_cells", "left_cells")
    out = df.withColumn(name[_KEY], key)
    out = out.join(F.broadcast(hot), out[name[_KEY]] == hot["hot_key"], "left")  # HOT_KEYS rows of each side at most
    m, n = F.coalesce(F.col(mine), F.lit(1)), F.coalesce(F.col(theirs), F.lit(1))
    place = F.when(m > 1, F.pmod(own_hash, m)).otherwise(F.lit(0).cast("long"))
    out = out.withColumns({name[_COPIES]: n, "__place": F.when(F.col(name[_KEY]).isNull(), own_hash).otherwise(place),
                           "__of": m, "__copy": F.explode(F.sequence(F.lit(0), n - 1))})
    cell = F.col("__place") * F.col(name[_COPIES]) + F.col("__copy") if side == "left" else F.col("__copy") * F.col("__of") + F.col("__place")
    return out.withColumn(name[_CELL], cell).drop("__place", "__of", "__copy", "hot_key", "left_cells", "right_cells", name[_KEY])


def _outer(left: DataFrame, right: DataFrame, left_keys, right_keys, how: str, left_unique: bool, right_unique: bool,
           left_spread: Sequence[str] | None, right_spread: Sequence[str] | None) -> DataFrame:
    """LEFT or FULL join in the column layout of SQL, balanced at any skew."""
    lkeys = _as_list(left_keys)
    using = right_keys is None
    rkeys = lkeys if using else _as_list(right_keys)
    if not lkeys or len(lkeys) != len(rkeys):
        raise ValueError("join needs a non-empty, equal-length key list on both sides")
    shared = (set(left.columns) & set(right.columns)) - (set(lkeys) if using else set())
    if shared:
        raise ValueError(f"columns {sorted(shared)} exist on both sides; rename them before an outer join")
    left_spread, right_spread = list(left_spread or left.columns), list(right_spread or right.columns)
    names = left.columns + [c for c in right.columns if c not in left.columns]
    if using:
        renamed = {k: f"__right_{k}" for k in lkeys}
        right = right.withColumnsRenamed(renamed)
        rkeys, right_spread = [renamed[k] for k in lkeys], [renamed.get(c, c) for c in right_spread]
    if how == "left" and right_unique:
        a, b, cond = spread_keys(left, right, lkeys, rkeys)  # a hot key of the preserved side is split by Spark
        joined = a.join(b, cond, how)
    else:
        joined = _dealt_join(left, right, lkeys, rkeys, how, left_unique, right_unique, left_spread, right_spread)

    def shown(name: str) -> Column:
        if using and name in lkeys and how == "full":
            return F.coalesce(F.col(f"`{name}`"), F.col(f"`__right_{name}`")).alias(name)
        return F.col(f"`{name}`")

    if using:
        names = lkeys + [n for n in names if n not in lkeys]
    return joined.select(*[shown(n) for n in names])


def _dealt_join(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str], how: str, left_unique: bool,
                right_unique: bool, left_spread: list[str], right_spread: list[str]) -> DataFrame:
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = [f.dataType for f in left.select(*[F.col(f"`{k}`") for k in lkeys]).union(right.select(*[F.col(f"`{k}`") for k in rkeys])).schema]
    lkey, rkey = _sketch_key(left, lkeys, kinds), _sketch_key(right, rkeys, kinds)
    # LEFT: Spark itself splits a key that is hot on the left
    asked = [("left", left, lkey)] * (how == "full" and not left_unique) + [("right", right, rkey)] * (not right_unique)
    hot = None
    if asked and all(_comparable(dt) for dt in kinds):
        for side, df, key in asked:
            own = hot_keys(df, key, partitions)
            one = F.lit(None).cast("int")
            own = own.select(F.col("key").alias("hot_key"), *[(F.col("cells") if side == s else one).alias(f"{s}_cells") for s in ("left", "right")])
            hot = own if hot is None else hot.unionByName(own)
        if len(asked) > 1 or any(isinstance(dt, (T.FloatType, T.DoubleType)) for dt in kinds):
            hot = hot.groupBy("hot_key").agg(F.max("left_cells").alias("left_cells"), F.max("right_cells").alias("right_cells"))
    a = _dealt(left, "left", lkey, hot, left_spread)
    b = _dealt(right, "right", rkey, hot, right_spread)
    cond = all_of(a["__left_cell"] == b["__right_cell"],
                  *[a[x].cast(dt) == b[y].cast(dt) for x, y, dt in zip(lkeys, rkeys, kinds)])
    joined = a.join(b, cond, how)
    # a row has copies where its key is hot on the other side: it matches there,
    # and copies in cells without such a row say nothing
    idle = F.col("__right_cell").isNull() & (F.col("__left_copies") > 1)
    if how == "full":
        idle = idle | (F.col("__left_cell").isNull() & (F.col("__right_copies") > 1))
    return joined if hot is None else joined.filter(~F.coalesce(idle, F.lit(False)))


def full_outer_join(left: DataFrame, right: DataFrame, left_keys: str | Sequence[str],
                    right_keys: str | Sequence[str] | None = None, *, left_unique: bool = False, right_unique: bool = False,
                    left_spread: Sequence[str] | None = None, right_spread: Sequence[str] | None = None) -> DataFrame:
    """``left FULL OUTER JOIN right ON ..`` (J5), keeping duplicate rows.

    One native full outer join.  Spark can't split its partitions, so hot keys
    are found and dealt out by the plan itself, without a job before it:

    * each side's key column is summarised (``hot_keys``: one row for each task
      is shuffled), and the few keys that would fill more than a partition are
      broadcast with a number of cells by their share;
    * a row of a hot key goes to one of the key's cells, by a hash of its
      ``spread`` columns (a key of the table serves best; all columns if none
      are named, then identical rows of a hot key share a cell); rows of the
      other side with that key go to all of its cells.  All other rows, nearly
      all, are joined as they are.  The copies are fewer than the matches that
      they make, and copies in cells without a partner are dropped again: the
      key does occur on the other side.

    NULL keys never match and are dealt by the hash, as many as there may be.
    A side whose keys are declared unique needs no summary; a wrong declaration
    costs balance, not rows.  With equal key names and no ``right_keys`` the
    output has one key column, like ``JOIN .. USING``.  Keys of nested, binary
    or collated types are joined without dealing.
    """
    return _outer(left, right, left_keys, right_keys, "full", left_unique, right_unique, left_spread, right_spread)


def left_outer_join(left: DataFrame, right: DataFrame, left_keys: str | Sequence[str],
                    right_keys: str | Sequence[str] | None = None, *, right_unique: bool = False,
                    left_spread: Sequence[str] | None = None, right_spread: Sequence[str] | None = None) -> DataFrame:
    """``left LEFT JOIN right ON ..`` that stays balanced when the *optional*
    side holds a hot key.

    A plain LEFT join can split the preserved side only.  Where the optional
    side's key is declared unique that is enough; else its hot keys are dealt
    out as in ``full_outer_join``.  Columns that both sides share (but the key
    of a USING join) are refused at every size.
    """
    return _outer(left, right, left_keys, right_keys, "left", False, right_unique, left_spread, right_spread)


def right_outer_join(left: DataFrame, right: DataFrame, left_keys: str | Sequence[str],
                     right_keys: str | Sequence[str] | None = None, *, left_unique: bool = False,
                     left_spread: Sequence[str] | None = None, right_spread: Sequence[str] | None = None) -> DataFrame:
    """``left RIGHT JOIN right ON ..`` (J4), written as the swapped LEFT join.

    Same rows as a RIGHT join, with ``left``'s columns first; built on
    ``left_outer_join`` so a hot key on either side is split.
    """
    swapped = left_outer_join(right, left, right_keys if right_keys is not None else left_keys,
                              left_keys if right_keys is not None else None, right_unique=left_unique,
                              left_spread=right_spread, right_spread=left_spread)
    order = [c for c in left.columns] + [c for c in right.columns if c not in left.columns]
    return swapped.select(*order)


def full_outer_distinct(left: DataFrame, right: DataFrame, left_keys: str | Sequence[str],
                        right_keys: str | Sequence[str] | None, cols: Sequence[str | Column], **declared) -> DataFrame:
    """``(A LEFT JOIN B) UNION (B LEFT JOIN A)`` projected to ``cols``.

    UNION removes duplicate rows, so this equals the full outer join projected
    to ``cols`` and then de-duplicated (M15).  The dedup is a two-phase
    aggregate: rows repeated within a task collapse before the shuffle.
    ``declared``: what ``full_outer_join`` may know of its sides.
    """
    return full_outer_join(left, right, left_keys, right_keys, **declared).select(*cols).distinct()
