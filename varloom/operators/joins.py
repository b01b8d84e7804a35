"""Joins that stay balanced when one key holds a large share of the rows.

``lookup_join`` broadcasts its right side only after measuring it, and falls
back to ``balanced_join``. That one finds heavy keys by a sketching pass over
the key columns and splits just those keys over several tasks; the rows of
every other key take the plain shuffle join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.session import shuffle_partitions
from varloom.staging import short_lived_shuffles, staged

# A broadcast is copied to every executor, so its measured size must stay well
# below executor memory whatever the cluster.
MAX_BROADCAST_BYTES = 128 * 1024 * 1024

# A key with fewer rows never slows a task enough to be worth splitting.
MIN_HEAVY_ROWS = 10_000

_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows: lengths of text and binary cells, nested cells as JSON, 16 bytes for every cell besides."""
    width = F.lit(_FIXED_WIDTH * (len(df.columns) + 1)).cast("bigint")
    for name, dtype in df.dtypes:
        column = F.col(f"`{name}`")
        if dtype in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif dtype == "variant" or dtype.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def is_broadcastable(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def _in_order(joined: DataFrame, left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left columns as they were, then the right side's other columns."""
    added = [c for c in right.columns if c not in on]
    return joined.select(*[f"`{c}`" for c in [*left.columns, *added]])


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                max_bytes: int = MAX_BROADCAST_BYTES, counted: DataFrame | None = None) -> DataFrame:
    """Equi-join to a table expected to be small, whatever its real size.

    Join types and key types are checked first, so the size never decides
    what is accepted. ``counted`` is as in ``balanced_join``.
    """
    membership = how in ("left_semi", "left_anti")
    if not membership and how not in ("inner", "left"):
        raise ValueError(f"lookup_join supports inner, left, left_semi and left_anti, not {how!r}")
    _check_key_types(left, right, on)
    if is_broadcastable(right, max_bytes):
        joined = left.join(F.broadcast(right), list(on), how)
        return joined if membership else _in_order(joined, left, right, on)
    if membership:
        return balanced_membership(left, right, on, how)
    return balanced_join(left, right, on, how, counted=counted)


def membership_join(left: DataFrame, values: DataFrame, on: str,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``left`` whose ``on`` value occurs in ``values``."""
    return lookup_join(left, staged(values.select(on).distinct()), [on], "left_semi", max_bytes)


class HeavyKeys:
    """Hashes of heavy keys with the number of tasks each should be split over."""

    def __init__(self, splits: dict[int, int], null_splits: int = 1):
        self.splits = splits
        self.null_splits = null_splits

    def __bool__(self) -> bool:
        return bool(self.splits) or self.null_splits > 1

    def split_count(self, key_hash: Column) -> Column:
        """Tasks for a row's key; counts are powers of two, one IN set for each."""
        result = F.lit(1)
        for count in sorted(set(self.splits.values())):
            members = [h for h, n in self.splits.items() if n == count]
            result = F.when(key_hash.isin(members), F.lit(count)).otherwise(result)
        return result


def _check_key_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    """Splitting compares key hashes, so equal keys must also have equal types."""
    for key in on:
        types = {df.schema[key].dataType.simpleString() for df in (left, right)}
        if len(types) > 1 or types & {"float", "double"}:
            raise TypeError(f"join key {key!r} must be text or a whole number of one type, found {sorted(types)}")


def _any_null(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def _frequent_hashes(df: DataFrame, on: Sequence[str], partitions: int) -> DataFrame:
    """``top``: hashes of frequent keys (null: any part is null) and their counts; surely those of half a partition's fair share and more.

    A sketch of m hashes errs by 3.5 / m of all rows at most, and leaves out what has less than twice that.
    """
    tracked = min(1_000_000, max(1024, 16 * partitions))
    hashes = df.select(F.when(~_any_null(on), F.xxhash64(*on)).alias("h"))
    return hashes.agg(F.expr(f"approx_top_k(h, {min(partitions, tracked)}, {tracked})").alias("top"))


def heavy_keys(df: DataFrame, on: Sequence[str]) -> HeavyKeys:
    """Keys holding at least twice the fair share of one shuffle partition.

    The row count sets the limit; then one pass over the key columns looks for
    frequent hashes in a sketch for each task, so no row is shuffled. At most
    as many keys as partitions come back to the driver. Their counts may be too
    high by a ninth of the limit; they only decide where rows go. Tables below
    the limit need no pass.
    """
    partitions = shuffle_partitions(df.sparkSession)
    with short_lived_shuffles(df.sparkSession):
        # Reads no column, and of a stored table only the footers.
        total = df.count()
        limit = max(MIN_HEAVY_ROWS, 2 * total / partitions)
        if total < limit:
            return HeavyKeys({})
        counted = [r for r in _frequent_hashes(df, on, partitions).first().top if r["count"] >= limit]

    def pieces(rows: int) -> int:
        # Half a partition's fair share for each piece, rounded up to a power of two.
        return 1 << (math.ceil(2 * partitions * rows / total) - 1).bit_length()

    splits = {r["item"]: pieces(r["count"]) for r in counted}
    null_splits = splits.pop(None, 1)
    return HeavyKeys(splits, null_splits)


def _share(df: DataFrame, count: Column) -> Column:
    """Spread rows of one key over ``count`` shares, the same again on a task retry.

    By content, and by map task so that exact copies part as well. Neither
    depends on the order in which a task meets its rows.
    """
    spot = F.xxhash64(*[f"`{c}`" for c in df.columns]) + F.spark_partition_id()
    return F.when(count > 1, F.pmod(spot, count)).otherwise(F.lit(0)).cast("int")


def balanced_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                  left_unique: bool = False, right_unique: bool = False, counted: DataFrame | None = None) -> DataFrame:
    """Inner or left equi-join that splits heavy keys of either side.

    Heavy left key: its rows are spread over ``a`` shares and the matching
    right rows repeated ``a`` times. Heavy right key: the same with the roles
    swapped, so each matching pair still meets exactly once. Left rows with a
    null key match nothing and are simply spread. A side known to hold each
    key once needs no search for heavy keys. That search reads ``left`` twice, so
    a left side that is costly to compute comes with ``counted``: a table with
    about the same keys. It only decides where rows go.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"balanced_join supports inner and left, not {how!r}")
    on = list(on)
    _check_key_types(left, right, on)
    left_heavy = HeavyKeys({}) if left_unique else heavy_keys(left if counted is None else counted, on)
    right_heavy = HeavyKeys({}) if right_unique else heavy_keys(right.dropna(subset=on), on)
    if not left_heavy and not right_heavy:
        return _in_order(left.join(right, on, how), left, right, on)

    key_hash = F.xxhash64(*on)
    left_split = F.when(_any_null(on), F.lit(left_heavy.null_splits)).otherwise(left_heavy.split_count(key_hash))
    spread = left.withColumn("_ls", _share(left, left_split))
    copies = right.withColumn("_ls", F.explode(F.sequence(F.lit(0), left_heavy.split_count(key_hash) - 1)))
    salted = [*on, "_ls"]

    if right_heavy:
        # Exact key values, at most one per heavy hash, so the set is tiny.
        known = right.where(key_hash.isin(list(right_heavy.splits))).select(*on).distinct()
        right_split = right_heavy.split_count(key_hash)
        copies = copies.withColumn("_rs", _share(right, right_split))
        spread = (
            spread.join(F.broadcast(known.withColumn("_known", F.lit(True))), on, "left")
            .withColumn("_rs", F.explode(F.when(F.col("_known"), F.sequence(F.lit(0), right_split - 1))
                                         .otherwise(F.array(F.lit(0)))))
        )
        salted.append("_rs")
        joined = spread.join(copies.withColumn("_hit", F.lit(True)), salted, how)
        # A known key has a match in some share; its misses in others are not rows.
        joined = joined.where(F.col("_hit").isNotNull() | F.col("_known").isNull())
    else:
        joined = spread.join(copies, salted, how)
    return _in_order(joined, left, right, on)


def balanced_membership(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join that splits heavy left keys; the right side is made unique."""
    on = list(on)
    _check_key_types(left, right, on)
    if how == "left_semi":
        # Such rows match nothing. Spread as a heavy key they would also cost the result its
        # partitioning by key, and later steps by the same key another exchange.
        left = left.dropna(subset=on)
    heavy = heavy_keys(left, on)
    keys = right.select(*on).distinct()
    if not heavy:
        return left.join(keys, on, how)
    key_hash = F.xxhash64(*on)
    split = F.when(_any_null(on), F.lit(heavy.null_splits)).otherwise(heavy.split_count(key_hash))
    spread = left.withColumn("_ls", _share(left, split))
    copies = keys.withColumn("_ls", F.explode(F.sequence(F.lit(0), heavy.split_count(key_hash) - 1)))
    return spread.join(copies, [*on, "_ls"], how).drop("_ls")


def join_variants(left: DataFrame, right: DataFrame, how: str = "inner",
                  on: Sequence[str] = ("CHROM", "POS", "REF", "ALT")) -> DataFrame:
    """Join two tables on the variant key after checking that the key types agree."""
    types_left, types_right = dict(left.dtypes), dict(right.dtypes)
    lower_left = {c.lower(): t for c, t in types_left.items()}
    lower_right = {c.lower(): t for c, t in types_right.items()}
    differing = {k: (lower_left.get(k.lower()), lower_right.get(k.lower()))
                 for k in on if lower_left.get(k.lower()) != lower_right.get(k.lower())}
    if differing:
        raise TypeError(f"variant key types differ (left, right): {differing}")
    if how in ("left_semi", "left_anti"):
        return balanced_membership(left, right, on, how)
    if how in ("inner", "left"):
        return balanced_join(left, right, on, how)
    if how == "right":
        return _in_order(balanced_join(right, left, on, "left"), left, right, on)
    if how in ("outer", "full", "full_outer"):
        # Every left row with its matches, and the right rows without one.
        alone = balanced_membership(right, left, on, "left_anti")
        matched = balanced_join(left, right, on, "left")
        return matched.unionByName(alone, allowMissingColumns=True).select(*[f"`{c}`" for c in matched.columns])
    raise ValueError(f"join_variants does not support {how!r}")
