"""Tables stored in buckets of the variant key, for merges that exchange nothing.

A score table that is merged again and again is worth storing once in the
shape that the merge needs: rows of one key in one bucket, sorted. Two tables
with the same buckets are joined bucket by bucket. A join on more columns than
the bucket key works too, given the session settings of this package.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions.keys import VARIANT_KEY


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str] = tuple(VARIANT_KEY), buckets: int = 200, path: str | None = None) -> DataFrame:
    """Save ``df`` as table ``name``, in the warehouse or below ``path``, in ``buckets`` of ``keys``, each one sorted file.

    The rows are exchanged once, here, so a bucket is not scattered over as many
    files as there are tasks. Buckets should hold a few hundred megabytes. An existing table
    is an error.
    """
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_spec(df: DataFrame) -> tuple[int, list[str]]:
    """Buckets and key columns of the one stored table that ``df`` reads; raises if there is none."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    for k in range(leaves.size()):
        relation = leaves.apply(k)
        if "LogicalRelation" in relation.getClass().getName():
            spec = relation.relation().bucketSpec()
            if spec.isDefined():
                names = spec.get().bucketColumnNames()
                return spec.get().numBuckets(), [names.apply(i) for i in range(names.size())]
    raise ValueError("not a bucketed table")


def merge_bucketed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join of two tables in the same buckets, the left one possibly merged before; neither side is exchanged.

    A heavy key fills its bucket: for tables with one use ``balanced_join``, which splits it.
    """
    mine, theirs = bucket_spec(left), bucket_spec(right)
    if mine != theirs or not {c.lower() for c in mine[1]} <= {c.lower() for c in on}:
        raise ValueError(f"buckets differ or are not of the join key: {mine}, {theirs}, joined on {list(on)}")
    clashes = sorted((set(right.columns) - set(on)) & set(left.columns))
    if clashes:
        raise ValueError(f"columns already present: {clashes}")
    joined = left.join(right.hint("merge"), list(on), how)
    return joined.select(*[f"`{c}`" for c in [*left.columns, *[c for c in right.columns if c not in on]]])
