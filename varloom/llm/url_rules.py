"""URL rules by a sort-merge range join.

Hosts are written back to front, label by label (``www.example.net`` becomes
``net.example.www.``), so a host and its subdomains are one interval of keys: those that
start with its reversed form. URLs and rules are sorted together by key; one
sweep over each range keeps a stack of the rule hosts whose interval is open,
the inner ones on top. A range also gets the rules whose interval was opened
before its first key: those of the ancestors of that key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.staging import staged

# The rules of the contract, as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Verdict for URLs that no rule fits.
DEFAULT_VERDICT = "allow"


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://`` or URL."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a dot; a key with no host is empty."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


@dataclass
class Group:
    """The rules of one host: path, name and verdict, longest path first."""

    key: str
    by_length: dict[int, dict[str, tuple[str, str]]]

    def best(self, path: str) -> tuple[str, str] | None:
        for length in sorted(self.by_length, reverse=True):
            if length <= len(path):
                found = self.by_length[length].get(path[:length])
                if found:
                    return found
        return None


def sweep(rows) -> Iterator[tuple]:
    """(id, host, path, rule, verdict) for URL rows between rule rows, sorted by key with rules first.

    A row is (part, key, rule name or None, verdict, id, host, path). The longest rule
    wins, counted over host and path; of equal ones the one with the longer host.
    """
    stack: list[Group] = []
    now = None
    for part, key, rule, verdict, page, host, path in rows:
        if part != now:
            stack, now = [], part
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        if rule is not None:
            if not stack or stack[-1].key != key:
                stack.append(Group(key, {}))
            stack[-1].by_length.setdefault(len(path), {}).setdefault(path, (rule, verdict))
            continue
        best = None
        for group in stack:
            found = group.best(path)
            if found and (best is None or len(found[0]) >= len(best[0])):
                best = found
        yield (page, host, path, *(best or (None, None)))


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict.

    ``rules`` has verdict, host and path; of rules with the same host and path
    the smaller verdict counts. Null URLs have an empty host and path and fit
    no rule. Repeated rows stay, null ids stay null. A host with very many URLs
    is spread over ranges by path and id.
    """
    address = F.col(f"`{url}`")
    urls = pages.select(F.col(f"`{page_id}`").cast("long").alias("id"), url_host(address).alias("host"), url_path(address).alias("path"))
    urls = urls.select(host_key(F.col("host")).alias("key"), F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
                       "id", "host", "path", F.xxhash64("path", "id").alias("spread"), F.lit(False).alias("carried"))
    clean = rules.groupBy(lower_ascii(F.col("host")).alias("host"), "path").agg(F.min("verdict").alias("verdict"))
    named = clean.select(host_key(F.col("host")).alias("key"), F.concat("host", "path").alias("rule"), "verdict", F.lit(None).cast("long").alias("id"),
                         "host", "path", F.lit(-(1 << 63)).alias("spread"), F.lit(False).alias("carried"))
    ranged = staged(urls.unionByName(named).repartitionByRange("key", "spread").withColumn("part", F.spark_partition_id()))
    # The rules open at a range's first key: those of its ancestors, or of the key itself in an earlier range.
    firsts = ranged.groupBy("part").agg(F.min(F.struct("key", "spread")).alias("first"))
    labels = F.split(F.col("first.key"), r"\.", -1)
    ancestors = firsts.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda n: F.concat(
        F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("key")).distinct()
    carried = (ranged.where("rule IS NOT NULL").withColumnRenamed("part", "from").join(ancestors, "key").where("`from` < part")
               .drop("from").withColumn("carried", F.lit(True)))
    ordered = (ranged.unionByName(carried).repartition("part")
               .sortWithinPartitions("part", F.desc("carried"), "key", F.desc(F.col("rule").isNotNull()), "spread", "rule"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("part", "key", "rule", "verdict", "id", "host", "path")
        found = []
        for row in sweep(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns))):
            found.append(row)
            if len(found) == 10_000:
                yield _table(found)
                found = []
        yield _table(found)

    judged = ordered.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


URL_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
l AS (SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM h),
r AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
      AS t(verdict, rhost, rpath)),
m AS (SELECT l.*, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS n
      FROM l LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""
