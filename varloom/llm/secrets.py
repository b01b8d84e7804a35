"""Secrets in texts, found through a trigram inverted index.

From each rule's pattern a Boolean trigram query is derived. One pass over the
texts writes the postings of the trigrams that the queries name. The index
keeps, for each block of documents, a sorted list of documents by trigram; a rule's query
intersects and unites the lists it names, and what is left are the rule's
candidates. Only those patterns run on a text. Rules without a mandatory
trigram scan every text. Everything is column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import free_names, text_or_empty
from varloom.llm.quality import let
from varloom.llm.trigrams import checked, trigram_query, trigrams_of
from varloom.staging import staged


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret; ``value`` is the group whose length must be ``least`` or more."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 0


# The base kinds in their order. Greedy runs of at least n
# characters are the greedy runs with n or more, so the length is in the pattern.
BASE_RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
RULES = BASE_RULES + (
    SecretRule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)

#: Postings of a block of the index, on average.
BLOCK_POSTINGS = 50_000

SPAN = "array<struct<start:int,kind:int,end:int>>"


def postings(docs: DataFrame, trigrams: set[str]) -> DataFrame:
    """(trigram, key) of every document in ``docs`` (key, text) that has the trigram, letters in either case."""
    lower = F.lower("text")
    has = let(lower, lambda body: F.filter(F.array(*map(F.lit, sorted(trigrams))), lambda t: F.contains(body, t)))
    return docs.select("key", F.explode(has).alias("trigram")).select("trigram", "key")


def posting_lists(index: DataFrame) -> DataFrame:
    """(block, lists): the postings (trigram, key) of a block of documents as a sorted list of keys by trigram."""
    blocks = max(1, -(-index.count() // BLOCK_POSTINGS))
    lists = index.groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))


def matching(query, lists: Column) -> Column:
    """Keys of the documents that satisfy a trigram query, from the lists of their block."""
    if isinstance(query, str):
        return F.coalesce(F.element_at(lists, F.lit(query)), F.array().cast("array<bigint>"))
    combine = F.array_intersect if query[0] == "and" else F.array_union
    return reduce(combine, [matching(part, lists) for part in query[1]])


def candidates(index: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """(key, rules): the rules whose trigram query the document's postings satisfy.

    A block holds ``BLOCK_POSTINGS`` postings on average, dealt by the hash of
    documents, so a trigram that most documents have is spread over all blocks.
    """
    queries = {rule.kind: trigram_query(checked(rule.pattern)) for rule in rules}
    found = F.array(*[F.struct(F.lit(kind).alias("kind"), matching(q, F.col("lists")).alias("keys")) for kind, q in queries.items() if q is not None])
    hits = posting_lists(index).select(F.explode(found).alias("f")).select("f.kind", F.explode("f.keys").alias("key"))
    return hits.groupBy("key").agg(F.collect_list("kind").alias("rules"))


def rule_spans(text: Column, rule: SecretRule, kind: int) -> Column:
    """Spans of the leftmost matches, in code points: match lengths and the lengths between them add up to places."""
    def placed(matches: Column, gaps: Column, values: Column) -> Column:
        ordered = F.zip_with(F.zip_with(matches, gaps, lambda m, g: F.struct(F.char_length(m).alias("m"), F.char_length(g).alias("g"))),
                             values, lambda mg, v: F.struct(mg.m.alias("m"), mg.g.alias("g"), F.char_length(v).alias("v")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

        def step(acc, x):
            begin = acc["at"] + x["g"]
            end = begin + x["m"]
            span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(x["v"] >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

        # There is one more gap than matches; the last one is not needed.
        return F.aggregate(F.filter(ordered, lambda x: x.m.isNotNull()), start, step, lambda acc: acc["spans"])

    pattern = F.lit(rule.pattern)
    found = placed(F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1),
                   F.regexp_extract_all(text, pattern, F.lit(rule.value)))
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(SPAN))


def with_spans(docs: DataFrame, text: str = "text", rules: tuple[SecretRule, ...] = RULES, into: str = "secret_spans") -> DataFrame:
    """``docs`` with ``into``: (start, index of the rule, end) by start, then rule; ``into`` must be a new name.

    Null and empty texts have none; repeated rows and equal texts are alike;
    texts of any length are scanned whole. Rows are told apart by a hash of the whole
    row key and text; equal hashes only make more candidates. One exchange of
    the texts brings them to their candidate rules.
    """
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {into!r} already")
    key, fits = free_names([*docs.columns, into], "secret_key", "secret_rules")
    queries = [trigram_query(checked(rule.pattern)) for rule in rules]
    body = text_or_empty(text)
    keyed = docs.withColumn(key, F.xxhash64(body, F.octet_length(body), *[F.col(f"`{c}`") for c, t in docs.dtypes if t in ("bigint", "int")]))
    index = staged(postings(keyed.select(F.col(key).alias("key"), body.alias("text")), set().union(*map(trigrams_of, queries))))
    wanted = candidates(index, rules).withColumnsRenamed({"key": key, "rules": fits})
    joined = keyed.join(wanted, key, "left")
    spans = []
    for k, (rule, query) in enumerate(zip(rules, queries)):
        own = rule_spans(body, rule, k)
        spans.append(own if query is None else F.when(F.array_contains(fits, rule.kind), own).otherwise(F.array().cast(SPAN)))
    return joined.withColumn(into, F.array_sort(F.concat(*spans))).select(*[f"`{c}`" for c in docs.columns], into)


def spans_text(spans: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")


def secret_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts of the base kinds, the digest of their spans, and all spans.

    Null and empty texts have counts of zero and no spans, repeated rows stay, null ids stay null, no rows give none.
    """
    found = with_spans(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))).select("doc_id", "secret_spans")

    def count(kind: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s.kind == kind)).cast("long")

    base = F.filter("secret_spans", lambda s: s.kind < len(BASE_RULES))
    return found.select("doc_id", *[count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(BASE_RULES)],
                        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("secret_spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret replaced by ``[kind]``; overlapping spans become one. Other columns stay.

    Texts without a secret, nulls included, stay as they are, whatever names the columns have.
    """
    names = reduce(lambda out, rule: [*out, F.lit(f"[{rule.kind}]")], rules, [])
    body = text_or_empty(text)
    spans, = free_names(docs.columns, "secret_spans")

    def step(acc, s):
        starts = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(acc["out"], starts, F.element_at(F.array(*names), s["kind"] + 1)).alias("out"), s["end"].alias("at")))

    found = with_spans(docs, text, rules, spans)
    clean = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                        lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.char_length(body))))
    return found.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(F.col(f"`{text}`"))).drop(spans)
