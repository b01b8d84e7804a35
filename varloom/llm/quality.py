"""Quality rules as a short-circuit cascade of column expressions.

Each rule is a Boolean column over the text: true rejects the document. A
bounded sample tells each rule's cost and the share it rejects; rules that
reject most for their cost come first, and later ones are only evaluated for
documents that passed. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import text_or_empty

SPACE = " \t\n\x0b\f\r"

#: Rule costs and selectivities are measured on at most so many rows, of texts up to so many bytes.
SAMPLE_ROWS = 512
SAMPLE_TEXT_BYTES = 1 << 16

MIN_WORDS = 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return (F.size(F.split(text, r"[#*$%&|<>]", -1)) - 1).cast("long")


def lines_with_word(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^ \t-\r]"))


def duplicate_lines(text: Column) -> Column:
    return let(lines_with_word(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by 64-bit hashes within one text. Most texts have no
    repeated window and stop at the distinct count; for the others the windows
    are sorted with their places, so cost grows as n log n.
    """
    windows = let(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2))))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))).cast("long")


def _covered(hashes: Column) -> Column:
    def places(ordered: Column) -> Column:
        # The sorted windows beside their predecessors: equal neighbours repeat.
        same = F.zip_with(ordered, F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(ordered, 1, F.size(ordered) - 1)),
                          lambda own, before: F.when(own.h == before.h, F.array(own.i, before.i)))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda pair: pair.isNotNull()))))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))
    return let(let(ordered, places), lambda p: F.aggregate(
        F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))), F.lit(0), lambda total, n: total + n))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column], Column]


def _mostly_capitals(text: Column) -> Column:
    return 2 * F.char_length(F.regexp_replace(text, "[^A-Z]", "")) > F.char_length(F.regexp_replace(text, r"[ \t-\r]+", ""))


#: Rules of the base contract, then the others; thresholds are far from clean prose.
BASE_RULES = (
    Rule("few_words", lambda text: F.size(words_of(text)) < MIN_WORDS),
    Rule("repeated_windows", lambda text: let(words_of(text), lambda w: 100 * repeated_words(w) > 50 * F.size(w))),
)
MORE_RULES = (
    Rule("symbols", lambda text: 10 * symbol_count(text) > F.size(words_of(text))),
    Rule("duplicate_lines", lambda text: let(lines_with_word(text), lambda lines: 2 * F.size(F.array_distinct(lines)) < F.size(lines))),
    Rule("capitals", _mostly_capitals),
)
RULES = BASE_RULES + MORE_RULES


def rule_order(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejected share per second, measured on at most ``sample_rows`` documents.

    The first rows are taken, which reads no more of the input than they need;
    each rule then runs alone over them. Only the order of evaluation depends
    on the sample and the clock.
    """
    some = docs.select(text_or_empty(text).alias("text")).where(F.octet_length("text") <= SAMPLE_TEXT_BYTES).take(sample_rows)
    sample = docs.sparkSession.createDataFrame(some, "text string").coalesce(1)
    sample.agg(F.sum(F.octet_length("text"))).first()
    scores = []
    for place, rule in enumerate(rules):
        started = time.perf_counter()
        share = sample.agg(F.avg(F.coalesce(rule.rejects(F.col("text")), F.lit(False)).cast("double"))).first()[0] or 0.0
        cost = time.perf_counter() - started
        scores.append((-(share + 1e-6) / cost, place, rule))
    return [rule for _, _, rule in sorted(scores, key=lambda s: s[:2])]


def cascade(text: Column, ordered: list[Rule]) -> Column:
    """True if no rule rejects the text; rules after the first rejection are not evaluated."""
    verdict = F.lit(True)
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects(text), F.lit(False)).otherwise(verdict)
    return verdict


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns.

    A null or empty text has no words and is rejected; repeated rows stay
    repeated; every text is judged whole and by itself, so nothing is shuffled.
    """
    return docs.where(cascade(text_or_empty(text), rule_order(docs, rules, text)))


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the base counters, whether they fail it, and the cascade's verdict.

    Null and empty texts count nothing and fail; repeated rows stay, null ids stay null, no rows give none.
    """
    ordered = rule_order(docs, MORE_RULES, text)
    body = text_or_empty(text)

    def counted(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"), symbol_count(body).alias("n_symbols"),
                        duplicate_lines(body).alias("n_dup_lines"), repeated_words(w).alias("n_repeat_words"))

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), let(words_of(body), counted).alias("base"))
    n_words, repeats = F.col("base.n_words"), F.col("base.n_repeat_words")
    failed = (n_words < MIN_WORDS) | (100 * repeats > 50 * n_words)
    return rows.select("doc_id", "base.*", failed.alias("base_failed"),
                       F.when(failed, F.lit(False)).otherwise(cascade(F.col("text"), ordered)).alias("kept"))


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
          SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
f AS (SELECT w.doc_id, text, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals
      FROM w LEFT JOIN rep USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * (n_lines - n_dup_lines) < n_lines OR 2 * capitals > word_chars) AS kept
FROM v
"""
