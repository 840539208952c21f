"""Quality rules as a cascade: rules that reject much at little cost are asked first."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm.common import free_name, table, words

#: Rows that costs and selectivities are estimated on, in expectation.
SAMPLE_ROWS = 2_000

#: Times that each rule is asked of the sample; the fastest counts.
TIMINGS = 3


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition in which {text} and {words} stand for a text and its words; null counts as false."""

    name: str
    fails: str

    def condition(self, text: str, ws: str) -> Column:
        return F.coalesce(F.expr(self.fails.format(text=text, words=ws)), F.lit(False))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    selectivity: float

    @property
    def rank(self) -> float:
        """Rejections per cost."""
        return self.selectivity / max(self.cost, 1e-9)


#: Rules beside the base ones. They reject gross faults only, so that plain prose always passes.
RULES = (
    Rule("word_length", "char_length(array_join({words}, '')) NOT BETWEEN 2 * size({words}) AND 15 * size({words})"),
    Rule("symbols", "5 * (char_length({text}) - char_length(translate({text}, '#*$%&|<>', ''))) > size({words})"),
    Rule("distinct_words", "20 * size(array_distinct({words})) < least(size({words}), 2000)"),
    Rule("letters", "2 * size(filter({words}, w -> w rlike '[\\\\p{{L}}]')) < size({words})"),
)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``.

    A null text counts as an empty one, all of whose counts are 0. Columns of these names are
    replaced; rows are independent, so ties and repeated rows change nothing.
    """
    rows = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ws, body, lines, hashes, placed, bare, at = (free_name(rows, c) for c in ("ws", "body", "lines", "hashes", "placed", "bare", "at"))
    rows = rows.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumn(ws, words(F.col(body)))
    rows = rows.withColumn(lines, F.filter(F.split(F.col(body), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumns(
        {
            "n_words": F.size(ws).cast("long"),
            "word_chars": F.char_length(F.array_join(ws, "")).cast("long"),
            "n_symbols": (F.char_length(body) - F.char_length(F.translate(F.col(body), "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            hashes: F.when(F.size(ws) > 3, F.expr(f"transform(sequence(0, size({ws}) - 3), i -> xxhash64({ws}[i], {ws}[i + 1], {ws}[i + 2]))")),
        }
    ).drop(body, lines)
    # Different hashes prove that no window repeats. Else the windows themselves are sorted, each
    # with its place behind it, so that equal ones are neighbours.
    windows = f"transform(sequence(0, size({ws}) - 3), i -> concat_ws(' ', {ws}[i], {ws}[i + 1], {ws}[i + 2], lpad(string(i), 10, '0')))"
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    rows = rows.withColumn(placed, F.when(some, F.expr(f"sort_array({windows})"))).drop(hashes, ws)
    rows = rows.withColumn(bare, F.expr(f"transform({placed}, x -> substring_index(x, ' ', 3))"))
    repeated = f"filter({placed}, (x, i) -> get({bare}, i) = get({bare}, i - 1) OR get({bare}, i) = get({bare}, i + 1))"
    rows = rows.withColumn(at, F.expr(f"sort_array(transform({repeated}, x -> int(right(x, 10))))")).drop(placed, bare)
    # A repeated window adds its three words, less those that the next repeated one covers.
    added = f"transform({at}, (p, i) -> least(3, coalesce(get({at}, i + 1), p + 3) - p))"
    return rows.withColumn("n_repeat_words", F.expr(f"coalesce(aggregate({added}, 0L, (a, x) -> a + x), 0L)")).drop(at)


def seconds(sample: DataFrame, condition: Column) -> tuple[float, int]:
    """The least time that counting the rows of a condition takes, and their number; other work on the machine only adds to it."""
    least, found = float("inf"), 0
    for _ in range(TIMINGS):
        began = time.perf_counter()
        found = sample.where(condition).count()
        least = min(least, time.perf_counter() - began)
    return least, found


def estimated(rows: DataFrame, text: str, ws: str, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """Seconds and share of rejected rows of each rule over a sample of about ``sample_rows`` rows.

    A rule's cost is what it takes beyond a condition that costs next to nothing, so starting a job does not count; the difference
    is taken as a hundredth of that time at least, below which it can't be told from chance.
    """
    share = min(1.0, sample_rows / max(rows.count(), 1))
    sample = rows.select(text, ws).sample(share, seed=seed).persist()
    try:
        n = max(sample.count(), 1)
        nothing = F.size(ws) < 0
        seconds(sample, nothing)  # code is made and compiled once
        empty, _ = seconds(sample, nothing)
        out = []
        for rule in rules:
            took, failed = seconds(sample, rule.condition(text, ws))
            out.append(Estimate(rule, max(took - empty, empty / 100), failed / n))
        return out
    finally:
        sample.unpersist()


def first_failed(estimates: Sequence[Estimate], text: str, ws: str) -> Column:
    """The first rule that a row fails, asked in the order of rejections per cost; null if it passes all.

    Once a rule has failed, the conditions of later ones aren't computed for the row.
    """
    out = None
    for e in sorted(estimates, key=lambda e: (-e.rank, e.cost)):
        fails = e.rule.condition(text, ws)
        out = F.when(fails, e.rule.name) if out is None else out.when(fails, e.rule.name)
    return F.lit(None).cast("string") if out is None else out


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, unless: str = "false") -> DataFrame:
    """The rows with ``failed``, the rule of the cascade that rejects them, or null.

    Rows for which the SQL condition ``unless`` holds aren't asked. Which rules a row fails does not depend
    on the sample; with several, the one that is named may. An empty table gives an empty one.
    """
    rows = docs.drop("failed")
    ws, body = free_name(rows, "ws"), free_name(rows, "body")
    rows = rows.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumn(ws, words(F.col(body)))
    verdict = first_failed(estimated(rows, body, ws, rules, sample_rows), body, ws)
    return rows.withColumn("failed", F.when(F.expr(unless), None).otherwise(verdict)).drop(ws, body)


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    rows = judged(measured(docs).withColumn("base_failed", base), unless="base_failed")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *counts, "base_failed", (~F.col("base_failed") & F.col("failed").isNull()).alias("kept"))


OP5_SQL = r"""
WITH docs AS (
 SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
windows AS (
 SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS w
 FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM docs)),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
repeats AS (
 SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words
 FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM found WHERE n > 1) GROUP BY doc_id),
counted AS (
 SELECT doc_id, text, ws, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
 FROM docs LEFT JOIN repeats USING (doc_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT (base_failed OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words OR 5 * n_symbols > n_words
  OR 20 * len(list_distinct(ws)) < least(n_words, 2000)
  OR 2 * len(list_filter(ws, lambda w: regexp_matches(w, '\p{L}'))) < n_words) AS kept
FROM based
"""
