"""Periodic runs of words: branching tandem repeats from an enhanced suffix array.

A suffix array with its inverse and common prefix lengths is made over the words of some texts at once. A square whose halves
differ in what follows is found at the interval whose depth is its period: one of its two suffixes lies in a child that is
not the largest, so only those children are walked, and the other suffix is looked for by its place in the array.
Rotating such a square to the left as far as it goes gives its run. Intervals are places in arrays; no tree is built.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import chunks, mapped, table, words

#: Runs repeat their period so often and have so many words at least.
MIN_EXPONENT, MIN_WORDS = 4, 6

#: Suffixes of small children that are looked up at once.
BLOCK = 1 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


class Suffixes(NamedTuple):
    """Those suffixes that share their first word with another of their text, in order, and where each is in it.

    ``levels[k]`` tells suffixes apart by their first 2^k words; a suffix that shares no first word has a number of its own.
    """

    order: np.ndarray
    common: np.ndarray
    levels: list[np.ndarray]

    @property
    def place(self) -> np.ndarray:
        return self.levels[-1]


def group_starts(new: np.ndarray) -> np.ndarray:
    """For each place the first one of its group, where ``new`` marks the first of each."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def changes(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]])


def suffixes(symbols: np.ndarray, end: np.ndarray) -> Suffixes:
    """Sorted by doubling: each level orders by the first half, then by the level's own rank of the second half.

    ``symbols`` are numbers below their count that no two texts share, and ``end`` is where each one's text ends. Only groups that are not told apart yet are sorted again.
    """
    n = len(symbols)
    todo = np.flatnonzero(np.bincount(symbols, minlength=n)[symbols] > 1)
    todo = todo[np.argsort(symbols[todo], kind="stable")]
    total = len(todo)
    rank = np.arange(total, total + n)  # of suffixes that are alone
    rank[todo] = group_starts(changes(symbols[todo]))
    order, levels, half = todo.copy(), [rank], 1
    while len(todo):
        rest = todo + half
        second = np.where(rest < end[todo], rank[np.minimum(rest, n - 1)] + 1, 0)
        key = rank[todo] * (total + n + 1) + second
        by = np.argsort(key, kind="stable")
        todo, key = todo[by], key[by]
        first = rank[todo]
        at = first + np.arange(len(todo)) - group_starts(changes(first))
        new = changes(key)
        order[at] = todo
        rank = rank.copy()
        rank[todo] = at[group_starts(new)]
        levels.append(rank)
        todo = todo[~(new & np.append(new[1:], True))]
        half *= 2
    left, right = order[:-1], order[1:]
    pair = np.flatnonzero(symbols[left] == symbols[right]) if total else np.zeros(0, np.int64)
    left, right = left[pair], right[pair]
    length = np.zeros(len(pair), np.int64)
    for k in reversed(range(len(levels))):
        a, b = left + length, right + length
        inside = np.maximum(a, b) < end[left]
        level = levels[k]
        same = inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
        length += same.astype(np.int64) << k
    common = np.zeros(total + 1, np.int64)
    common[pair + 1] = length
    return Suffixes(order, common, levels)


def nearest(values: np.ndarray, step: int, equal: bool) -> np.ndarray:
    """For each place that is above 0 the next one in a direction with a smaller value, or with one that is not larger.

    Places that are no answer point on to their own candidate, so the way doubles with each look.
    """
    found = np.arange(len(values)) + step
    todo = np.flatnonzero(values > 0)
    while len(todo):
        there = values[found[todo]]
        todo = todo[there > values[todo] if equal else there >= values[todo]]
        found[todo] = found[found[todo]]
    return found


def branching_squares(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, array: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that do not go on with their first word, each once or more."""
    values = array.common
    border = np.flatnonzero(values > 0)
    if not len(border):
        return border, border
    low, after = nearest(values, -1, False), nearest(values, 1, False)
    back = nearest(values, -1, True)
    # Borders of one interval are chained to its first one.
    chained = values[back[border]] == values[border]
    owner = np.arange(len(values))
    owner[border[chained]] = back[border[chained]]
    while (owner[owner] != owner).any():
        owner = owner[owner]
    last = np.ones(len(values), bool)
    last[back[border[chained]]] = False
    closing = border[last[border]]
    # A child lies before each border of an interval, and one after its last border.
    of = np.concatenate([owner[border], owner[closing]])
    start = np.concatenate([back[border], closing])
    size = np.concatenate([border, after[closing]]) - start
    by = np.lexsort((size, of))
    of, start, size = of[by], start[by], size[by]
    small = ~np.append(of[1:] != of[:-1], True)  # all but the largest
    of, start, size = of[small], start[small], size[small]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, side="right")))
        n = size[at:upto]
        interval = np.repeat(of[at:upto], n)
        place = np.repeat(start[at:upto] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        suffix, depth = array.order[place], values[interval]
        for other, first in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
            inside = np.flatnonzero((other >= begin[suffix]) & (other < end[suffix]))
            p = array.place[other[inside]]
            i = interval[inside]
            inside = inside[(p >= low[i]) & (p < after[i])]
            s, d = first[inside], depth[inside]
            behind = s + 2 * d
            differs = (behind >= end[s]) | (symbols[s + d] != symbols[np.minimum(behind, len(symbols) - 1)])
            found.append((s[differs], d[differs]))
        at = upto
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_in(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, exponent: int = MIN_EXPONENT, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period; a stretch counts once, with its smallest period."""
    array = suffixes(symbols, end)
    start, period = branching_squares(symbols, begin, end, array)
    until = start + 2 * period
    for k in reversed(range(len(array.levels))):
        level, further = array.levels[k], start - (1 << k)
        goes = further >= begin[start]
        further = np.where(goes, further, 0)
        start = np.where(goes & (level[further] == level[further + period]), further, start)
    by = np.lexsort((period, until, start))
    start, until, period = start[by], until[by], period[by]
    keep = (changes(start) | changes(until)) & (until - start >= np.maximum(least, exponent * period))
    start, until, period = start[keep], until[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], until[by], period[by]


def runs_of(texts: list[list[bytes]], exponent: int = MIN_EXPONENT, least: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, given as its words."""
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    symbols = np.zeros(offsets[-1], np.int64)
    for t, a in zip(texts, offsets.tolist(), strict=False):
        last = dict(zip(t, range(a, a + len(t)), strict=True))
        symbols[a : a + len(t)] = np.fromiter(map(last.__getitem__, t), np.int64, len(t))
    begin, end = np.repeat(offsets[:-1], lengths), np.repeat(offsets[1:], lengths)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(symbols):
        return out
    start, until, period = runs_in(symbols, begin, end, exponent, least)
    row = np.searchsorted(offsets, start, side="right") - 1
    for r, a, n, p in zip(row.tolist(), (start - offsets[row]).tolist(), (until - start).tolist(), period.tolist(), strict=True):
        out[r].append((a, n, p))
    return out


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those in a run after its first period, joined by a space."""
    if not runs:
        return b" ".join(text)
    gone = bytearray(len(text))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return b" ".join(w for w, g in zip(text, gone, strict=True) if not g)


def periodic_runs(docs: DataFrame, text: str = "text", exponent: int = MIN_EXPONENT, least: int = MIN_WORDS, keep_text: bool = True) -> DataFrame:
    """The rows with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    A run is a stretch of words with smallest period q, of at least ``exponent`` times q and ``least`` words, that neither neighbour
    extends. ``collapsed`` is the text without what runs repeat, its words joined by a space. A null or empty text has no runs
    and is collapsed to an empty one. Rows are independent, so ties and repeated rows change nothing; other columns are kept, and ones of
    these names are replaced. A text is held in one task, with some 200 bytes for each of its words.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period twice at least")
    names = ("n_words", "runs", "collapsed")
    kept = [f for f in docs.schema.fields if f.name not in names and (keep_text or f.name != text)]
    runs_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                texts = [(x or "").encode().split() for x in part.column(text).to_pylist()]
                found = runs_of(texts, exponent, least)
                added = [
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found], runs_type),
                    pa.array([collapsed(t, r).decode() for t, r in zip(texts, found, strict=True)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *added], [*(f.name for f in kept), *names])

    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    return mapped(docs, run, T.StructType([*kept, *added]))


def strongest(runs: Column) -> Column:
    """Of runs by start and period the first one with the greatest exact exponent; null for none."""
    better = lambda best, r: F.when(r.length * best.period > best.length * r.period, r).otherwise(best)
    return F.when(F.size(runs) > 0, F.aggregate(runs, F.element_at(runs, 1), better))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, chosen by the hash of doc_id, with a periodic end made of their own words; a null id plants none."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    ws = words(F.col("text"))
    planted = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, ws).alias("ws")).withColumn("g", F.expr("h div 10")).withColumn("n", F.size("ws"))
    planted = planted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    joined = F.expr("concat_ws(' ', transform(ws, (w, i) -> IF(i < a, w, ws[int(a + (i - a) % p)])))")
    return planted.select("doc_id", F.when(F.col("a").isNotNull(), joined).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), keep_text=False)
    best = strongest(F.col("runs"))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    lines = F.concat_ws("", F.transform(listed, lambda line: F.concat(line, F.lit("\n"))))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.expr("1000 * best.length div best.period")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
