"""Substring deduplication by recompression of word sequences.

Texts become sequences of word symbols, and rounds replace runs of one symbol, then pairs of
neighbours of two classes, by new symbols. A symbol is named by a hash of what it is made of, so all
tasks give equal names to equal contents without asking one another, and equal word sequences get equal
symbols but for those at their ends, which may have joined with what is outside. The highest
symbol that a window surely shares with its equals is its anchor. Spark groups
anchors over all texts: those that two documents share reveal repeats, which are then verified window by window.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm import repeats
from recordflow.llm.common import packed, table, unpacked
from recordflow.llm.repeats import HOT_TEXTS, Anchors, Buffer, binaries, bytes_of, cut_texts, merged, mix, prefix_sums, stretch_hashes, stretches

WINDOW_WORDS = 13

#: One round of runs, then rounds of pairs. A window keeps the highest symbol that it has as its own; few of 13 words have one above.
ROUNDS = ("runs", "pairs", "pairs", "pairs", "pairs")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Windows(NamedTuple):
    """Windows sorted by anchor: offset to the anchor and hash of the words; those of anchor i begin at ``begin[i]``."""

    offset: np.ndarray
    key: np.ndarray
    begin: np.ndarray


def word_table(buffer: Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word."""
    word = ~_SPACE[buffer.data]
    border = np.zeros(len(word) + 1, bool)
    border[buffer.offsets] = True
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    after = np.concatenate([word[1:], [False]]) if len(word) else word
    start = np.flatnonzero(word & (~before | border[:-1]))
    end = np.flatnonzero(word & (~after | border[1:])) + 1
    return stretch_hashes(prefix_sums(buffer.data), start, end), np.searchsorted(buffer.offsets, start, side="right") - 1


def run_round(name: np.ndarray, row: np.ndarray, start: np.ndarray):
    """Runs of one symbol as one symbol; the new place of each old symbol."""
    head = np.ones(len(name), bool)
    head[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(name))).astype(np.uint64)
    named = np.where(length > 1, mix(name[at] * _STEP + length), name[at])
    return named, row[at], start[at], np.cumsum(head) - 1


def pair_round(name: np.ndarray, row: np.ndarray, start: np.ndarray, first: np.ndarray):
    """Neighbours of which the left is of the first class and the right of the second as one symbol."""
    pair = np.zeros(len(name), bool)
    pair[:-1] = first[:-1] & ~first[1:] & (row[1:] == row[:-1])
    keep = np.ones(len(name), bool)
    keep[1:] = ~pair[:-1]
    at = np.flatnonzero(keep)
    after = name[np.minimum(at + 1, len(name) - 1)]
    named = np.where(pair[at], mix(name[at] * _STEP ^ mix(after + _STEP)), name[at])
    return named, row[at], start[at], np.cumsum(keep) - 1


class Recompression:
    def __init__(self, window: int = WINDOW_WORDS):
        self.window = window

    def anchors(self, buffer: Buffer) -> Anchors:
        words, row = word_table(buffer)
        n, w = len(words), self.window
        none = np.zeros(0, np.int64)
        if n < w:
            return Anchors(none.astype(np.uint64), none, none, Windows(none, none, np.zeros(1, np.int64)))
        at = np.flatnonzero(row[: n - w + 1] == row[w - 1 :])
        salted, key = mix(words ^ _STEP), np.zeros(len(at), np.uint64)
        for j in range(w):
            key = key * _STEP + salted[at + j]
        key = mix(key)
        # Until a level has a symbol that is the window's own, the window is its own anchor.
        anchor, place = key.copy(), at.copy()
        name, doc, start = words, row, np.arange(n)
        low, high, open_ = at, at + w, np.arange(len(at))

        def settle(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            """The longest of each window's symbols, of these the one of the smallest name; none that is a single word.

            Single words are in so many texts that their groups would be hot: such windows stay their own anchors.
            """
            span = np.diff(np.append(start, n))
            order = (np.uint64(63) - np.minimum(span, 63).astype(np.uint64) << np.uint64(58)) | name >> np.uint64(6)
            best, where = order[low], low.copy()
            for step in range(1, int((high - low).max(initial=1))):
                cand = np.minimum(low + step, high - 1)
                better = order[cand] < best
                best, where = np.where(better, order[cand], best), np.where(better, cand, where)
            wide = span[where] > 1
            anchor[which[wide]], place[which[wide]] = name[where[wide]], start[where[wide]]

        for level, kind in enumerate(ROUNDS):
            if kind == "runs":
                new = run_round(name, doc, start)
                # Runs at the ends may go on outside.
                lo, hi = new[3][low] + 1, new[3][high - 1]
            else:
                first = (mix(name + np.uint64(level)) >> np.uint64(63)).astype(bool)
                new = pair_round(name, doc, start, first)
                lo, hi = low + ~first[low], high - first[high - 1]
                some = lo < hi
                lo, hi = np.where(some, new[3][np.minimum(lo, len(name) - 1)], 0), np.where(some, new[3][np.maximum(hi, 1) - 1] + 1, 0)
            ended = lo >= hi
            if level and ended.any():
                settle(open_[ended], low[ended], high[ended])
            low, high, open_ = lo[~ended], hi[~ended], open_[~ended]
            name, doc, start = new[:3]
        if len(open_):
            settle(open_, low, high)
        order = np.lexsort((at, anchor, place))
        anchor, place, at, key = anchor[order], place[order], at[order], key[order]
        begin = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1])]))
        firsts = np.searchsorted(row, np.arange(len(buffer.offsets)))
        own = row[place[begin]]
        return Anchors(anchor[begin], own, place[begin] - firsts[own], Windows((at - place).astype(np.int8), key, np.append(begin, len(at))))

    def contents(self, buffer: Buffer, anchors: Anchors, chosen: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
        """The windows of an anchor in eight bytes each: the upper ones of its hash, and its offset."""
        windows: Windows = anchors.more
        n = windows.begin[chosen + 1] - windows.begin[chosen]
        at = stretches(windows.begin[chosen], n)
        packed_ = (windows.key[at] & ~np.uint64(255)) | windows.offset[at].view(np.uint8)
        digest = np.add.reduceat(mix(packed_), np.cumsum(n) - n)
        return binaries(packed_.astype("<u8").view(np.uint8), 8 * n), mix(digest)

    def windows(self, buffer: Buffer, anchors: Anchors, chosen: np.ndarray) -> repeats.Windows:
        """A window's second hash is made of its words anew."""
        found: Windows = anchors.more
        n = found.begin[chosen + 1] - found.begin[chosen]
        at = stretches(found.begin[chosen], n)
        row, place = np.repeat(anchors.row[chosen], n), np.repeat(anchors.at[chosen], n) + found.offset[at]
        words, of = word_table(buffer)
        first = np.searchsorted(of, row) + place
        salted, second = mix(words + _STEP), np.zeros(len(at), np.uint64)
        for j in range(self.window):
            second = (second ^ salted[first + j]) * _STEP
        return repeats.Windows(row, place, found.key[at], mix(second), self.window)

    def windows_of(self, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets and hashes of all windows, and how many each row has."""
        data, length = bytes_of(contents)
        found = data.view("<u8")
        return found.astype(np.uint8).view(np.int8).astype(np.int64), found & ~np.uint64(255), length // 8

    def reach(self, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        offset, _, n = self.windows_of(contents)
        ends = np.cumsum(n)
        return offset[ends - n], offset[ends - 1] + self.window

    def covered(self, names: np.ndarray, docs: np.ndarray, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full(len(names), 127), np.full(len(names), -128 - self.window)
        if len(names):
            offset, key, n = self.windows_of(contents)
            owner = np.repeat(np.arange(len(names)), n)
            name, doc = names[owner], docs[owner]
            order = np.lexsort((key, name))
            name, key = name[order], key[order]
            start = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (key[1:] != key[:-1])]))
            least = np.repeat(np.minimum.reduceat(doc[order], start), np.diff(np.append(start, len(order))))
            gone = order[doc[order] > least]
            # All windows of an anchor overlap in it, so those that go are one stretch.
            np.minimum.at(low, owner[gone], offset[gone])
            np.maximum.at(high, owner[gone], offset[gone])
        return low, high + self.window


def cut_words(text: str, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    words = _WORD.findall(text)
    kept, at = [], 0
    for a, b in merged(spans):
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), len(words) - len(kept), " ".join(kept)


def deduplicated(docs: DataFrame, text: str = "text", window: int = WINDOW_WORDS, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """The rows with ``n_words``, ``n_removed`` and ``kept``: their words without repeats, joined by a space.

    A word goes if it is in a window of ``window`` words that also starts in a document with a
    smaller id; windows are judged on the texts as they come. Null texts have no words. Rows that share an id never cost
    each other anything, and a null id counts as the largest. Columns of these names are replaced.
    """
    added = [("n_words", T.LongType(), pa.int64()), ("n_removed", T.LongType(), pa.int64()), ("kept", T.StringType(), pa.string())]
    return cut_texts(docs, Recompression(window), cut_words, added, text, hot_texts)


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def cut_if_repeated(text: str, spans: list[tuple[int, int]]) -> tuple[str | None]:
    """The text without its covered words; none where nothing is covered, so untouched texts are not carried twice."""
    return (cut_words(text, spans)[2] if spans else None,)


def deduplicated_words_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without the words of passages that an earlier document has; untouched ones stay as they are.

    A null text stays null, and rows that share an id cost each other nothing.
    """
    rows = cut_texts(packed(docs, "doc_id", "text"), Recompression(), cut_if_repeated, [("kept", T.StringType(), pa.string())], "text")
    cut = F.col("kept").isNotNull()
    length = F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col("row.n_chars"))
    return unpacked(rows, docs.columns, text=F.coalesce("kept", "text"), n_chars=length)
