"""Suffix-array deduplication: common-prefix interval trees over sparse suffix arrays.

Suffixes are taken at anchors, the places whose hash of the next bytes is smallest within a window's
reach, so every window holds one and equal windows the same. Suffixes with one anchor form a bucket, whose
sorted suffixes and common prefix lengths are its enhanced suffix array. A stack scan gives its interval
tree; the members of an interval are told apart by what is on their left, and each group that differs there is a
maximal repeat with all its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import staged, table
from recordflow.llm.repeats import (
    _MEMBERS,
    HOT_TEXTS,
    Anchors,
    Buffer,
    Windows,
    around_anchors,
    binaries,
    bytes_of,
    cut_texts,
    keyed,
    merged,
    mix,
    powers,
    prefix_sums,
    resolved_groups,
    shared_anchors,
    stretch_hashes,
    stretches,
)

WINDOW_BYTES = 50

#: Bytes that an anchor is named by: more make chance anchors rarer, fewer make anchors sparser.
ANCHOR_BYTES = 20


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(suffixes: list[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix length, first, end) of every interval of sorted suffixes with at least ``least`` in common."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(suffixes) + 1):
        lcp = common(suffixes[i - 1], suffixes[i]) if i < len(suffixes) else -1
        first = i - 1
        while stack and stack[-1][0] > lcp:
            height, first = stack.pop()
            yield height, first, i
        if lcp >= least and (not stack or stack[-1][0] < lcp):
            stack.append((lcp, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], window: int, anchor: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before the anchor, bytes from it on, members) of the repeats of at least ``window`` bytes in a bucket.

    ``lefts`` are reversed, and ``rights`` what follows the ``anchor`` bytes that the bucket has in common. Each interval of the suffixes is scanned once more by what is left of its members;
    an interval of that scan can't be extended to the left, as its members differ there or end.
    """
    if len(rights) == 2:  # a tree of one interval
        left, right = common(*lefts), anchor + common(*rights)
        if left + right >= window:
            yield left, right, [0, 1]
        return
    array = sorted(range(len(rights)), key=rights.__getitem__)
    for more, first, end in intervals([rights[i] for i in array], 0):
        right = anchor + more
        members = sorted(array[first:end], key=lefts.__getitem__)
        for left, a, b in intervals([lefts[i] for i in members], max(0, window - right)):
            yield left, right, members[a:b]


class Places(NamedTuple):
    """Places of the anchors in the buffer, where the windows that choose them begin and end, and sums for hashing."""

    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sums: np.ndarray


class Suffixes:
    def __init__(self, window: int = WINDOW_BYTES, anchor: int = ANCHOR_BYTES):
        if not 0 < anchor < window < 256:
            raise ValueError("anchors are shorter than windows, and windows below 256 bytes")
        self.window, self.anchor = window, anchor

    def anchors(self, buffer: Buffer) -> Anchors:
        n, q, w = len(buffer.data), self.anchor, self.window
        none = np.zeros(0, np.int64)
        if n < w:
            return Anchors(none.astype(np.uint64), none, none, None)
        sums = prefix_sums(buffer.data)
        name = mix((sums[q:] - sums[:-q]) * powers(n + 1)[1][: n - q + 1])
        lengths = np.diff(buffer.offsets)
        row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        left = buffer.offsets[1:][row] - np.arange(n)  # bytes to the end of the text
        name[left[: n - q + 1] < q] = np.iinfo(np.uint64).max
        reach = w - q + 1
        low = sliding(name, reach, np.minimum)
        low[left[: len(low)] < w] = 0
        high = sliding(np.concatenate([np.zeros(reach - 1, np.uint64), low, np.zeros(reach - 1, np.uint64)]), reach, np.maximum)
        at = np.flatnonzero((name == high) & (left[: n - q + 1] >= q))
        start, end = self.chosen_by(low, name, at, buffer.offsets[:-1][row[at]], buffer.offsets[1:][row[at]])
        return Anchors(name[at], row[at].astype(np.int64), at - buffer.offsets[:-1][row[at]], Places(at, start, end, sums))

    def chosen_by(self, low: np.ndarray, name: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of the first and end of the last window that chooses each anchor.

        Windows in a row with one minimum have one anchor. Where it isn't the only one of its name
        there, all windows around are taken for each: more than needed does no harm.
        """
        reach = self.window - self.anchor + 1
        start, end = np.maximum(at - reach + 1, first), np.minimum(at + self.window, last)
        if not len(at):
            return start, end
        run = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        until = np.append(run[1:], len(low)) - 1
        run, until = run[low[run] > 0], until[low[run] > 0]
        # The anchors of a run lie between its last window's start and its first window's reach.
        place = np.searchsorted(at, until)
        exact, owner = np.zeros(len(run), bool), np.zeros(len(run), np.int64)
        for step in range(3):
            k = np.minimum(place + step, len(at) - 1)
            fits = ~exact & (name[at[k]] == low[run]) & (at[k] >= until) & (at[k] < run + reach)
            owner[fits] = k[fits]
            exact |= fits
        runs = np.bincount(owner[exact], minlength=len(at))
        # Anchors with a run of their own and no other claim on them.
        before = np.searchsorted(at, run)
        behind = np.searchsorted(at, until + reach)
        unclear = np.zeros(len(at) + 1, np.int64)
        np.add.at(unclear, before[~exact], 1)
        np.add.at(unclear, behind[~exact], -1)
        sole = (runs == 1) & (np.cumsum(unclear)[:-1] == 0)
        mine = exact & sole[owner]
        start[owner[mine]], end[owner[mine]] = run[mine], until[mine] + self.window
        return start, end

    def contents(self, buffer: Buffer, anchors: Anchors, chosen: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
        """One byte with the number of bytes before the anchor, these, and those behind it.

        The anchor's own bytes are what its bucket is named by.
        """
        at, end = anchors.more.at[chosen], anchors.more.end[chosen]
        before, behind = at - anchors.more.start[chosen], end - at - self.anchor
        parts = np.stack([at - before - 1, at + self.anchor], axis=1).ravel()
        length = np.stack([before + 1, behind], axis=1).ravel()
        data = buffer.data[np.maximum(stretches(parts, length), 0)]
        length = before + 1 + behind
        data[np.cumsum(length) - length] = before
        return binaries(data, length), mix(stretch_hashes(anchors.more.sums, at - before, end) + before.astype(np.uint64))

    def windows(self, buffer: Buffer, anchors: Anchors, chosen: np.ndarray) -> Windows:
        """A window's hashes are those of its halves, one of them with what both have in common."""
        places: Places = anchors.more
        n = places.end[chosen] - places.start[chosen] - self.window + 1
        start = stretches(places.start[chosen], n)
        row = np.repeat(anchors.row[chosen], n)
        half = self.window // 2
        first = stretch_hashes(places.sums, start, start + self.window)
        second = mix(stretch_hashes(places.sums, start, start + half) * np.uint64(3) + stretch_hashes(places.sums, start + half, start + self.window))
        return Windows(row, start - buffer.offsets[:-1][row], first, second, self.window)

    def reach(self, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        data, length = bytes_of(contents)
        before = data[np.cumsum(length) - length].astype(np.int64)
        return -before, self.anchor + length - 1 - before

    def repeats(self, contents: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        lefts = [c[1 : 1 + c[0]][::-1] for c in contents]
        return maximal_repeats(lefts, [c[1 + c[0] :] for c in contents], self.window, self.anchor)

    def pairs(self, contents: pa.BinaryArray, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes before the anchor and from it on that two members of a bucket have in common: trees of one interval, many at once."""
        data, length = bytes_of(contents)
        at = np.cumsum(length) - length
        before = data[at].astype(np.int64)
        behind = length - 1 - before
        anchor = at + 1 + before  # the place between what is before the anchor and what is behind it
        out = []
        for reach, step, shift in ((before, -1, -1), (behind, 1, 0)):
            most = np.minimum(reach[one], reach[other])
            shared, todo = np.zeros(len(one), np.int64), np.flatnonzero(most > 0)
            x, y = anchor[one] + shift, anchor[other] + shift
            while len(todo):
                n = shared[todo]
                same = data[x[todo] + step * n] == data[y[todo] + step * n]
                todo = todo[same]
                shared[todo] += 1
                todo = todo[shared[todo] < most[todo]]
            out.append(shared)
        return out[0], self.anchor + out[1]

    def covered(self, names: np.ndarray, docs: np.ndarray, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        start, end = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        bounds = np.array(list(groups(names)), np.int64).reshape(-1, 2)
        two = bounds[bounds[:, 1] - bounds[:, 0] == 2, 0]
        two = two[docs[two] != docs[two + 1]]
        if len(two):
            left, right = self.pairs(contents, two, two + 1)
            later = two + (docs[two + 1] > docs[two])
            some = left + right >= self.window
            start[later[some]], end[later[some]] = -left[some], right[some]
        more = bounds[bounds[:, 1] - bounds[:, 0] > 2]
        for a, b in more.tolist():
            own = docs[a:b].tolist()
            if min(own) == max(own):
                continue
            # Members with equal contents are one suffix, which has the smallest of their documents.
            suffix: dict[bytes, list[int]] = {}
            for i, c in enumerate(contents[a:b].to_pylist()):
                suffix.setdefault(c, []).append(i)
            least = [min(own[i] for i in members) for members in suffix.values()]
            spans = [(0, 0)] * len(suffix)
            if len(suffix) > 1:
                for left, right, members in self.repeats(list(suffix)):
                    first = min(least[j] for j in members)
                    for j in members:
                        if least[j] > first:
                            # All stretches hold the anchor, so their union is one.
                            spans[j] = (min(spans[j][0], -left), max(spans[j][1], right))
            for (content, members), low, span in zip(suffix.items(), least, spans, strict=True):
                whole = (-content[0], self.anchor + len(content) - 1 - content[0])
                for i in members:
                    start[a + i], end[a + i] = whole if own[i] > low else span
        return start, end


def sliding(x: np.ndarray, n: int, least: np.ufunc) -> np.ndarray:
    """Minima or maxima of all stretches of ``n``, by doubling."""
    have = 1
    while 2 * have <= n:
        x = least(x[:-have], x[have:])
        have *= 2
    return least(x[: len(x) - (n - have)], x[n - have :]) if n > have else x


def groups(names: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of stretches of two or more equal names."""
    start = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
    end = np.append(start[1:], len(names))
    some = end - start > 1
    yield from zip(start[some].tolist(), end[some].tolist(), strict=True)


def cut_bytes(text: str, spans: list[tuple[int, int]]) -> tuple[int, int, int, bytes]:
    data, gone = text.encode(), merged(spans)
    kept, at = [], 0
    for a, b in gone:
        kept.append(data[at:a])
        at = b
    rest = b"".join([*kept, data[at:]])
    return len(data), len(data) - len(rest), len(gone), rest


def deduplicated(docs: DataFrame, text: str = "text", window: int = WINDOW_BYTES, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """The rows with ``n_bytes``, ``n_removed``, ``n_spans`` (removed stretches) and ``kept``, the other bytes of their text.

    A byte goes if it is in a string of ``window`` bytes that also starts in a document with a smaller
    id; strings are judged on the texts as they come and never cross documents. Null texts are empty. Rows that
    share an id never cost each other anything, and a null id counts as the largest. Columns
    of these names are replaced.
    """
    added = [(n, T.LongType(), pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")] + [("kept", T.BinaryType(), pa.binary())]
    return cut_texts(docs, Suffixes(window), cut_bytes, added, text, hot_texts)


def repeat_groups(docs: DataFrame, text: str = "text", window: int = WINDOW_BYTES) -> DataFrame:
    """(bucket, length, key, doc_id, start, end): all occurrences of the maximal repeats around shared anchors.

    ``key`` is the hash of id and text; a repeat longer than the reach of an anchor appears as one group
    for each of its anchors. What a chunk of texts has more than once goes to the group as one row with all its places.
    """
    scheme = Suffixes(window)
    marked = keyed(docs, text)
    shared = staged(shared_anchors(marked, scheme), "repeat-anchors")
    schema = pa.schema([("bucket", pa.int64()), ("length", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def resolve(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        route, docs, keys, at, contents = (rows.column(f.name).to_pylist() for f in _MEMBERS)
        # Contents with several places stand twice, so that they are a repeat by themselves, too.
        twice = [i for i, places in enumerate(at) for _ in places[:2]]
        out = []
        for a, b in groups(np.array([route[i] for i in twice], np.int64)):
            for left, right, members in scheme.repeats([contents[i] for i in twice[a:b]]):
                for i in dict.fromkeys(twice[a + m] for m in members):
                    out += [(route[i], left + right, k, d, p - left, p + right) for k, d, p in zip(keys[i], docs[i], at[i], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    around = around_anchors(marked, shared, scheme, members=True)
    return resolved_groups(around, resolve, "bucket bigint, length int, key bigint, doc_id bigint, start int, end int")


def op10_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
