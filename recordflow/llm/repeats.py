"""What both kinds of substring deduplication share: finding repeats by anchors, in three passes.

An anchor is a place in a text that any window around it chooses by its own contents alone, so
equal windows choose equal anchors, at the same offset. The first pass names the anchors of all
texts and keeps those that two documents share; the second takes the contents around kept
anchors to one task per name, where equal windows are found; the third cuts the texts.

Before each shuffle, what a chunk of texts has more than once goes on once: the further documents of
a chunk that share an anchor, or a whole neighbourhood, with a smaller one are decided where they are. So
the group of a hot anchor holds a row for each chunk and not for each copy. An anchor with more texts than a group may
hold, as a common phrase in ever other surroundings has, makes no group at all: its windows go on one by one, and Spark takes the smallest
document of each in a grouping that adds up before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from recordflow.llm.common import chunks, free_name, mapped, released, staged

#: Bytes of text that are worked on at once; arrays of eight bytes for each of them are held.
CHUNK_BYTES = 1 << 19

#: Rows of whole anchor groups that are resolved together.
GROUP_ROWS = 20_000

#: Texts with an anchor beyond which its windows are compared one by one, each by itself. That changes the way, not the result.
HOT_TEXTS = 200_000

#: Hot anchors are told by so many low bits of their name; a chance match makes an anchor go the hot way, too.
SLOT_BITS = 22

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Buffer(NamedTuple):
    """The bytes of some texts one after another, and where each begins, with the end at last."""

    data: np.ndarray
    offsets: np.ndarray


def buffer_of(texts: pa.Array) -> Buffer:
    """Null texts are empty."""
    parts = [x.encode() if isinstance(x, str) else (x or b"") for x in texts.to_pylist()]
    return Buffer(np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the multiplier and of its inverse, modulo 2 to the 64.

    Those of a long text are forgotten with the next chunk of common length.
    """
    size = max(n, CHUNK_BYTES + 1)
    have = len(_powers.get("p", ()))
    if have < size or have > 4 * size:
        for name, factor in (("p", _P), ("i", _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["p"][:n], _powers["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums by which any stretch of the bytes can be hashed."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def stretch_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64))


class Anchors(NamedTuple):
    """Anchors by document of the chunk and place; ``more`` is what the scheme needs for their contents."""

    name: np.ndarray
    row: np.ndarray
    at: np.ndarray
    more: object


class Windows(NamedTuple):
    """Windows by document of the chunk, place in it and two independent hashes; ``width`` is what a window covers."""

    row: np.ndarray
    at: np.ndarray
    first: np.ndarray
    second: np.ndarray
    width: int


class Scheme(Protocol):
    def anchors(self, buffer: Buffer) -> Anchors: ...

    def contents(self, buffer: Buffer, anchors: Anchors, chosen: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
        """What lies around each chosen anchor, and hashes of it; equal contents have equal reach."""

    def reach(self, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end, relative to the anchor, of all windows within some contents."""

    def windows(self, buffer: Buffer, anchors: Anchors, chosen: np.ndarray) -> Windows:
        """Each window of the chosen anchors by itself."""

    def covered(self, names: np.ndarray, docs: np.ndarray, contents: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows sorted by name: start and end, relative to the anchor, of what a smaller document of the group also has.

        The end is not after the start where there is nothing.
        """


def stretches(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of the given stretches, one after another."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def binaries(data: np.ndarray, length: np.ndarray) -> pa.BinaryArray:
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def bytes_of(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after another, and the length of each."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], np.diff(offsets)


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """(_doc, _key, _text): a null id counts as the largest; rows equal in id and text have one key."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("_doc"), key_of(text).alias("_key"), F.col(text).alias("_text"))


def key_of(text: str):
    return F.xxhash64("doc_id", F.coalesce(text, F.lit("")))


def _spread(n: int, seed: np.ndarray) -> np.ndarray:
    """Routes for rows that need no group: all over the key space."""
    return mix(seed.astype(np.uint64) + np.arange(n, dtype=np.uint64) * np.uint64(_P)).astype(np.int64)


NAMED = pa.schema([("route", pa.int64()), ("name", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("n", pa.int32())])


def shared_anchors(docs: DataFrame, scheme: Scheme, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """(key, names, hot): for each text the low halves of the names of its anchors that a document of another id has, too.

    A half tells a text's anchors apart well enough: one too many is found out later. ``hot`` has the names that more than ``hot_texts``
    texts have, as far as the row knows: each such name is in one row at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", CHUNK_BYTES):
                doc, key = (part.column(c).to_numpy() for c in ("_doc", "_key"))
                found = scheme.anchors(buffer_of(part.column("_text")))
                order = np.lexsort((found.row, found.name))
                name, row = found.name[order], found.row[order]
                keep = np.ones(len(name), bool)
                keep[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
                name, row = name[keep], row[keep]
                if not len(name):
                    continue
                first = np.ones(len(name), bool)
                first[1:] = name[1:] != name[:-1]
                group = np.cumsum(first) - 1
                start = np.flatnonzero(first)
                low, high = np.minimum.reduceat(doc[row], start), np.maximum.reduceat(doc[row], start)
                known = (low < high)[group]
                route = np.where(first, name.astype(np.int64), _spread(len(name), key[row]))
                # Rows of one id alone are told apart nowhere: the first stands for them, and all ask for its group.
                route = np.where(known, route, name.astype(np.int64))
                # How many texts a row stands for; more than one says that they are of several documents.
                n = np.where(known, np.diff(np.append(start, len(name)))[group], 1)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((route, name.astype(np.int64), doc[row], key[row], n), NAMED, strict=True)], schema=NAMED)

    named = mapped(docs, run, "route bigint, name bigint, doc bigint, key bigint, n int")
    group = Window.partitionBy("route")
    told = named.withColumn("shared", (F.min("doc").over(group) < F.max("doc").over(group)) | (F.max("n").over(group) > 1))
    told = told.withColumn("texts", F.sum("n").over(group))
    hot = F.collect_set(F.when((F.col("texts") > hot_texts) & (F.col("route") == F.col("name")), F.col("name"))).alias("hot")
    return told.where("shared").groupBy("key").agg(F.collect_set(F.expr("int(name & 2147483647)")).alias("names"), hot)


def hot_slots(shared: DataFrame) -> np.ndarray:
    """A mark for each value of a name's low bits that a hot name has: a table of one size, whatever the number of names."""
    slots = shared.where("size(hot) > 0").select(F.explode("hot").alias("name")).select(F.expr(f"int(name & {2**SLOT_BITS - 1})").alias("slot")).distinct()
    marks = np.zeros(1 << SLOT_BITS, bool)
    marks[[r["slot"] for r in slots.collect()]] = True
    return marks


AROUND = "route bigint, doc bigint, key bigint, at array<int>, contents binary, decided boolean"
_AROUND = pa.schema([("route", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("at", pa.list_(pa.int32())), ("contents", pa.binary()), ("decided", pa.bool_())])


#: With all occurrences of some contents in a chunk: the item of each list belongs to one of them.
MEMBERS = "route bigint, docs array<bigint>, keys array<bigint>, at array<int>, contents binary"
_MEMBERS = pa.schema([("route", pa.int64()), ("docs", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("contents", pa.binary())])


def chosen_anchors(part: pa.RecordBatch, found: Anchors) -> np.ndarray:
    """Places of the anchors that a text's list names."""
    lists = part.column("names")
    wanted = lists.flatten().to_numpy().astype(np.int64)
    of = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
    half = (found.name & np.uint64(2**31 - 1)).astype(np.int64)
    return np.flatnonzero(np.isin(half | found.row << 31, wanted | of << 31))


def is_hot(names: np.ndarray, packed_marks: bytes) -> np.ndarray:
    slot = (names & np.uint64(2**SLOT_BITS - 1)).astype(np.int64)
    return (np.frombuffer(packed_marks, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def around_anchors(docs: DataFrame, shared: DataFrame, scheme: Scheme, members: bool = False, hot: bytes | None = None) -> DataFrame:
    """The contents around shared anchors that are not ``hot``, once for each document of the smallest id in a chunk that has them.

    With ``members``, once for a chunk, with all their occurrences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", CHUNK_BYTES):
                doc, key = (part.column(c).to_numpy() for c in ("_doc", "_key"))
                buffer = buffer_of(part.column("_text"))
                found = scheme.anchors(buffer)
                chosen = chosen_anchors(part, found)
                if hot:
                    chosen = chosen[~is_hot(found.name[chosen], hot)]
                if not len(chosen):
                    continue
                contents, digest = scheme.contents(buffer, found, chosen)
                name, row, at = found.name[chosen], found.row[chosen], found.at[chosen]
                # Rows of one anchor with equal contents lie together, those of one text next to each other.
                order = np.lexsort((at, row, digest, name))
                name, row, at, digest = name[order], row[order], at[order], digest[order]
                new = np.concatenate([[True], (name[1:] != name[:-1]) | (digest[1:] != digest[:-1])])
                if members:
                    some = np.flatnonzero(new)
                    cuts = pa.array(np.append(some, len(order)), pa.int32())
                    lists = [pa.ListArray.from_arrays(cuts, x) for x in (pa.array(doc[row]), pa.array(key[row]), pa.array(at, pa.int32()))]
                    yield pa.RecordBatch.from_arrays([pa.array(name[some].astype(np.int64)), *lists, contents.take(pa.array(order[some]))], schema=_MEMBERS)
                    continue
                low = np.minimum.reduceat(doc[row], np.flatnonzero(new))[np.cumsum(new) - 1]
                text = np.flatnonzero(new | np.concatenate([[True], row[1:] != row[:-1]]))
                row, name, low = row[text], name[text].astype(np.int64), low[text]
                decided = doc[row] > low
                # A decided row joins no group, so it may go anywhere.
                route = np.where(decided, key[row] ^ at[text], name)
                places = pa.ListArray.from_arrays(pa.array(np.append(text, len(order)), pa.int32()), pa.array(at, pa.int32()))
                out = [pa.array(route), pa.array(doc[row]), pa.array(key[row]), places, contents.take(pa.array(order[text])), pa.array(decided)]
                yield pa.RecordBatch.from_arrays(out, schema=_AROUND)

    hits = shared.select(F.col("key").alias("_hit"), "names")
    return mapped(docs.join(hits, F.col("_key") == F.col("_hit")).drop("_hit"), run, MEMBERS if members else AROUND)


def hot_spans(docs: DataFrame, shared: DataFrame, scheme: Scheme, marks: np.ndarray) -> DataFrame:
    """(key, start, end): the windows of hot anchors that a smaller document has, too, window by window.

    Of the texts of a chunk that have a window the smallest one asks for it, and the others are decided. Windows are told by two hashes of 64 bits.
    """
    hot = np.packbits(marks, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", CHUNK_BYTES):
                doc, key = (part.column(c).to_numpy() for c in ("_doc", "_key"))
                buffer = buffer_of(part.column("_text"))
                found = scheme.anchors(buffer)
                chosen = chosen_anchors(part, found)
                chosen = chosen[is_hot(found.name[chosen], hot)]
                if not len(chosen):
                    continue
                w = scheme.windows(buffer, found, chosen)
                order = np.lexsort((w.at, doc[w.row], w.second, w.first))
                row, at, first, second = (x[order] for x in (w.row, w.at, w.first, w.second))
                new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
                low = doc[row][np.flatnonzero(new)][np.cumsum(new) - 1]
                columns = (first.astype(np.int64), second.astype(np.int64), doc[row], key[row], at, at + w.width, doc[row] > low)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, HOT, strict=True)], schema=HOT)

    half = docs.sparkSession.createDataFrame([(int(s),) for s in np.flatnonzero(marks)], "slot int")
    named = shared.select("key", F.explode("names").alias("half")).withColumn("of", F.expr(f"half & {2**SLOT_BITS - 1}"))
    keys = named.join(F.broadcast(half), F.col("of") == F.col("slot"), "left_semi").groupBy(F.col("key").alias("_hit")).agg(F.collect_set("half").alias("names"))
    rows = mapped(docs.join(keys, F.col("_key") == F.col("_hit")).drop("_hit"), run, "first bigint, second bigint, doc bigint, key bigint, start int, end int, decided boolean")
    rows = staged(rows, "repeat-hot")
    asked = rows.where("NOT decided")
    least = staged(asked.groupBy(F.col("first").alias("f"), F.col("second").alias("s")).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most"), "repeat-least")
    later = asked.join(least, (F.col("first") == F.col("f")) & (F.col("second") == F.col("s"))).where("doc > least")
    return rows.where("decided").select("key", "start", "end").union(later.select("key", "start", "end"))


HOT = pa.schema([("first", pa.int64()), ("second", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("decided", pa.bool_())])


def resolved_groups(around: DataFrame, resolve: Callable[[list], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``resolve`` over whole anchor groups, some at a time, in the order of their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            route = batch.column("route").to_numpy()
            held.append(batch)
            n += len(route)
            if n >= GROUP_ROWS and len(route):
                cut = int(np.searchsorted(route, route[-1]))
                if cut == 0 and len(held) > 1 and held[-2].num_rows and held[-2].column("route")[-1].as_py() == route[-1]:
                    continue  # the last group may go on, and began before this batch
                held[-1] = batch.slice(0, cut)
                yield from resolve(held)
                held, n = [batch.slice(cut)], len(route) - cut
        yield from resolve(held)

    return mapped(around.repartition("route").sortWithinPartitions("route"), run, schema)


COVERED = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def covered_spans(around: DataFrame, scheme: Scheme, others: DataFrame | None = None) -> DataFrame:
    """(key, spans): for each text the stretches of windows that a smaller document has, too, and those of ``others``."""

    def resolve(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        if not table.num_rows:
            return
        route, doc, key, decided = (table.column(c).to_numpy() for c in ("route", "doc", "key", "decided"))
        contents = table.column("contents").combine_chunks()
        at = table.column("at").combine_chunks()
        start, end = np.zeros(len(route), np.int64), np.zeros(len(route), np.int64)
        start[decided], end[decided] = scheme.reach(contents.filter(pa.array(decided)))
        start[~decided], end[~decided] = scheme.covered(route[~decided], doc[~decided], contents.filter(pa.array(~decided)))
        times = np.where(end > start, np.diff(at.offsets.to_numpy()), 0)
        place = at.flatten().to_numpy()[np.repeat(end > start, np.diff(at.offsets.to_numpy()))]
        out = (np.repeat(key, times), place + np.repeat(start, times), place + np.repeat(end, times))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, COVERED, strict=True)], schema=COVERED)

    rows = resolved_groups(around, resolve, "key bigint, start int, end int")
    rows = rows if others is None else rows.union(others)
    return rows.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def cut_texts(
    docs: DataFrame, scheme: Scheme, cut: Callable[[str, list], tuple], added: list[tuple[str, T.DataType, pa.DataType]], text: str, hot_texts: int = HOT_TEXTS
) -> DataFrame:
    """The rows with the columns ``added``, which ``cut`` makes of a text and its covered spans."""
    names = [n for n, _, _ in added]
    rows = docs.drop(*names)
    kept = rows.schema.fields
    marked = keyed(rows, text)
    shared = staged(shared_anchors(marked, scheme, hot_texts), "repeat-anchors")
    released(docs.sparkSession)
    marks = hot_slots(shared)
    others = hot_spans(marked, shared, scheme, marks) if marks.any() else None
    hot = np.packbits(marks, bitorder="little").tobytes() if marks.any() else None
    spans = staged(covered_spans(around_anchors(marked, shared, scheme, hot=hot), scheme, others), "repeat-spans")
    released(docs.sparkSession)
    own, key, found = (free_name(rows, c) for c in ("own", "key", "found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cut(x or "", [(s["start"], s["end"]) for s in spans or []]) for x, spans in zip(batch.column(text).to_pylist(), batch.column(found).to_pylist(), strict=True)]
            cols = [batch.column(f.name) for f in kept] + [pa.array([m[i] for m in made], t) for i, (_, _, t) in enumerate(added)]
            yield pa.RecordBatch.from_arrays(cols, [*(f.name for f in kept), *names])

    joined = rows.withColumn(own, key_of(text)).join(spans.select(F.col("key").alias(key), F.col("spans").alias(found)), F.col(own) == F.col(key), "left")
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t, _ in added)])
    return mapped(joined.drop(own, key), run, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans as separate ones, in order; those that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
