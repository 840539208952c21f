"""SimHash near-duplicates: BK-trees over fingerprints, within shards that no link leaves."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import free_name, mapped, released, staged, table
from recordflow.llm.components import components

BITS = 64
SEED = 42

#: Differing bits up to which fingerprints link.
RADIUS = 2

#: Fingerprints of a shard beyond which it is divided again by further bits.
SHARD_ROWS = 20_000

#: Pairs of a query and a node that are followed at once, about.
FRONTIER = 1 << 21

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, n: int = 3) -> np.ndarray:
    """XXH64 of the space-joined n-word shingles of a text in lower case, with repeats; of all words if fewer."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(" ".join(words), SEED)], np.uint64)
    joined = " ".join(words).encode()
    ends, at = [], -1
    for w in words:
        at += 1 + (len(w) if w.isascii() else len(w.encode()))
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[n - 1 :], strict=False)], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; 0 for none."""
    if not len(hashes):
        return 0
    bits = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i : i + (1 << 16)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = 3, fingerprint: str = "fingerprint") -> DataFrame:
    """The rows with the 64-bit SimHash of their text as a signed integer, 0 for a text without words.

    A null text has no words. Rows are independent; a column named ``fingerprint`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != fingerprint]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(shingle_hashes(x, shingle_words)) for x in batch.column(text).to_pylist()]
            cols = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.array(found, np.uint64).astype(np.int64))], [*(f.name for f in kept), fingerprint])

    return mapped(docs, run, T.StructType([*kept, T.StructField(fingerprint, T.LongType())]))


class BKTree:
    """Different fingerprints as a BK-tree: a child hangs from its parent by their Hamming distance.

    Built level by level: of the values that meet at a node by one distance the first becomes
    the child, and the others go on below it. Searches take a block of queries down together, and follow only
    the edges whose distance is within the radius of the query's distance to the parent.
    """

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint64)
        n = len(values)
        self.parent, self.edge = np.full(n, -1), np.zeros(n, np.int64)
        at, todo = np.zeros(n, np.int64), np.arange(1, n)
        while len(todo):
            distance = np.bitwise_count(self.values[todo] ^ self.values[at[todo]]).astype(np.int64)
            slot = at[todo] * (BITS + 1) + distance
            _, first, where = np.unique(slot, return_index=True, return_inverse=True)
            child = todo[first]
            self.parent[child], self.edge[child] = at[child], distance[first]
            at[todo] = child[where]
            rest = np.ones(len(todo), bool)
            rest[first] = False
            todo = todo[rest]
        # Children by parent and edge, so that those within a radius are neighbours.
        self.order = np.argsort(self.parent[1:] * (BITS + 1) + self.edge[1:], kind="stable") + 1 if n > 1 else np.zeros(0, np.int64)
        self.slots = self.parent[self.order] * (BITS + 1) + self.edge[self.order]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, value), as places, at most ``radius`` bits apart."""
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        found = []
        while len(q):
            distance = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            found.append((q[near], node[near]))
            low = np.searchsorted(self.slots, node * (BITS + 1) + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.slots, node * (BITS + 1) + np.minimum(distance + radius, BITS), side="right")
            n = high - low
            q = np.repeat(q, n)
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            node = self.order[at]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the values that hold their components together, fewer than there are values.

    In a dense shard nearly all values are within the radius of some pivot and so of one component
    already: only the others go down the tree. Found pairs of one component are dropped as arrays.
    """
    values = values.astype(np.uint64)
    n = len(values)
    root = np.arange(n)
    kept: list[tuple[int, int]] = []
    others = np.arange(n)
    if n > 64:
        tried = np.linspace(0, n - 1, 16).astype(int)
        pivot = max(tried, key=lambda i: int((np.bitwise_count(values ^ values[i]) <= radius).sum()))
        near = np.bitwise_count(values ^ values[pivot]) <= radius
        kept += [(int(i), int(pivot)) for i in np.flatnonzero(near) if i != pivot]
        root[near] = np.flatnonzero(near)[0]
        others = np.flatnonzero(~near)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    tree = BKTree(values)
    block = max(16, FRONTIER // max(n, 1))
    for start in range(0, len(others), block):
        asked = others[start : start + block]
        q, v = tree.within(values[asked], radius)
        q = asked[q]
        while (root[root] != root).any():
            root = root[root]
        apart = root[q] != root[v]
        q, v = q[apart], v[apart]
        _, first = np.unique(root[q] * n + root[v], return_index=True)
        for i, j in zip(q[first].tolist(), v[first].tolist(), strict=True):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                kept.append((i, j))
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def blocks(bits: list[int], n: int) -> list[list[int]]:
    """The bits in ``n`` parts of about the same number."""
    return [bits[len(bits) * i // n : len(bits) * (i + 1) // n] for i in range(n)]


def block_value(value, bits: list[int]):
    """The bits of a signed column at the given neighbouring places."""
    return F.shiftrightunsigned(value, bits[0]).bitwiseAND(F.lit((1 << len(bits)) - 1))


def sharded(values: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, fingerprint): any two values within the radius share at least one shard.

    Of ``radius + 1`` blocks of bits, two such values have one in common. Shards of over ``shard_rows``
    values are divided again by the blocks of their other bits, which again loses no pair.
    """
    n = radius + 1
    parts = blocks(list(range(BITS)), n)
    found = None
    rows = values.select("fingerprint", F.explode(F.array(*[F.struct(F.lit(i).alias("path"), block_value(F.col("fingerprint"), p).alias("v")) for i, p in enumerate(parts)])).alias("s"))
    rows = rows.select("fingerprint", F.col("s.path").alias("path"), F.xxhash64("s.path", "s.v").alias("shard"))
    sizes = staged(rows.groupBy("path", "shard").count().where(F.col("count") > shard_rows).select(F.col("shard").alias("hot")), "simhash-hot")
    found = rows.join(sizes, F.col("shard") == F.col("hot"), "left")
    again = []
    for i, p in enumerate(parts):
        rest = [b for b in range(BITS) if b not in p]
        # Neighbouring places only, so a block that spans the gap is cut there.
        for j, sub in enumerate(blocks(rest, n)):
            runs = [sub] if sub[-1] - sub[0] == len(sub) - 1 else [[b for b in sub if b < p[0]], [b for b in sub if b > p[-1]]]
            again.append(F.when(F.col("path") == i, F.xxhash64("shard", F.lit(j), *[block_value(F.col("fingerprint"), r) for r in runs])))
    finer = F.filter(F.array(*again), lambda s: s.isNotNull())
    return found.select("fingerprint", F.explode(F.when(F.col("hot").isNull(), F.array("shard")).otherwise(finer)).alias("shard"))


def linked(shards: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) of a forest of each shard's links; a task streams shards and holds one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(own: list[np.ndarray]) -> pa.RecordBatch:
            values = np.unique(np.concatenate(own))
            i, j = forest(values.view(np.uint64), radius) if len(values) > 1 else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(values[i]), pa.array(values[j])], ["a", "b"])

        shard, own = None, []
        for batch in batches:
            keys, values = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "fingerprint"))
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                if shard != keys[a]:
                    if sum(map(len, own)) > 1:
                        yield links(own)
                    shard, own = keys[a], []
                own.append(values[a:b])
        if sum(map(len, own)) > 1:
            yield links(own)

    dealt = shards.select("shard", "fingerprint").repartition("shard").sortWithinPartitions("shard")
    return mapped(dealt, run, "a bigint, b bigint")


def near_duplicates(printed: DataFrame, radius: int = RADIUS, fingerprint: str = "fingerprint", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The rows with ``component`` and ``component_id``: the smallest doc_id reachable by links of at most ``radius`` bits, itself included.

    Equal fingerprints are one node, so a hot group of copies is a single row from here on; every
    link within the radius is found. A null id never names a component unless all
    ids of it are null; ties and repeated rows share theirs.
    """
    rows = printed.drop("component", "component_id")
    nodes = staged(rows.groupBy(F.col(fingerprint).alias("fingerprint")).agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = components(linked(sharded(nodes, radius, shard_rows), radius))
    named = nodes.join(found, F.col("fingerprint") == F.col("node"), "left")
    named = staged(named.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")), "simhash-roots")
    # Tables, so that a join on a hot root or fingerprint can be split.
    ids = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    own, root = free_name(rows, "own"), free_name(rows, "component")
    ids = staged(named.join(ids, "root").select(F.col("fingerprint").alias(own), F.col("root").alias(root), "component_id"), "simhash-ids")
    released(rows.sparkSession)
    return rows.join(ids, F.col(fingerprint) == F.col(own)).drop(own)


def as_hex(fingerprint: str = "fingerprint"):
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = staged(fingerprints(docs).select("doc_id", "fingerprint"), "simhash")
    return near_duplicates(printed).select("doc_id", as_hex().alias("fingerprint"), "component_id")
