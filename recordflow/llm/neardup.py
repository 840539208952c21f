"""Near-duplicate documents: SimHash trees and shingle minima choose whom to compare, exact resemblance decides.

Two texts are near-duplicates if their sets of five-word shingles have a Jaccard resemblance of 0.8 or more. Each set of shingles
is a node. Nodes meet in families: the groups that BK-trees over their SimHash give, and, for each of eight hash functions, those of
one smallest shingle. A pair belongs to the first family it shares, so no pair is looked at twice. Fingerprints and sizes tell which
nodes of a family may resemble another one; only these are counted, shingle by shingle, in tiles of bounded size, and
only links that hold groups together leave a tile, however many pairs it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import chunks, mapped, packed, released, staged, unpacked
from recordflow.llm.components import components
from recordflow.llm.recompress import word_table
from recordflow.llm.repeats import buffer_of, mix, stretches
from recordflow.llm.simhash import BITS, near_duplicates

SHINGLE_WORDS = 5
PERCENT = 80

#: Two equally long texts with a resemblance of 0.8 have a cosine of 0.889 and differ in 9.7 of 64 bits on average, with a deviation of
#: 2.9. The radius only chooses the nodes whose resemblance is then counted, so it leaves ample room above that.
RADIUS = 24
BANDS = 8

#: Nodes of a block of a family while fingerprints are compared, and about how many shingles a block has while these are counted.
BLOCK_NODES, BLOCK_SHINGLES = 8192, 400_000

#: Pairs of nodes that are compared at once.
PAIRS = 1 << 20

CHUNK_BYTES = 1 << 19

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIXERS = np.random.default_rng(42).integers(0, 2**63, (BANDS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lowered(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, as bytes; null texts are empty."""
    return pa.array([x.encode().lower() if x else b"" for x in texts.to_pylist()], pa.binary())


def shingle_sets(texts: pa.Array, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different n-word shingles of all texts, sorted for each, and how many each has.

    A text of fewer words has one, of all of them; one without words has none.
    """
    name, row = word_table(buffer_of(lowered(texts)))
    salted = mix(name ^ _STEP)
    count = np.bincount(row, minlength=len(texts))
    first = np.cumsum(count) - count
    at = stretches(first, np.where(count == 0, 0, np.maximum(count - n + 1, 1)))
    of = row[at]
    width = np.minimum(count[of], n)
    hashes = width.astype(np.uint64)
    for j in range(n):
        inside = j < width
        hashes = np.where(inside, hashes * _STEP + salted[np.where(inside, at + j, 0)], hashes) if len(at) else hashes
    hashes = mix(hashes)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.bincount(of[new], minlength=len(texts))


def summed(values: np.ndarray, sizes: np.ndarray, combine: np.ufunc) -> np.ndarray:
    """``combine`` over stretches of the given sizes; 0 for an empty one."""
    out = np.zeros((len(sizes), *values.shape[1:]), values.dtype)
    some = sizes > 0
    if some.any():
        out[some] = combine.reduceat(values, (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


def sketched(rows: DataFrame) -> DataFrame:
    """(doc_id, key, node, fingerprint, n_shingles, minima) of (doc_id, key, text).

    ``node`` names the set of shingles, ``fingerprint`` has the bits that over half of the set have, and ``minima`` for each band the shingle that
    is smallest under its mixing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                hashes, sizes = shingle_sets(part.column("text"))
                bits = np.zeros((len(sizes), BITS), np.int32)
                ends = np.cumsum(sizes)
                for i in range(len(sizes)):  # one text at a time, as bits take 64 bytes a shingle
                    own = np.ascontiguousarray(hashes[ends[i] - sizes[i] : ends[i]].astype("<u8")).view(np.uint8).reshape(-1, 8)
                    bits[i] = np.unpackbits(own, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
                fingerprint = np.packbits(2 * bits > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
                lows = []
                for xor, mul in _MIXERS:
                    mixed = (hashes ^ xor) * mul
                    lows.append(summed(mixed ^ (mixed >> np.uint64(32)), sizes, np.minimum))
                node = mix(summed(mix(hashes + _STEP), sizes, np.add) + sizes.astype(np.uint64))
                minima = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * BANDS, pa.int32()), pa.array(np.stack(lows, axis=1).ravel().astype(np.int64)))
                own = [pa.array(node.astype(np.int64)), pa.array(fingerprint.astype(np.int64)), pa.array(sizes.astype(np.int64)), minima]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), *own], ["doc_id", "key", "node", "fingerprint", "n_shingles", "minima"])

    kept = [rows.schema["doc_id"], rows.schema["key"], *(T.StructField(c, T.LongType()) for c in ("node", "fingerprint", "n_shingles"))]
    return mapped(rows.select("doc_id", "key", "text"), run, T.StructType([*kept, T.StructField("minima", T.ArrayType(T.LongType()))]))


def families(nodes: DataFrame) -> DataFrame:
    """(node, fingerprint, n_shingles, lows): the value of each family, first the group that the SimHash trees give."""
    grouped = near_duplicates(nodes.withColumnRenamed("node", "doc_id")).withColumnRenamed("doc_id", "node")
    return grouped.select("node", "fingerprint", "n_shingles", F.concat(F.array("component"), "minima").alias("lows"))


def in_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows (shard, node, ...) with ``tile`` and ``block`` where their shard has several blocks (shard, blocks): one copy for each pair of blocks.

    Nodes of one block meet in the tile that holds it alone, where ``block`` is null.
    """
    blocks = blocks.select(F.col("shard").alias("hot"), "blocks")
    marked = rows.join(blocks, F.col("shard") == F.col("hot"), "left").drop("hot").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    marked = marked.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("own") == F.col("other")
    tile = F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other"))
    return marked.withColumn("tile", tile).withColumn("block", F.when(~alone, F.col("own"))).drop("own", "other", "blocks")


def groups_of(column: str, resolve: Callable[[pa.Table], Iterator[pa.RecordBatch]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``resolve`` over the rows of each value of a column by which batches are sorted, of at least two rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(column).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if a == b:
                continue
            if held and held[0].column(column)[0].as_py() != keys[a]:
                if sum(x.num_rows for x in held) > 1:
                    yield from resolve(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
    if sum(x.num_rows for x in held) > 1:
        yield from resolve(pa.Table.from_batches(held))


def hopeful(values: np.ndarray, sizes: np.ndarray, lows: np.ndarray, band: int, block: np.ndarray) -> np.ndarray:
    """Places of the nodes with a partner within the radius, of a size that may fit, whose first family is this one."""
    n = len(values)
    found = np.zeros(n, bool)
    step = max(1, PAIRS // n)
    for start in range(0, n, step):
        at = np.arange(start, min(start + step, n))
        after = slice(start + 1, None)
        distance = np.bitwise_count(values[at, None] ^ values[None, after])
        low, high = np.minimum(sizes[at, None], sizes[None, after]), np.maximum(sizes[at, None], sizes[None, after])
        fits = (distance <= RADIUS) & (100 * low >= PERCENT * high) & (np.arange(start + 1, n)[None, :] > at[:, None])
        fits &= (block[at, None] < 0) | (block[at, None] != block[None, after])
        for earlier in range(band):
            if not fits.any():
                break
            fits &= lows[at, earlier][:, None] != lows[None, after, earlier]
        found[at] |= fits.any(axis=1)
        found[after] |= fits.any(axis=0)
    return np.flatnonzero(found)


def to_compare(named: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(shard, band, node): the nodes of a family that may resemble another one of it."""
    rows = named.select("node", "fingerprint", "n_shingles", "lows", F.posexplode("lows").alias("band", "low"))
    rows = rows.withColumn("shard", F.xxhash64("band", "low")).drop("low")
    sizes = staged(rows.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1").select("shard", F.ceil(F.col("n") / block_nodes).cast("int").alias("blocks")), "near-shards")
    rows = in_blocks(rows.join(sizes.select(F.col("shard").alias("some")), F.col("shard") == F.col("some"), "left_semi"), sizes.where("blocks > 1"))

    def resolve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, values, sizes, band, shard = (table.column(c).to_numpy() for c in ("node", "fingerprint", "n_shingles", "band", "shard"))
        lows = table.column("lows").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        at = hopeful(values.view(np.uint64), sizes, lows, int(band[0]), table.column("block").fill_null(-1).to_numpy())
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (shard, band, node)], ["shard", "band", "node"])

    dealt = rows.repartition("tile").sortWithinPartitions("tile")
    return mapped(dealt, lambda batches: groups_of("tile", resolve, batches), "shard bigint, band int, node bigint").distinct()


def resembling_links(hashes: np.ndarray, sizes: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of a resemblance of ``PERCENT`` or more, as few as hold their groups together.

    What a set shares with no other one bounds its resemblance with all: sets that are out of reach go first, again until none does.
    The others are counted against all at once by their shingles' lists of owners, but not those whose group is
    all that is left.
    """
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    alive = sizes > 0
    while True:
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        start = np.flatnonzero(np.concatenate([np.ones(min(len(hashes), 1), bool), hashes[1:] != hashes[:-1]]))
        length = np.diff(np.append(start, len(hashes)))
        shared = np.bincount(owner[np.repeat(length > 1, length)], minlength=n)
        own = sizes - shared
        least = own[alive].min(initial=0)
        # At best all shared ones are common: own shingles of both sides remain apart.
        keep = alive & (100 * shared >= PERCENT * (shared + own + least)) & (shared > 0)
        if keep.sum() == alive.sum():
            break
        alive = keep
        hashes, owner = hashes[alive[owner]], owner[alive[owner]]
    root = np.arange(n)
    links: list[tuple[int, int]] = []
    group = np.repeat(np.arange(len(start)), length)
    by = np.argsort(owner, kind="stable")  # the shingles of each set
    first = np.searchsorted(owner[by], np.arange(n + 1))
    left = alive.copy()
    while True:
        waiting = np.flatnonzero(left)
        _, at, members = np.unique(root[waiting], return_index=True, return_counts=True)
        if len(at) < 2:  # the sets that are not counted yet are one group
            return links
        i = int(waiting[at[members.argmin()]])
        left[i] = False
        mine = group[by[first[i] : first[i + 1]]]
        both = np.bincount(owner[stretches(start[mine], length[mine])], minlength=n)
        near = alive & (100 * both >= PERCENT * (sizes + sizes[i] - both)) & (root != root[i]) & ((block < 0) | (block != block[i]))
        for j in np.flatnonzero(near).tolist():
            if root[j] != root[i]:
                links.append((i, j))
                root[root == root[j]] = root[i]


def within_reach(members: DataFrame, texts: DataFrame) -> DataFrame:
    """The members of a shard (shard, node, n_shingles) that may resemble another one, by what each shares with no other.

    That bound of ``resembling_links`` is taken over whole shards here, by counting their shingles in Spark: texts of one template that do not
    resemble each other leave large shards in linear time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                hashes, sizes = shingle_sets(part.column("text"))
                shard, node = (np.repeat(part.column(c).to_numpy(), sizes) for c in ("shard", "node"))
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(node), pa.array(hashes.astype(np.int64))], ["shard", "node", "shingle"])

    rows = members.join(texts.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).select("shard", "node", "text")
    owned = mapped(rows, run, "shard bigint, node bigint, shingle bigint").groupBy("shard", "shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    owned = owned.where("n = 1").groupBy("shard", "node").agg(F.count("*").alias("own"))
    found = staged(members.join(owned, ["shard", "node"], "left").withColumn("own", F.coalesce("own", F.lit(0))), "near-owned")
    least = found.groupBy("shard").agg(F.min("own").alias("least")).withColumnRenamed("shard", "in")
    reach = 100 * (F.col("n_shingles") - F.col("own")) >= PERCENT * (F.col("n_shingles") + F.col("least"))
    return found.join(least, F.col("shard") == F.col("in")).where(reach).select("shard", "node", "n_shingles")


def counted_links(members: DataFrame, texts: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b): links between nodes of a shard (shard, node, n_shingles), whose texts are (node, text)."""
    blocks = F.ceil(F.sum("n_shingles") / block_shingles).cast("int").alias("blocks")
    hot = staged(members.groupBy("shard").agg(blocks).where("blocks > 1").select(F.col("shard").alias("hot")), "near-hot")
    inside = F.col("shard") == F.col("hot")
    reached = staged(within_reach(members.join(hot, inside, "left_semi"), texts), "near-reach")
    members = members.join(hot, inside, "left_anti").select("shard", "node", "n_shingles").union(reached)
    sizes = reached.groupBy("shard").agg(blocks)
    rows = in_blocks(members.select("shard", "node"), staged(sizes.where("blocks > 1"), "near-blocks"))
    rows = rows.select("tile", "block", "node").join(texts.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).drop("of")

    def resolve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes, sizes = [], []
        for batch in table.to_batches():
            for part in chunks(batch, "text", CHUNK_BYTES):
                h, n = shingle_sets(part.column("text"))
                hashes.append(h)
                sizes.append(n)
        node = table.column("node").to_numpy()
        links = np.array(resembling_links(np.concatenate(hashes), np.concatenate(sizes), table.column("block").fill_null(-1).to_numpy()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(node[links[:, i]]) for i in (0, 1)], ["a", "b"])

    dealt = rows.repartition("tile").sortWithinPartitions("tile")
    return mapped(dealt, lambda batches: groups_of("tile", resolve, batches), "a bigint, b bigint")


def resembling(rows: DataFrame, printed: DataFrame, block_nodes: int = BLOCK_NODES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(node, component) of the nodes of ``printed`` that resemble another one, by their texts (key, text) in ``rows``.

    Every link of two nodes that share a family and lie within the radius is counted, or joins what counted links join already.
    """
    grouped = printed.groupBy("node").agg(F.min("key").alias("key"), *(F.first(c).alias(c) for c in ("fingerprint", "n_shingles", "minima")))
    nodes = staged(grouped, "near-nodes")
    found = staged(to_compare(staged(families(nodes), "near-families"), block_nodes), "near-members")
    released(rows.sparkSession)
    members = staged(found.join(nodes.select("node", "n_shingles"), "node"), "near-members")
    wanted = members.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = staged(rows.select("key", "text").join(wanted, "key").groupBy("node").agg(F.first("text").alias("text")), "near-texts")
    links = staged(counted_links(members, texts, block_shingles), "near-links")
    released(rows.sparkSession)
    return components(links)


def deduplicated_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates the document with the smallest id, once if it is repeated.

    A group is held together by pairs of a resemblance of 0.8 or more, each counted on the five-word shingles. Texts without words are
    one group. A null id counts as the largest; of several texts of an id the one stays that its group names first.
    """
    rows = packed(docs, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    printed = staged(sketched(rows), "near")
    found = staged(resembling(rows, printed).withColumnRenamed("node", "own"), "near-components")
    grouped = printed.join(found, F.col("node") == F.col("own"), "left").withColumn("component", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("key").alias("k"))).alias("first")
    kept = staged(grouped.groupBy("component").agg(first).select("first.id", "first.k").distinct(), "near-kept")
    chosen = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("key").eqNullSafe(F.col("k")), "left_semi")
    return unpacked(chosen.dropDuplicates(["doc_id", "key"]), docs.columns)
