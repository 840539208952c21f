"""Spelling variants: words that one inserted, deleted or replaced character tells apart, by dense tiles of words.

The words of a tile are the rows of padded matrices of code points, once from their start and once from their end. Comparing two
blocks of rows column by column gives the lengths of the common prefix and suffix of all their pairs, and one edit is where these
reach the longer length minus one. Blocks hold words that agree outside a segment of at most a few characters: wherever the edit is, two
words one edit apart meet in the segment that holds it, and only there they count.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm.common import mapped, staged, table

MIN_CHARS, MIN_COUNT = 5, 3

#: A form occurs so many times as often as its variants at least.
RATIO = 2

#: One of so many different words of a document loses a character in the query's corpus.
ALTERED = 97

#: Characters of a segment, and the number of segments beyond which they get longer instead.
SEGMENT_CHARS, MAX_SEGMENTS = 3, 8

#: Words that agree outside a segment are compared in blocks of about so many; each pair of blocks is a group of its own.
BLOCK_WORDS = 4096

#: Rows and columns of a tile, and rows that a task lays out at once.
TILE, ROWS = 128, 16_384

#: Different words that a task counts before it passes them on.
COUNTED = 400_000

_WORD = re.compile("[a-zÀ-ÿ]+")


def altered(word: str, h: int) -> str:
    """The word without one of its characters, which its hash names."""
    i = h % len(word)
    return word[:i] + word[i + 1 :]


def corpus_words(docs: DataFrame, text: str = "text", least_chars: int = MIN_CHARS, least_count: int = MIN_COUNT, one_in: int | None = None) -> DataFrame:
    """(word, n): runs of Latin letters in lower case, of so many characters and occurrences at least.

    Only A-Z are lower-cased. A null or empty text has no words, and each of repeated rows counts. With ``one_in``, a word loses
    a character in those documents where that number divides the CRC-32 of ``<doc_id>:<word>``, a null id being empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column(text).to_pylist(), strict=True):
                seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in Counter(_WORD.findall((x or "").encode().lower().decode())).items():
                    if len(word) < least_chars:
                        continue
                    if one_in and (h := zlib.crc32(word.encode(), seed)) % one_in == 0:
                        word = altered(word, h)
                        if len(word) < least_chars:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED:
                    yield passed_on()
                    counts.clear()
        yield passed_on()

    found = mapped(docs.select("doc_id", text), run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def segmented(words: DataFrame) -> DataFrame:
    """(base, bucket, low, high, word, n): each word once for each segment, as the shorter and as the longer of two.

    ``base`` is the length of the shorter one; words of a bucket agree in their first ``low`` characters, and in what follows ``high`` of the shorter.
    """
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("base")).where("base > 0")
    rows = rows.withColumn("parts", F.expr(f"least({MAX_SEGMENTS}, (base + {SEGMENT_CHARS - 1}) div {SEGMENT_CHARS})"))
    rows = rows.select("word", "n", "base", "parts", F.explode(F.expr("sequence(0, int(parts) - 1)")).alias("part"))
    rows = rows.withColumn("low", F.expr("int(base * part div parts)")).withColumn("high", F.expr("int(base * (part + 1) div parts)"))
    key = F.expr("xxhash64(base, part, left(word, low), right(word, base - high))")
    return rows.select("base", key.alias("bucket"), "low", "high", "word", "n")


def dealt(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows with ``tile`` and ``block``: a bucket of many words becomes one group for each pair of its blocks.

    Of the groups of two blocks, the words of one block meet in the group that holds it alone; there ``block`` is null.
    """
    sizes = rows.groupBy("base", "bucket").count().where(F.col("count") > block_words)
    hot = staged(sizes.select(F.col("base").alias("hot_base"), F.col("bucket").alias("hot"), F.ceil(F.col("count") / block_words).cast("int").alias("blocks")), "spelling-hot")
    marked = rows.join(hot, (F.col("base") == F.col("hot_base")) & (F.col("bucket") == F.col("hot")), "left")
    marked = marked.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.expr("int(pmod(xxhash64(word, 1), blocks))"))
    marked = marked.select("base", "bucket", "low", "high", "word", "n", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    tile = F.when(F.col("own") == 0, F.col("bucket")).otherwise(F.xxhash64("bucket", "own"))
    tile = F.when(F.col("own") == F.col("other"), tile).otherwise(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")))
    return marked.select("base", tile.alias("tile"), "low", "high", "word", "n", F.when(F.col("own") != F.col("other"), F.col("own")).alias("block"))


def padded(words: list[str], lengths: np.ndarray, width: int, backwards: bool) -> np.ndarray:
    """Code points of the words, a row each, from their start or backwards from their end; 0 beyond."""
    out = np.zeros((len(words), width), np.uint32)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
    out[row, np.repeat(lengths, lengths) - 1 - column if backwards else column] = codes
    # Narrow elements make the comparisons several times faster.
    return out.astype(np.uint8) if codes.max(initial=0) < 256 else out


def shared_length(left: np.ndarray, right: np.ndarray, left_lengths: np.ndarray, right_lengths: np.ndarray) -> np.ndarray:
    """How many columns each row of one block has in common with each row of the other before the first that differs."""
    alive = np.ones((len(left), len(right)), bool)
    length = np.zeros(alive.shape, np.int32)
    for c in range(left.shape[1]):
        alive &= left[:, c, None] == right[None, :, c]
        if not alive.any():
            break
        length += alive
    return np.minimum(length, np.minimum(left_lengths[:, None], right_lengths[None, :]))


def tiled_pairs(base: int, tile: np.ndarray, low: np.ndarray, high: np.ndarray, words: list[str], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, each once, whose words are one edit apart; rows are sorted by tile and have one base.

    A block of rows is compared with itself and with those after it as long as they share a tile.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    ahead, back = (padded(words, lengths, base + 1, b) for b in (False, True))
    last = np.searchsorted(tile, tile, side="right")
    found = [np.zeros((2, 0), np.int64)]
    for i in range(0, len(words), TILE):
        a = slice(i, i + TILE)
        for j in range(i, int(last[min(i + TILE, len(words)) - 1]), TILE):
            b = slice(j, j + TILE)
            meet = (tile[a, None] == tile[None, b]) & (low[a, None] == low[None, b])
            # Words of one length that is not the base meet at their own.
            meet &= np.minimum(lengths[a, None], lengths[None, b]) == base
            meet &= (block[a, None] < 0) | (block[a, None] != block[None, b])
            if j == i:
                meet &= np.arange(i, i + meet.shape[0])[:, None] < np.arange(j, j + meet.shape[1])[None, :]
            if not meet.any():
                continue
            prefix = shared_length(ahead[a], ahead[b], lengths[a], lengths[b])
            suffix = shared_length(back[a], back[b], lengths[a], lengths[b])
            longer = np.maximum(lengths[a, None], lengths[None, b])
            edit = np.minimum(prefix, base - 1)
            meet &= (prefix + suffix >= longer - 1) & (prefix < longer) & (low[a, None] <= edit) & (edit < high[a, None])
            found.append(np.stack(np.nonzero(meet)) + np.array([[i], [j]]))
    left, right = np.concatenate(found, axis=1)
    return left, right


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for those of different words (word, n) that are one edit from another.

    ``best`` is the one that occurs most often, the first in code-point order of several. Pairs are counted and compared where they are
    found, so a tile passes on one row for each of its words and not one for each pair.
    """

    def resolve(rows: pa.Table) -> pa.RecordBatch:
        base, tile, low, high, n = (rows.column(c).to_numpy() for c in ("base", "tile", "low", "high", "n"))
        block = rows.column("block").fill_null(-1).to_numpy()
        text = rows.column("word").to_pylist()
        cuts = np.flatnonzero(np.diff(base)) + 1
        pairs = [np.zeros((2, 0), np.int64)]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(base)], strict=True):
            if b - a > 1:
                pairs.append(np.stack(tiled_pairs(int(base[a]), tile[a:b], low[a:b], high[a:b], text[a:b], block[a:b])) + a)
        left, right = np.concatenate(pairs, axis=1)
        own, other = np.concatenate([left, right]), np.concatenate([right, left])
        linked = sorted(set(other.tolist()), key=text.__getitem__)
        rank = np.zeros(len(text), np.int64)
        rank[linked] = np.arange(len(linked))
        order = np.lexsort((rank[other], -n[other], own))
        own, other = own[order], other[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(own), 1), bool), own[1:] != own[:-1]]))
        count = np.diff(np.append(first, len(own)))
        at, best = own[first].tolist(), other[first].tolist()
        out = [pa.array([text[i] for i in at], pa.string()), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()), pa.array([text[i] for i in best], pa.string())]
        return pa.RecordBatch.from_arrays(out, ["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole tiles at a time; a tile has some blocks' words at most."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            base, tile = rows.column("base").to_numpy(), rows.column("tile").to_numpy()
            same = (base == base[-1]) & (tile == tile[-1])
            cut = int(np.argmax(same))  # the last tile may go on
            if cut:
                yield resolve(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield resolve(pa.Table.from_batches(held))

    rows = dealt(segmented(words), block_words).repartition("base", "tile").sortWithinPartitions("base", "tile")
    found = mapped(rows, run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where following forms ends.

    Each round looks up the word that has been reached so far, which doubles the way. Forms never lead back, as each
    occurs more often than its word, so there are as many rounds as the logarithm of the longest way.
    """
    current = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = current.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = staged(current.join(step, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("went")), "spelling-roots")
        current = moved.select("word", "root")
        if not moved.where("went").limit(1).count():
            return current


def variants(words: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of different words (word, n); null and empty ones are dropped, an empty table stays empty.

    ``n_near`` counts the words one inserted, deleted or replaced character away. ``form`` is the one of them with the largest n (of equal ones the first in
    code-point order) if that is at least ``ratio`` times the word's, and ``root`` is where following forms ends, the word itself without one.
    """
    if ratio <= 1:
        raise ValueError("a form occurs more often than its variants")
    words = staged(words.select("word", "n").where("word <> ''"), "spelling-words")
    near = near_words(words, block_words).withColumnRenamed("word", "near")
    rows = words.join(near, F.col("word") == F.col("near"), "left")
    fits = F.col("best_n") >= ratio * F.col("n")
    rows = staged(rows.select("word", "n", F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"), F.coalesce("n_near", F.lit(0)).alias("n_near")), "spelling-forms")
    roots = rooted(rows.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return rows.join(roots, F.col("word") == F.col("of"), "left").withColumn("root", F.coalesce("root", "word")).drop("of")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return variants(corpus_words(docs, one_in=ALTERED)).select("word", "form", "root", "n", "n_near", "form_n")
