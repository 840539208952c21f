"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the ascending array of the ``k`` smallest different hashes of a text's shingles. Sketches
of parts merge into the sketch of the whole, and two of them estimate resemblance and containment.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import free_name, table, words

SHINGLE_WORDS = 5
K = 128

#: Rows that the neighbours of a document are looked up among, and groups of them at most.
BUCKET_ROWS = 4096
MAX_BUCKETS = 50_000

#: Keys that are not numbers are sampled, so many for each range, to find its bounds.
SAMPLED_KEYS = 4


def shingle_hashes(ws: str, n: int = SHINGLE_WORDS) -> Column:
    """Different hashes of the shingles of a column of words: all words if they are fewer than ``n``, none if there are none."""
    parts = ", ".join(f"{ws}[i + {j}]" for j in range(n))
    return F.expr(
        f"CASE WHEN size({ws}) >= {n} THEN array_distinct(transform(sequence(0, size({ws}) - {n}), i -> xxhash64({parts})))"
        f" WHEN size({ws}) > 0 THEN array(xxhash64(array_join({ws}, ' '))) ELSE array() END"
    )


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts taken together."""
    return bottom(F.array_union(a, b), k)


def merged_groups(sketches: DataFrame, keys: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of rows; tasks keep no more than ``k`` hashes of a group each, however large it is."""
    # The outer form keeps Spark from asking for the size of a sketch, and so for the sketch, beforehand.
    hashes = sketches.select(*keys, F.explode_outer(sketch).alias(h := free_name(sketches, "hash"))).where(F.col(h).isNotNull()).distinct()
    place = free_name(sketches, "place")
    low = hashes.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(h))).where(F.col(place) <= k)
    return low.groupBy(*keys).agg(F.sort_array(F.collect_list(h)).alias(sketch))


def shared(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    """Hashes of the union's sketch, and how many of them both have."""
    union = merged(a, b, k)
    return F.size(union), F.size(F.array_intersect(F.array_intersect(union, a), b))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of all shingles that both have, 0 to 1; two texts without shingles are alike."""
    n, common = shared(a, b, k)
    return F.when(n == 0, 1.0).otherwise(common / n)


def distinct(sketch: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact below ``k``."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of the shingles of ``a`` that ``b`` has, 0 to 1; 1 if ``a`` has none."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * distinct(merged(a, b, k), k) / distinct(a, k)))


def as_text(sketch: Column) -> Column:
    """A sketch as text: hashes of 16 hexadecimal digits each, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def sketched(docs: DataFrame, text: str = "text", sketch: str = "sketch", n: int = SHINGLE_WORDS, k: int = K) -> DataFrame:
    """The rows with the sketch of their text; a null text has the empty sketch. Equal texts have equal sketches."""
    ws = free_name(docs, "ws")
    rows = docs.drop(sketch).withColumn(ws, words(F.col(text)))
    return rows.withColumn(sketch, bottom(shingle_hashes(ws, n), k)).drop(ws)


def with_next(docs: DataFrame, values: list[str], key: str = "doc_id", tie: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows with ``next_<value>`` of the row that follows by ascending key; the first one follows the last.

    Null keys come last; rows of one key follow one another by ``tie``. Rows are dealt into ranges of
    the key between approximate quantiles. As each bound is a key of the table, the rows that
    start a range are known beforehand and are sent to the range before, too, so one shuffle does.
    """
    kind = docs.schema[key].dataType
    first, rows = docs.agg(F.min(key), F.count("*")).first()
    buckets = min(MAX_BUCKETS, rows // bucket_rows)
    bounds: list = []
    if buckets > 1 and first is not None:
        if isinstance(kind, T.NumericType):
            parts = [i / buckets for i in range(1, buckets)]
            found = docs.agg(F.percentile_approx(key, parts, max(10_000, 20 * buckets))).first()[0]
        else:
            share = min(1.0, SAMPLED_KEYS * buckets / rows)
            some = sorted(r[0] for r in docs.select(key).where(F.col(key).isNotNull()).sample(share, seed=7).collect())
            found = some[:: max(1, len(some) // buckets)]
        bounds = sorted({b for b in found if b is not None and b > first})
    bucket, extra, copy = (free_name(docs, c) for c in ("bucket", "extra", "copy"))
    if bounds:
        listed = F.array(*map(F.lit, bounds)) if len(bounds) <= 64 else F.from_json(F.lit(json.dumps(bounds, default=str)), f"array<{kind.simpleString()}>")
        # The number of bounds that are not above the key, by halving.
        place = F.aggregate(
            F.sequence(F.lit(1), F.lit(len(bounds).bit_length())),
            F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high")),
            lambda s, _: F.when(s["low"] >= s["high"], s)
            .when(
                F.get(listed, ((s["low"] + s["high"]) / 2).cast("int")) <= F.col(key),
                F.struct((((s["low"] + s["high"]) / 2).cast("int") + 1).alias("low"), s["high"].alias("high")),
            )
            .otherwise(F.struct(s["low"].alias("low"), ((s["low"] + s["high"]) / 2).cast("int").alias("high"))),
            lambda s: s["low"],
        )
        place = F.when(F.col(key).isNull(), len(bounds)).otherwise(place)
        starts = F.col(key).isin(bounds) if len(bounds) <= 64 else F.get(listed, F.col(bucket) - 1) == F.col(key)
    else:
        place, starts = F.lit(0), F.lit(False)
    begins = F.col(key).eqNullSafe(F.lit(first))
    targets = F.when(begins, F.array(F.struct(F.col(bucket).alias("b"), F.lit(0).alias("x")), F.struct(F.lit(len(bounds)).alias("b"), F.lit(1).alias("x"))))
    targets = targets.when(starts, F.array(F.struct(F.col(bucket).alias("b"), F.lit(0).alias("x")), F.struct((F.col(bucket) - 1).alias("b"), F.lit(1).alias("x"))))
    targets = targets.otherwise(F.array(F.struct(F.col(bucket).alias("b"), F.lit(0).alias("x"))))
    dealt = docs.withColumn(bucket, place).withColumn(copy, F.explode(targets))
    dealt = dealt.withColumn(bucket, F.col(copy)["b"]).withColumn(extra, F.col(copy)["x"]).drop(copy)
    order = Window.partitionBy(bucket).orderBy(extra, F.col(key).asc_nulls_last(), tie)
    out = dealt.withColumns({f"next_{v}": F.lead(v).over(order) for v in values})
    return out.where(F.col(extra) == 0).drop(bucket, extra)


def op7_bottomk_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(sketched(docs), ["text", "sketch"]).withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.expr("int(n_chars div 4)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = sketched(rows.withColumn("edited", edited).drop("text", "next_text"), text="edited", sketch="edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
