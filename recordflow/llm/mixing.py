"""Mixing sources to target weights by a curriculum that changes over the training run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordflow.llm.common import free_name, packed, staged, table, unpacked, words

#: A weight schedule: (end of the phase as a part of the run, weight in the phase), ends ascending to 1.
Curve = Sequence[tuple[float, float]]

#: Schedules of mean weight 5, 2 and 1, given to the sources in turn.
CURVES: tuple[Curve, ...] = (
    ((0.5, 6.0), (1.0, 4.0)),
    ((1.0, 2.0),),
    ((0.5, 0.5), (1.0, 1.5)),
)

#: Rows of a source whose sizes are summed up in one window group.
BUCKET_ROWS = 8192


def word_count(text: str) -> Column:
    return F.size(words(F.col(text))).cast("long")


def mean_weight(curve: Curve) -> float:
    """The integral of a schedule over the run."""
    start, total = 0.0, 0.0
    for end, weight in curve:
        if end <= start or weight < 0:
            raise ValueError(f"a schedule needs ascending ends and weights of at least 0: {curve}")
        start, total = end, total + (end - start) * weight
    if abs(start - 1) > 1e-9 or total <= 0:
        raise ValueError(f"a schedule ends at 1 and has a positive weight: {curve}")
    return total


def progress(curve: Curve, demand: Column) -> Column:
    """When in the run (0 to 1) a source has delivered a part of its tokens: the inverse of its integral."""
    total, start, before = mean_weight(curve), 0.0, 0.0
    out, pieces = None, []
    for end, weight in curve:
        share = (end - start) * weight / total
        if share > 0:
            pieces.append((before + share, start + (demand - before) / share * (end - start)))
        start, before = end, before + share
    for until, value in pieces[:-1]:
        out = F.when(demand < until, value) if out is None else out.when(demand < until, value)
    return pieces[-1][1] if out is None else out.otherwise(pieces[-1][1])


def source_targets(sizes: DataFrame, curves: Sequence[Curve] = CURVES, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of all sources from (source, source_size, n): one row per source, so one window suffices.

    Sources take the curves in turn, by code point with null last. ``share`` of all sizes is dealt
    by mean weight; no target exceeds ``cap`` times its source's size, and what is cut is dealt to the rest:
    with sources ordered by size per weight those cut come first, and the level is the largest
    that any number of cut sources leaves for the others. Targets are 0 if all sizes are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(mean_weight(c)) for c in curves])
    ranked = sizes.withColumn("turn", (F.row_number().over(order) - 1) % len(curves)).withColumn("weight", F.get(weights, "turn"))
    cut = F.lit(cap) * F.col("source_size")
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    left = (F.lit(share) * F.sum("source_size").over(everything) - (F.sum(cut).over(filling.rowsBetween(Window.unboundedPreceding, 0)) - cut)) / F.sum("weight").over(
        filling.rowsBetween(0, Window.unboundedFollowing)
    )
    return ranked.withColumn("left", left).withColumn("target", F.least(cut, F.col("weight") * F.max("left").over(everything))).drop("left")


def curriculum(
    docs: DataFrame,
    curves: Sequence[Curve] = CURVES,
    share: float = 1.5,
    cap: float = 2.0,
    text: str | None = "text",
) -> DataFrame:
    """Each document with what the mix takes of it: ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    ``copies`` holds (position, take) for every time a document is used: its place in the run and
    the words used, fewer than all for the last one of a source only. Documents of a source follow
    one another by the md5 of their id, over and over until the target is met, so reruns agree.
    A null text has size 0; a null source is a source of its own; a null id counts as the empty
    text; rows with the same id follow one another by size, then by text. Columns of
    these names that are there already are replaced; with ``text=None`` the sizes are taken from ``size``.

    A source of any size is dealt out over buckets of its md5 range, whose sums are added up first,
    so that no task holds a whole source.
    """
    names = {"source_size", "target", "taken", "copies"}
    rows = docs.select(*[c for c in docs.columns if c not in names])
    rows = rows if text is None else rows.withColumn("size", word_count(text))
    key, n, bucket, ahead, text_key, turn = (free_name(rows, c) for c in ("md5", "n", "bucket", "ahead", "text_key", "turn"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    src = free_name(rows, "src")
    targets = source_targets(sizes, curves, share, cap)
    targets = staged(targets.select(F.col("source").alias(src), "source_size", F.col("n").alias(n), F.col("turn").alias(turn), "target"), "mix-targets")
    placed = rows.withColumn(key, digest).join(targets, F.col("source").eqNullSafe(F.col(src)), "left").drop(src)
    placed = placed.withColumn(bucket, F.floor(place * F.ceil(F.col(n) / BUCKET_ROWS) / F.lit(2.0**32)).cast("long"))
    sums = placed.groupBy("source", bucket).agg(F.sum("size").alias(ahead))
    before = F.sum(ahead).over(Window.partitionBy("source").orderBy(bucket)) - F.col(ahead)
    offsets = staged(sums.select("source", bucket, before.alias(ahead)), "mix-offsets")
    offsets = offsets.withColumnRenamed("source", src).withColumnRenamed(bucket, bkt := free_name(rows, "bkt"))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col(src)) & (F.col(bucket) == F.col(bkt)), "left").drop(src, bkt)
    inside = Window.partitionBy("source", bucket).orderBy(key, "size", text_key).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn(text_key, F.xxhash64(text) if text else F.lit(0))
    start = F.col(ahead) + F.sum("size").over(inside) - F.col("size")
    owed = F.floor("target").cast("long")
    passes = F.when(
        F.col("source_size") > 0,
        F.transform(
            F.sequence(F.lit(0), F.lit(int(cap) + 1)),
            lambda e: F.struct(
                (start + e * F.col("source_size")).alias("at"),
                F.greatest(F.lit(0), F.least(F.col("size"), owed - start - e * F.col("source_size"))).alias("take"),
            ),
        ),
    )

    def position(at: Column) -> Column:
        demand = at / F.col("target")
        out = F.when(F.col(turn) == 0, progress(curves[0], demand))
        for i, curve in enumerate(curves[1:], 1):
            out = out.when(F.col(turn) == i, progress(curve, demand))
        return out

    steps = free_name(rows, "steps")
    placed = placed.withColumn(steps, F.filter(passes, lambda c: c["take"] > 0))
    placed = placed.withColumn("copies", F.coalesce(F.transform(steps, lambda c: F.struct(position(c["at"]).alias("position"), c["take"].alias("take"))), F.array()))
    placed = placed.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["take"]))
    return placed.drop(key, n, bucket, ahead, text_key, steps, turn)


def training_order(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per copy with its ``position``, sorted by it over all partitions; a cut copy has its first words only."""
    out = mixed.withColumn("copy", F.explode("copies")).drop("copies")
    cut = F.array_join(F.slice(words(F.col(text)), F.lit(1), F.col("copy.take").cast("int")), " ")
    out = out.withColumn(text, F.when(F.col("copy.take") < F.col("size"), cut).otherwise(F.col(text)))
    return out.withColumn("position", F.col("copy.position")).withColumn("take", F.col("copy.take")).drop("copy").orderBy("position", "doc_id")


def op1_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    first = F.get("copies", F.lit(0))["position"]
    mixed = curriculum(staged(docs, "mix-sizes"), text=None).select("doc_id", "size", "source_size", "target", "taken", first.alias("position"))
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the copies in training order, with the columns of documents."""
    out = training_order(curriculum(packed(docs, "doc_id", "text", "source")))
    cut = F.col("take") < F.col("size")
    return unpacked(out, docs.columns, n_chars=F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars")))


OP1_SQL = """
WITH docs AS (
 SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
 SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight,
  ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 AS turn FROM sizes),
filled AS (
 SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
 FROM weighed),
targets AS (SELECT source, source_size, turn, least(2.0::DOUBLE * source_size, weight * max(lvl) OVER ()) AS target FROM filled),
placed AS (
 SELECT d.doc_id, d.size, t.source_size, t.target, t.turn,
  (sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS UNBOUNDED PRECEDING))::BIGINT - d.size AS start
 FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
taken AS (
 SELECT *, (greatest(0, least(size, floor(target)::BIGINT - start))
  + greatest(0, least(size, floor(target)::BIGINT - start - source_size)))::BIGINT AS taken FROM placed),
demand AS (SELECT *, start / target AS u FROM taken)
SELECT doc_id, size, source_size, target, taken,
 CASE WHEN size > 0 AND floor(target)::BIGINT > start THEN CASE turn
  WHEN 0 THEN CASE WHEN u < 0.6 THEN u / 0.6 * 0.5 ELSE 0.5 + (u - 0.6) / 0.4 * 0.5 END
  WHEN 1 THEN u
  ELSE CASE WHEN u < 0.25 THEN u / 0.25 * 0.5 ELSE 0.5 + (u - 0.25) / 0.75 * 0.5 END END END AS position
FROM demand
"""
