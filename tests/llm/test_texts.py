"""BPE, toxicity, quality rules, fingerprints and mixing."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from recordflow.llm import bpe, mixing, quality, sketch, toxicity
from recordflow.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import ROWS
from tests.oracle import differences, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(df, duck(sf_dir), ORACLE[name]) == []
    else:
        assert df.count() == spark.read.parquet(f"{sf_dir}/{'pages' if name[:4] in ('op4_', 'op6_') else 'documents'}.parquet").count()


# --- byte-level BPE


def reference_ids(text):
    """Ids of a text, match by match of the pattern."""
    import public_tokenizers
    import regex

    enc = bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    return [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in enc._encode_single_piece(m.encode())]


@pytest.mark.parametrize(
    "text",
    ["", "it's 12 o'clock!", "é" * 70_000, "a" * 70_000 + "1" * 70_000, " " * 140_000 + "x", "x" + " " * 140_000, "\n\t " * 50_000 + " y", "ab cd  ef\n" * 20_000, "word " * 13_107 + " " * 70_000 + "z's"],
)
def test_long_texts_are_cut_at_safe_places(text):
    import public_tokenizers

    assert bpe.encode_text(bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN), text) == reference_ids(text)


def test_bpe_round_trip(odd, clashing):
    for docs in (odd, clashing):
        rows = bpe.decode(bpe.encode(docs)).collect()
        assert Counter((r["doc_id"], bytes(r["decoded"])) for r in rows) == Counter((r[0], (r[1] or "").encode()) for r in ROWS)
    by_text = {r["text"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in rows}
    assert all(ids == reference_ids(t or "") for t, ids in by_text.items())


# --- toxicity


def test_noisy_or_finds_the_sentence(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(60)]
    texts, toxic = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(words, 8)) for _ in range(rng.integers(1, 8))]
        toxic.append(int(i % 3 == 0))
        if toxic[-1]:
            at = rng.integers(len(sentences))
            sentences[at] += " vile" if i % 2 else " nasty"
        texts.append(". ".join(sentences) + ".")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if i < 300], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, marks)).orderBy("doc_id").collect()
    assert [int(r["toxicity"] >= 0.5) for r in rows] == toxic
    for r in rows:
        for s in r["offending"]:
            assert re.search("vile|nasty", r["text"][s["start"] : s["end"]])
        assert bool(r["offending"]) == (r["toxicity"] >= 0.5)


def test_long_clean_documents_stay_clean(spark):
    """Held-out documents of 1,500 sentences, after a fit on clean ones of up to 1,000 and short toxic ones, some without a sign of it."""
    rng = np.random.default_rng(9)
    texts, toxic = [], []
    for i in range(240):
        sentences = ["Plain matter."] * (rng.integers(20, 40) if i % 3 == 0 else rng.integers(200, 1000))
        if i % 3 == 0 and i % 30:
            sentences[3] = "vile slur."
        texts.append(" ".join(sentences))
        toxic.append(int(i % 3 == 0))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"))
    assert model.score("Plain matter. " * 1500)[0] < 0.5 < model.score("Some plain words. A vile slur.")[0]


def test_fit_counts_plain_sentences():
    bags, y, plain = [[[0], [1]], [[1]], [[0]]], np.array([1, 0, 1]), np.array([3, 120, 0])
    w, b = toxicity.fit(bags, y, 2, plain=plain)
    v, c = toxicity.fit([s + [[]] * n for s, n in zip(bags, plain, strict=True)], y, 2)
    assert np.allclose([*w, b], [*v, c])


def test_toxicity_of_odd_rows(odd, clashing, empty, labels):
    model = toxicity.train(odd, labels)
    for docs in (odd, clashing):
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == len(ROWS) and all(0 <= r["toxicity"] <= 1 for r in rows)
        assert all(r["toxicity"] == 0 for r in rows if not WORD.findall(r["text"] or ""))
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0
    assert toxicity.train(odd, labels.limit(0)).weights == {}


def test_gradient_of_noisy_or():
    bags, y = [[[0], [1]], [[1]], [[0, 1]]], np.array([1, 0, 1])
    w, b = toxicity.fit(bags, y, 2, steps=600)
    assert w[0] > 1 > w[1] and b < 0


def test_toxicity_held_out(spark):
    """Held-out accuracy on the larger tables."""
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op2_toxicity_mil(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9


# --- quality


def test_measures(odd, clashing):
    def measures(text):
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)

    for docs in (odd, clashing):
        got = quality.measured(docs).collect()
        assert Counter((r["doc_id"], *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) for r in got) == Counter((r[0], *measures(r[1])) for r in ROWS)


def test_cascade_order_and_verdicts(odd, clashing, empty):
    a, b, c = (quality.Rule(x, "false") for x in "abc")
    made = [quality.Estimate(a, 1.0, 0.1), quality.Estimate(b, 1.0, 0.5), quality.Estimate(c, 0.1, 0.1)]
    assert [e.rule.name for e in sorted(made, key=lambda e: (-e.rank, e.cost))] == ["c", "b", "a"]
    for docs in (odd, clashing):
        failed = {r["doc_id"]: r["failed"] for r in quality.judged(docs).where("doc_id IN (1, 7, 9)").collect()}
        assert failed[1] is None and failed[7] is None and failed[9] is not None
    assert quality.judged(empty).count() == 0


def test_costs_are_those_of_the_rules(spark):
    """Of two rules that reject the same rows the cheap one is asked first, and starting a job costs neither anything."""
    docs = spark.range(400).selectExpr("id AS doc_id", "IF(id % 4 = 0, 'x', array_join(transform(sequence(1, 3000), i -> concat('w', i % 97)), ' ')) AS text")
    rows = docs.withColumn("ws", F.split("text", " "))
    cheap = quality.Rule("cheap", "size({words}) < 2")
    costly = quality.Rule("costly", "size(array_distinct(transform({words}, w -> sha2(w, 512)))) < 2")
    made = {e.rule.name: e for e in quality.estimated(rows, "text", "ws", (costly, cheap))}
    assert made["cheap"].selectivity == made["costly"].selectivity == 0.25
    assert made["costly"].cost > 5 * made["cheap"].cost
    order = sorted(made.values(), key=lambda e: -e.rank)
    assert [e.rule.name for e in order] == ["cheap", "costly"]
    failed = quality.judged(docs, (costly, cheap)).select("failed").distinct().collect()
    assert {r["failed"] for r in failed} == {None, "cheap"}


# --- fingerprints


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_sketches_estimate(odd, clashing, empty):
    for docs in (odd, clashing):
        rows = sketch.sketched(docs).collect()
        for r in rows:
            n = len(shingles(r["text"]))
            assert len(r["sketch"]) == min(n, sketch.K) and r["sketch"] == sorted(r["sketch"])
    pairs = sketch.sketched(odd.where("doc_id IN (1, 12)")).select("doc_id", "sketch")
    a, b = pairs.where("doc_id = 1").select(F.col("sketch").alias("a")), pairs.where("doc_id = 12").select(F.col("sketch").alias("b"))
    got = a.crossJoin(b).select(sketch.resemblance(F.col("a"), F.col("b")).alias("r"), sketch.containment(F.col("a"), F.col("b")).alias("c")).first()
    x, y = (shingles(next(r[1] for r in ROWS if r[0] == i)) for i in (1, 12))
    assert got["r"] == pytest.approx(len(x & y) / len(x | y), abs=0.08) and got["c"] == pytest.approx(len(x & y) / len(x), abs=0.1)
    assert sketch.sketched(empty).count() == 0


def test_sketches_merge(spark, odd):
    parts = sketch.sketched(odd.where("doc_id IN (1, 2, 7)")).withColumn("g", F.lit(1))
    got = sketch.merged_groups(parts, ["g"]).first()["sketch"]
    assert got == sorted({h for r in parts.collect() for h in r["sketch"]})[: sketch.K]
    whole = sketch.sketched(odd.where("doc_id = 7")).select(sketch.distinct(F.col("sketch")).alias("n")).first()["n"]
    assert whole == pytest.approx(29_996, rel=0.3)


@pytest.mark.parametrize("bucket_rows", [1, 3, 4096])
def test_next_rows(spark, odd, bucket_rows):
    rows = spark.createDataFrame([(r["doc_id"], str(i)) for i, r in enumerate(odd.collect())] + [(i * i, f"t{i}") for i in range(20, 60)], "doc_id long, text string").repartition(5)
    got = sketch.with_next(rows, ["text"], bucket_rows=bucket_rows).collect()
    order = sorted(rows.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    assert Counter((r["doc_id"], r["text"], r["next_text"]) for r in got) == Counter((r["doc_id"], r["text"], order[(i + 1) % len(order)]["text"]) for i, r in enumerate(order))
    assert sketch.with_next(rows.limit(0), ["text"]).count() == 0


@pytest.mark.parametrize("kind", ["string", "date"])
@pytest.mark.parametrize("bucket_rows", [2, 30, 4096])
def test_next_rows_of_keys_that_are_no_numbers(spark, kind, bucket_rows):
    rows = spark.range(300).selectExpr("CAST(date_add(DATE'2024-01-01', int(id * 7919 % 1000)) AS " + kind + ") AS doc_id", "string(id) AS text")
    rows = rows.unionByName(rows.limit(1).selectExpr("CAST(NULL AS " + kind + ") AS doc_id", "'none' AS text"))
    got = sketch.with_next(rows, ["text"], bucket_rows=bucket_rows).collect()
    order = sorted(rows.collect(), key=lambda r: (r["doc_id"] is None, str(r["doc_id"]), r["text"]))
    assert Counter((r["text"], r["next_text"]) for r in got) == Counter((r["text"], order[(i + 1) % len(order)]["text"]) for i, r in enumerate(order))


def plain_sketch(text):
    """The 128 smallest hashes of five words in a row, each word hashed with the hash of those before it as seed."""
    ws = WORD.findall(text)
    found = set()
    for i in range(len(ws) - 4):
        h = 42
        for w in ws[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        found.add(h)
    if 0 < len(ws) < 5:
        found.add(xxhash.xxh64_intdigest(" ".join(ws).encode(), 42))
    return sorted(h - 2**64 if h >> 63 else h for h in found)[:128]


def plain_resemblance(a, b):
    union = sorted(set(a) | set(b))[:128]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def test_fingerprint_query(spark, folder):
    rows = sketch.op7_bottomk_fingerprint(spark, folder).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    expected = Counter()
    printed = lambda hashes: "".join(f"{h % 2**64:016x}" for h in hashes)
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        own, changed, following = plain_sketch(text), plain_sketch(edited), plain_sketch(after)
        likeness = (round(plain_resemblance(own, changed), 9), round(plain_resemblance(own, following), 9))
        expected[r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(own), printed(changed), *likeness] += 1
    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    assert Counter((*(r[c] for c in columns), round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows) == expected


# --- mixing


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), (None, 500, 1), ("c", 100, 1)], "source string, source_size long, n long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5 for a, b, c, null; a and null are cut, then b and c share by 2 to 1, and c is cut.
    assert got == pytest.approx({"a": 20, None: 1000, "c": 200, "b": 1195})


def test_progress_inverts_the_schedule(spark):
    curve = ((0.25, 0.0), (0.5, 3.0), (1.0, 1.0))
    at = spark.range(101).select((F.col("id") / 100.0).alias("u"))
    for r in at.select("u", mixing.progress(curve, F.col("u")).alias("t")).collect():
        done, start = 0.0, 0.0
        for end, w in curve:
            done += max(0.0, min(r["t"], end) - start) * w
            start = end
        assert done / mixing.mean_weight(curve) == pytest.approx(r["u"])


def test_curriculum_of_odd_rows(odd, clashing, empty):
    for docs in (odd, clashing):
        rows = mixing.curriculum(docs).collect()
        assert len(rows) == len(ROWS)
        taken, target = Counter(), {}
        for r in rows:
            assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(c["take"] for c in r["copies"])
            assert all(0 <= c["position"] <= 1 for c in r["copies"])
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
        assert all(abs(taken[s] - t) < 1 for s, t in target.items())
    order = [r["position"] for r in mixing.training_order(mixing.curriculum(odd)).collect()]
    assert order == sorted(order)
    assert mixing.curriculum(empty).count() == 0
