"""The stages one by one on odd documents, and the whole pipeline on the small tables."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordflow.llm import toxicity
from tests.llm.conftest import CLASHES
from tests.llm.test_dedup import removed
from tests.llm.test_texts import reference_ids

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_take_odd_documents(spark, odd, clashing, empty, folder):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, clashing, empty):
            out = stage(spark, docs, folder)
            rows = out.collect()
            if name != "byte_bpe":
                assert out.columns == docs.columns, name
            assert bool(rows) == (docs is not empty), name
            if docs is clashing and name != "byte_bpe":
                assert {r[c] for r in rows for c in CLASHES} == {"mine"}, name


def test_near_duplicates_keep_one_of_each_group(spark, odd, folder):
    kept = Counter(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, odd, folder).collect())
    assert kept[1] == 1 and not kept[11] and not kept[12] and kept[2] == 2 and kept[None] == 1 and kept[7] == kept[6] == 1


def test_near_duplicates_are_those_of_resemblance(spark, sf_dir):
    """Both ways at 0.8: pairs that resemble each other are in one group, and nothing else is."""
    rng = np.random.default_rng(8)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for i in range(60):  # families around the limit: words of one text replaced
        words = [f"w{i}x{j}" for j in range(200)]
        for k in range(4):
            changed = [f"c{i}y{k}z{j}" if rng.random() < 0.002 + 0.02 * k * rng.random() else w for j, w in enumerate(words)]
            texts[10_000_000 + 10 * i + k] = " ".join(changed)
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(t.lower())
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    order, below = sorted(sets), 0
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            both = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - both
            below += 0.6 * union <= both < 0.8 * union
            if 5 * both >= 4 * union:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert below > 50  # pairs that a fingerprint alone would link
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    kept = [r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf_dir).collect()]
    assert sorted(kept) == sorted({find(d) for d in sets})


def test_pipeline_against_plain_python(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, frame, sf_dir).persist()
    model = toxicity.contract_model(spark, frame, sf_dir)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in docs.items() if model.score(t)[0] < 0.5}
    alone = stages["near_duplicates"](spark, clean, sf_dir).persist()
    left = sorted((r["doc_id"], r["text"]) for r in alone.collect())

    def shingles(t):
        w = WORD.findall(t.lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [(i, shingles(t)) for i, t in left]
    assert not [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1 :] if len(x & y) >= 0.9 * len(x | y)]
    words = [(i, WORD.findall(t)) for i, t in left]
    cut = stages["substrings"](spark, alone, sf_dir).persist()
    got = {r["doc_id"]: WORD.findall(r["text"]) for r in cut.collect()}
    assert got == {i: [x for x, y in zip(w, g, strict=True) if not y] for (i, w), g in zip(words, removed(words, 13), strict=True)}
    mixed = stages["mixing"](spark, cut, sf_dir).collect()
    total = sum(map(len, got.values()))
    assert sum(len(WORD.findall(r["text"])) for r in mixed) == pytest.approx(1.5 * total, rel=0.01)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    ids = corpus_pipeline.run(spark, sf_dir).withColumn("head", F.hex("ids")).collect()
    assert sorted((r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in ids) == sorted((r["doc_id"], reference_ids(r["text"])) for r in mixed)
