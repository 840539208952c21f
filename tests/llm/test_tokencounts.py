"""Counts of all prefixes against the library, which encodes each prefix anew."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordflow.llm import tokencounts
from recordflow.llm.queries import QUERIES
from tests.llm.conftest import ROWS


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tokencounts.TOKENIZER))


@pytest.fixture(scope="module")
def counter():
    return tokencounts.PrefixCounter(public_tokenizers.path(tokencounts.TOKENIZER))


def length(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def prefixes(counter, text):
    return np.cumsum(counter.steps(text), dtype=np.int64).tolist()


@pytest.mark.parametrize(
    "text",
    [
        "it's we'll they've I'd  x's \n's 's '' ''s!!'s  'll 'lx 're'ree",
        "a  b\n\nc\n d \t e   ",
        "<|endoftext|>",
        "abc<|endoftext|>  x<|endo <|endoftext|><|endoftext|>tail <|endoftext",
        " " * 300 + "a",
        "日本語 ١٢٣ é́ ½ Ⅷ \x1c\x1d \x85\xa0  x　y 😀😀 ՘ ֋ \U0002cead",
        "-" * 150 + "x" * 150,
    ],
)
def test_every_prefix(counter, library, text):
    assert prefixes(counter, text) == [length(library, text[:i]) for i in range(1, len(text) + 1)]


def test_every_prefix_of_mixtures(counter, library):
    rng = random.Random(3)
    parts = [" ", " ", "\n", "\t", "'", "s", "re", "ll", "the", "and", "1", "23", "!", "..", "é", "ß", "日", "<|endoftext|>", "A", "Xq", "\xa0", "\x85", "\x1d"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert prefixes(counter, text) == [length(library, text[:i]) for i in range(1, len(text) + 1)], text


def test_bounded_memory_changes_no_count(library, monkeypatch):
    for name in ("KEPT_UNITS", "KEPT_PAIRS", "KEPT_HEADS"):
        monkeypatch.setattr(tokencounts, name, 2)
    counter = tokencounts.PrefixCounter(public_tokenizers.path(tokencounts.TOKENIZER))
    for text in ("several words of some length", "several others", "of some words"):
        assert prefixes(counter, text) == [length(library, text[:i]) for i in range(1, len(text) + 1)]


def test_odd_documents(odd, clashing, library):
    for docs in (odd, clashing):
        rows = tokencounts.answered(tokencounts.prefix_counts(docs), limit=20).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            text = r["text"] or ""
            assert r["n_tokens"] == length(library, text)
            assert length(library, text[: r["fit_chars"]]) <= 20
            assert r["fit_chars"] == len(text) or length(library, text[: r["fit_chars"] + 1]) > 20
    assert set(clashing.columns) <= set(rows[0].asDict())


def test_questions_after_counting(spark, library):
    rows = [("some words here", 4), ("some words here", 99), ("some", 0), ("", 3), (None, 1), ("some", None)]
    counted = tokencounts.prefix_counts(spark.createDataFrame(rows, "text string, n int"))
    got = {(r["text"], r["n"]): r["tokens_at"] for r in tokencounts.answered(counted, chars="n").collect()}
    assert got == {(t, n): None if n is None else length(library, (t or "")[:n]) for t, n in rows}
    cut = {r["text"] for r in tokencounts.truncated(counted, limit=2).collect()}
    assert cut == {"some words", "some", "", None}


def test_empty_table(empty):
    assert tokencounts.answered(tokencounts.prefix_counts(empty)).count() == 0


def test_query(spark, sf_dir, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_token_counts"](spark, sf_dir).withColumn("n_bytes", F.col("n_bytes")).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows}
    assert got == {d: (len(t.encode()), n := length(library, t), n > 1024) for d, t in docs.items()}
