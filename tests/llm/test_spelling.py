"""Words one edit apart, their forms and roots, against a search by deletions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from recordflow.llm import spelling
from recordflow.llm.queries import QUERIES
from tests.llm.conftest import ROWS

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs, least_chars=5, least=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                i = h % len(word)
                word = word[:i] + word[i + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=2):
    """Rows by word: any two words one edit apart have a string in common that is one of them, or a character short of it."""
    meet = defaultdict(set)
    for w in counts:
        for d in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            meet[d].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def got(rows):
    rows = [tuple(r[c] for c in COLUMNS) for r in rows.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block_words", [4096, 7])
def test_variants_of_small_alphabets(spark, block_words):
    rng = random.Random(block_words)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(150)}
    words |= {"".join(rng.choice("aé日😀") for _ in range(rng.randint(1, 5))) for _ in range(100)}
    stem = "x" * 40
    words |= {stem[:i] + c + stem[i:] for i in (0, 1, 13, 39, 40) for c in "xyz"} | {stem, stem[1:], stem * 500, stem * 500 + "y"}
    counts = {w: rng.choice([1, 1, 2, 3, 4, 8, 16, 40]) for w in words if w}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(frame, block_words=block_words)) == plain_variants(counts)


def test_chains_of_forms(spark):
    counts = {"a" * k: 3**k for k in range(1, 25)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = got(spelling.variants(frame))
    assert rows == plain_variants(counts) and {r[2] for r in rows} == {"a" * 24}


def test_hot_buckets_are_dealt_over_blocks(spark):
    """Half of all words agree outside one segment."""
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 60)]
    counts = {f"stem{a}{b}": 3 + (i * j) % 50 for i, a in enumerate(letters) for j, b in enumerate(letters[:20])}
    counts |= {f"{w[::-1]}tail{i}": 5 for i, w in enumerate(list(counts)[:500])}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    tiles = spelling.dealt(spelling.segmented(frame), 100)
    assert tiles.groupBy("base", "tile").count().agg({"count": "max"}).first()[0] < 400
    assert got(spelling.variants(frame, block_words=100)) == plain_variants(counts)


def test_words_of_odd_documents(odd, clashing):
    expected = plain_words([(r[0], r[1]) for r in ROWS], 2, 1)
    for docs in (odd, clashing):
        rows = spelling.corpus_words(docs, least_chars=2, least_count=1, one_in=97).collect()
        assert {r["word"]: r["n"] for r in rows} == expected and len(rows) == len(expected)


def test_counting_in_parts(odd, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 10)
    rows = spelling.corpus_words(odd, one_in=97).collect()
    assert {r["word"]: r["n"] for r in rows} == plain_words([(r[0], r[1]) for r in ROWS])


def test_empty_table(empty):
    assert spelling.variants(spelling.corpus_words(empty)).count() == 0


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = plain_variants(plain_words(docs))
    assert got(QUERIES["op12_spelling_variants"](spark, sf_dir)) == expected
    assert sum(r[1] is not None for r in expected) > 50


def test_query_on_odd_documents(spark, folder):
    assert got(QUERIES["op12_spelling_variants"](spark, folder)) == plain_variants(plain_words([(r[0], r[1]) for r in ROWS]))
