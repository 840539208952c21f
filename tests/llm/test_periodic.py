"""Runs of words against a search for equal neighbours at every distance."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from recordflow.llm import periodic
from recordflow.llm.queries import QUERIES
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, exponent=4, least=6):
    """(start, length, period): for each period the stretches in which words that far apart are equal."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j
    runs = [(a, b - a, q) for (a, b), q in found.items() if b - a >= max(least, exponent * q)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize(("exponent", "least"), [(4, 6), (2, 2), (3, 1)])
def test_runs_of_small_alphabets(exponent, least):
    rng = random.Random(exponent)
    for _ in range(400):
        texts = [[rng.choice([b"a", b"b", b"c"][: rng.randint(1, 3)]) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 6))]
        assert periodic.runs_of(texts, exponent, least) == [plain_runs(t, exponent, least) for t in texts]


def test_runs_of_planted_periods():
    rng = random.Random(9)
    for _ in range(100):
        period = [str(rng.randint(0, 5)).encode() for _ in range(rng.randint(1, 12))]
        text = [b"x"] * rng.randint(0, 3) + period * rng.randint(1, 9) + period[: rng.randint(0, len(period))] + [b"y"] * rng.randint(0, 9)
        assert periodic.runs_of([text, text], 2, 2) == [plain_runs(text, 2, 2)] * 2


def test_blocks_change_nothing(monkeypatch):
    text = [b"a", b"b", b"a", b"a", b"b"] * 12
    expected = periodic.runs_of([text], 2, 2)
    monkeypatch.setattr(periodic, "BLOCK", 3)
    assert periodic.runs_of([text], 2, 2) == expected == [plain_runs(text, 2, 2)]


def test_long_runs():
    assert periodic.runs_of([[b"na"] * 200_000, [b"a", b"b", b"c"] * 50_000]) == [[(0, 200_000, 1)], [(0, 150_000, 3)]]


def test_odd_documents(odd, clashing):
    expected = {}
    for r in ROWS:
        words = WORD.findall(r[1] or "")
        runs = plain_runs(words) if len(words) < 4000 and r[0] != 9 else [(0, 3000, 1)] if r[0] == 9 else []
        expected[r[1]] = (len(words), runs, plain_collapsed(words, runs))
    for docs in (odd, clashing):
        rows = periodic.periodic_runs(docs).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == expected[r["text"]]
    assert set(clashing.columns) <= set(rows[0].asDict())


def test_empty_table(empty):
    assert periodic.periodic_runs(empty).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(plain_collapsed(words, runs)))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(WORD.findall(r["text"] or "")) < 1500}
    rows = QUERIES["op13_periodic_runs"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and len(short) > 0.8 * len(docs)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert {d: got[d] for d in short} == {d: plain_row(d, t) for d, t in short.items()}
    assert sum(g[1] > 0 for g in got.values()) > 5


def test_query_on_odd_documents(spark, folder):
    rows = QUERIES["op13_periodic_runs"](spark, folder).collect()
    assert len(rows) == len(ROWS)
    expected = sorted((plain_row(r[0], r[1]) for r in ROWS if len(r[1] or "") < 5000), key=repr)
    long = {r[0] for r in ROWS if len(r[1] or "") >= 5000}
    assert sorted((tuple(r[c] for c in COLUMNS) for r in rows if r["doc_id"] not in long), key=repr) == expected
