"""WARC archives and languages of pages."""

import base64
import hashlib
import time
from collections import Counter

import numpy as np
import pytest

from recordflow.llm import langid, warc

LONG = "<p>" + "word é " * 30_000
PAGES = [
    (1, "http://a.example/x", "<html lang='en'>one</html>"),
    (2, None, "<html lang='en'>one</html>"),
    (2, None, "<html lang='en'>one</html>"),
    (3, "http://b.example/\r\nX: y", LONG),
    (4, "not a url [", LONG),
    (5, "http://c.example", None),
    (6, "http://c.example", ""),
    (None, "http://d.example", "x"),
    (None, "http://d.example", "one"),
    (7, "http://e.example", "a WARC/1.1\r\nWARC-Type: response\r\n\r\n body\r\n\r\nWARC/1.1\r\n"),
]
SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("least", [0, 3, 10**9])
@pytest.mark.parametrize("segment", [100, 16384])
def test_round_trip(spark, tmp_path, least, segment):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    warc.write_warc(pages, str(tmp_path / "out"), least, segment)
    rows = warc.read_warc(spark, str(tmp_path / "out")).collect()
    best = {}
    for i, _, h in PAGES:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    expected = Counter()
    for i, _, h in PAGES:
        data = (h or "").encode()
        original = best[h or ""] if len(data) >= least and best[h or ""] != -1 and best[h or ""] != i else None
        expected[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if original is None else "revisit", original, None if original is not None else data] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in rows) == expected
    assert all(r["complete"] for r in rows)


def test_missing_segments_are_reported(spark, tmp_path):
    made = list(warc.records(1, "u", LONG.encode(), 5, None))
    for name, kept in (("gap", made[:2] + made[3:]), ("end", made[:-1]), ("start", made[1:]), ("twice", made + made[2:3])):
        path = str(tmp_path / name)
        spark.createDataFrame([(bytes(r),) for r in kept], "r binary").selectExpr("cast(r AS string) AS value").repartition(2).write.option("lineSep", warc.END).option("compression", "gzip").text(path)
        row = warc.read_warc(spark, path).first()
        assert row["complete"] == (name == "twice") and (row["payload"] is None) == (name != "twice")


def test_chunks():
    data = bytes(range(256)) * 50
    assert warc.unchunked(warc.chunked(data, 7)) == data and warc.unchunked(warc.chunked(b"")) == b""
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    warc.write_warc(empty, str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0


def test_addresses():
    assert langid.address("https://www.x.example.de/fr?q#z") == ("www.x.example.de", "example.de", "de")
    assert langid.address(None) == langid.address("http://[bad") == ("", "", "")
    assert langid.visible("<style>a</style><!-- b --><p>c&amp;d").split() == ["c&d"]


def test_domains_under_a_registry_and_addresses_in_numbers():
    assert langid.address("http://a.b.co.uk/")[1:] == ("b.co.uk", "uk")
    assert langid.address("http://co.uk/")[1:] == ("co.uk", "uk")
    assert langid.address("http://a.co.com/")[1:] == ("co.com", "com")
    assert langid.address("http://10.0.0.7:80/x") == ("10.0.0.7", "10.0.0.7", "")
    assert langid.address("http://[::1]/")[1:] == ("::1", "")


@pytest.mark.parametrize(
    ("html", "text", "declared"),
    [
        ("a<script>b</script >c<SCRIPT x>d</Script>e", "a c e", ""),
        ("a<!-- <script> -->b<!-- c", "a b <!-- c", ""),
        ("a<script>b", "a b", ""),
        ("<style>a</script>b", "a b", ""),
        ("<scripts>a</scripts>", "a", ""),
        ("a < b", "a < b", ""),
        ("a <b", "a <b", ""),
        ("<HTML class=x LANG = 'De-at'><p>x", "x", "de"),
        ("<html data-x=1>y<html lang=fr>", "y", "fr"),
        ("<html lang=en", "<html lang=en", "en"),
        ("<htmls lang=en>z", "z", ""),
    ],
)
def test_scan_of_markup(html, text, declared):
    assert " ".join(langid.visible(html).split()) == text
    assert langid.declared_language(html) == declared


@pytest.mark.parametrize("part", ["<", "<script>", "<style>", "<!--", "</script", "<html ", "<html lang", "<html>", "lang = ", "<a>", "< >"])
def test_scan_is_linear(part):
    html = part * (1_000_000 // len(part))
    start = time.perf_counter()
    langid.visible(html)
    langid.declared_language(html)
    assert time.perf_counter() - start < 5  # minutes, if it were not


def test_languages_are_bounded_by_a_parameter(spark):
    docs = spark.createDataFrame([(f"some text {i}", f"l{i}") for i in range(70)], "text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        langid.trained(docs)
    names, model = langid.trained(docs, max_languages=70)
    assert len(names) == 70 and model.shape == (70, langid.BINS)


def plain_posteriors(pages, names, model):
    """Sums over pages, priors and posteriors, page by page."""
    rows = []
    for page_id, url, html in pages:
        host, domain, suffix = langid.address(url)
        bins = langid.grams(langid.visible(html or ""))
        ll = model[:, bins].sum(axis=1, dtype=float) * min(1.0, langid.EVIDENCE_GRAMS / max(len(bins), 1))
        p = np.exp(ll - ll.max())
        rows.append((page_id, host, domain, suffix, langid.declared_language(html or ""), ll, p / p.sum()))
    total = lambda place, value: sum((r[6] for r in rows if r[place] == value), np.zeros(len(names)))
    base = sum((r[6] for r in rows), np.zeros(len(names))) + langid.SMOOTHING
    share, weight = base / base.sum(), langid.PRIOR_PAGES
    out = Counter()
    for page_id, host, domain, suffix, declared, ll, p in rows:
        prior = share
        for place, value in ((2, domain), (1, host)):
            left = np.maximum(total(place, value) - p, 0)
            prior = (left + weight * prior) / (left.sum() + weight)
        logs = ll + np.log(prior)
        for place, value in ((4, declared), (3, suffix)):
            if value:
                logs = logs + np.log((total(place, value) + langid.SMOOTHING * share) / base)
        odds = np.exp(logs - logs.max())
        out[page_id, host, declared, names[int(ll.argmax())], names[int(odds.argmax())], round(float(odds.max() / odds.sum()), 6)] += 1
    return out


def test_posteriors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, model = langid.trained(docs)
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    pages += [(1000 + (p[0] or 0), p[1], p[2]) for p in PAGES] + [pages[0], (5000, "http://h.co.uk", "<html lang=zz>"), (5001, "http://9.9.9.9", "<html lang=de>und")]
    frame = spark.createDataFrame(pages, SCHEMA).repartition(4)
    for df in (frame, frame.selectExpr("*", "1 AS host", "2 AS p", "3 AS lang", "4 AS text", "5 AS score")):
        rows = langid.fused(df, names, model).collect()
        got = Counter((r["page_id"], r["host"], r["declared"], r["text_lang"], r["lang"], round(r["score"], 6)) for r in rows)
        assert got == plain_posteriors(pages, names, model)


def test_languages(spark):
    docs = spark.createDataFrame(
        [(i, t, n) for i, (t, n) in enumerate([("der die und nicht ein ist das auch " * 30, "de"), ("the and of to in is that it was " * 30, "en"), (None, "en"), ("x", None)])],
        "doc_id long, text string, lang string",
    )
    names, model = langid.trained(docs)
    assert names == ["de", "en"]
    said = lambda lang, text: f"<html lang='{lang}'><p>{text}</p></html>"
    pages = [(i, f"http://h{i % 4}.site.de/", said("de", "der und nicht ein das auch")) for i in range(20)]
    pages += [(100 + i, f"http://k{i}.other.com/", said("en-GB", "the and that it was in")) for i in range(20)]
    pages += [(200, "http://h1.site.de/", ""), (201, "http://k1.other.com", None), (202, None, None), (None, None, said("en", "the and of that it was"))]
    rows = {r["page_id"]: r for r in langid.fused(spark.createDataFrame(pages, SCHEMA), names, model).collect()}
    assert len(rows) == len(pages)
    assert all(r["lang"] == ("de" if i < 100 else "en") for i, r in rows.items() if i is not None and i < 200)
    # No text at all: the host decides.
    assert rows[200]["lang"] == "de" and rows[201]["lang"] == "en" and rows[None]["lang"] == "en"
    assert all(0.5 <= r["score"] <= 1.0 + 1e-9 for r in rows.values())
    assert langid.fused(spark.createDataFrame([], SCHEMA), names, model).count() == 0
