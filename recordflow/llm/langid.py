"""Language identification by Bayesian fusion of what a page says, declares and where it is.

log P(language | page) is the sum of the tempered likelihood of the text, of the declared
language and of the address suffix, and of a prior of the host, which is smoothed towards its
domain's, and that towards the overall one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm.common import chunks, mapped, staged, table

#: Byte 4-grams are counted in so many bins; a model has this many numbers per language.
BINS = 1 << 15

#: Languages that a model may have unless the caller says otherwise: it takes 128 KB for each of them in every task, and twice that while it is counted.
MAX_LANGUAGES = 64

#: 4-grams beyond this many of a page add no certainty: neighbours aren't independent.
EVIDENCE_GRAMS = 8.0

#: Pages of a parent that a host's or domain's own pages are weighed against.
PRIOR_PAGES = 5.0

#: Pages added to each count of declarations and suffixes.
SMOOTHING = 1.0

_HIDDEN = re.compile(r"(script|style)\b", re.I)
_CLOSING = {kind: re.compile(rf"</{kind}\s*>", re.I) for kind in ("script", "style")}
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)

#: Labels under which a country's names are given out, so that a domain has one label more.
REGISTRIES = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")


def grams(text: str) -> np.ndarray:
    """Bins of the byte 4-grams of a text in lower case."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 4:
        return np.zeros(0, np.int64)
    h = (b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24) * np.uint32(2654435761)
    return (h >> np.uint32(17)).astype(np.int64)


def visible(html: str) -> str:
    """The text outside of tags, comments, scripts and styles, in one forward scan.

    What is opened but never closed is text, but for a comment's, script's or style's own tag.
    """
    out, at, unclosed = [], 0, set()
    while (start := html.find("<", at)) >= 0:
        out.append(html[at:start])
        end = -1
        if html.startswith("<!--", start):
            if "comment" not in unclosed:
                end = html.find("-->", start + 4)
                end = end + 3 if end >= 0 else end
                if end < 0:
                    unclosed.add("comment")
        elif (kind := _HIDDEN.match(html, start + 1)) and (name := kind.group(1).lower()) not in unclosed:
            closing = _CLOSING[name].search(html, kind.end())
            end = closing.end() if closing else end
            if end < 0:
                unclosed.add(name)
        if end < 0:
            end = html.find(">", start) + 1
        if not end:  # no tag is closed from here on
            at = start
            break
        at = end
    return unescape(" ".join([*out, html[at:]]))


def declared_language(html: str) -> str:
    """The language that an html tag declares, in lower case; empty if none does."""
    at = 0
    while found := _HTML.search(html, at):
        at = html.find(">", found.end())
        language = _LANG.search(html, found.end(), at if at >= 0 else len(html))
        if language or at < 0:
            return language.group(1).lower() if language else ""
    return ""


def address(url: str | None) -> tuple[str, str, str]:
    """Host, domain and suffix (the last label); empty where there is none.

    A domain is the last two labels, or three if the last is a country's and the one before it is in ``REGISTRIES``.
    An address in numbers is its own domain and has no suffix.
    """
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".") if host else []
    if ":" in host or (labels and all(x.isdigit() for x in labels)):
        return host, host, ""
    given_out = len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in REGISTRIES
    return host, ".".join(labels[-3 if given_out else -2 :]), labels[-1] if len(labels) > 1 else ""


def trained(docs: DataFrame, text: str = "text", lang: str = "lang", max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of their bins, from counts over all documents with a language.

    More than ``max_languages`` are an error, as the model is held in every task. Null texts and languages are passed over, and texts
    of fewer than four bytes add nothing but their language; repeated rows each count. An empty table gives a model without languages.
    """
    names = [r[0] for r in docs.select(lang).where(F.col(text).isNotNull() & F.col(lang).isNotNull()).distinct().orderBy(lang).limit(max_languages + 1).collect()]
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages; max_languages sets another bound")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch, "text"):
                for x, name in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    total.setdefault(name, np.zeros(BINS, np.int64))
                    total[name] += np.bincount(grams(x), minlength=BINS)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bin": pa.array(at.astype(np.int32)), "n": pa.array(n[at])})

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # At most BINS rows per language: the size does not grow with the documents.
    counts = mapped(rows, run, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    table_ = np.full((len(names), BINS), 0.5)
    place = {name: i for i, name in enumerate(names)}
    np.add.at(table_, (counts["lang"].map(place).to_numpy(np.int64), counts["bin"].to_numpy(np.int64)), counts["n"].to_numpy())
    return names, np.log(table_ / table_.sum(axis=1, keepdims=True)).astype(np.float32)


def evidence(pages: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """(page_id, host, domain, suffix, declared, text): ``text`` holds a log likelihood per language, the largest being 0.

    Null pages and addresses are empty ones: they declare nothing, have no host, and their text tells no language from another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                html = row["html"] or ""
                host, domain, suffix = address(row["url"])
                bins = grams(visible(html))
                ll = model[:, bins].sum(axis=1, dtype=np.float64) * min(1.0, EVIDENCE_GRAMS / max(len(bins), 1))
                out.append(
                    {"page_id": row["page_id"], "host": host, "domain": domain, "suffix": suffix, "declared": declared_language(html), "text": (ll - ll.max()).tolist()}
                )
            yield pa.RecordBatch.from_pylist(out, EVIDENCE)

    return mapped(pages.select("page_id", "url", "html"), run, "page_id bigint, host string, domain string, suffix string, declared string, text array<double>")


EVIDENCE = pa.schema(
    [("page_id", pa.int64()), ("host", pa.string()), ("domain", pa.string()), ("suffix", pa.string()), ("declared", pa.string()), ("text", pa.list_(pa.float64()))]
)


def normalised(logs: Column) -> Column:
    """Probabilities from logs whose largest is taken as 0."""
    top = F.array_max(logs)
    odds = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, y: a + y))


def fused(pages: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """Each page with ``lang``, its probability ``score``, and the languages of text and declaration alone.

    A page without text has its language from the other evidence; without any it has the
    overall prior's. Ties go to the first language by name. Counts behind priors and likelihoods are
    sums of the text's probabilities over all pages; a page's own share is taken out of its host's and domain's.
    Of ``pages`` only page_id, url and html are read; other columns are dropped, and repeated rows each count.
    """
    k = len(names)
    rows = staged(evidence(pages, names, model).withColumn("p", normalised(F.col("text"))), "lang-evidence")
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]
    vector = F.array(*[F.col(f"s{i}") for i in range(k)])

    def counts(key: str) -> DataFrame:
        return rows.groupBy(key).agg(*sums).select(key, vector.alias(f"{key}_n"))

    overall = rows.agg(*sums).first()
    base = [(x or 0.0) + SMOOTHING for x in overall]
    share = F.array(*[F.lit(x / sum(base)) for x in base])

    def likelihood(key: str) -> DataFrame:
        """log P(key | language): of all pages of a language, the part that has the key."""
        table_ = counts(key)
        return table_.select(
            F.col(key).alias(f"{key}_key"),
            F.array(*[F.log((F.col(f"{key}_n")[i] + SMOOTHING * F.lit(base[i] / sum(base))) / F.lit(base[i])) for i in range(k)]).alias(f"{key}_ll"),
        )

    hosts = counts("host").join(rows.groupBy("host").agg(F.min("domain").alias("domain")), "host").join(counts("domain"), "domain")
    hosts = staged(hosts.select(F.col("host").alias("host_key"), "host_n", "domain_n"), "lang-hosts")
    declared = staged(likelihood("declared"), "lang-declared")
    suffixes = staged(likelihood("suffix"), "lang-suffixes")
    out = rows.join(hosts, F.col("host") == F.col("host_key"))
    out = out.join(declared, F.col("declared") == F.col("declared_key")).join(suffixes, F.col("suffix") == F.col("suffix_key"))

    def smoothed(own: str, parent: Column) -> Column:
        left = F.zip_with(own, "p", lambda n, p: F.greatest(n - p, F.lit(0.0)))
        total = F.aggregate(left, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(left, parent, lambda n, q: (n + F.lit(PRIOR_PAGES) * q) / (total + F.lit(PRIOR_PAGES)))

    out = out.withColumn("domain_prior", smoothed("domain_n", share)).withColumn("prior", smoothed("host_n", F.col("domain_prior")))
    # Nothing is declared, or no suffix: that is no evidence.
    plus = lambda a, b: a + b
    none = F.array_repeat(F.lit(0.0), k)
    logs = F.zip_with("text", F.transform("prior", lambda x: F.log(x)), plus)
    logs = F.zip_with(logs, F.when(F.col("declared") == "", none).otherwise(F.col("declared_ll")), plus)
    logs = F.zip_with(logs, F.when(F.col("suffix") == "", none).otherwise(F.col("suffix_ll")), plus)
    out = out.withColumn("logs", logs).withColumn("posterior", normalised(F.col("logs")))
    name = lambda c: F.get(F.array(*map(F.lit, names)), (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return out.select("page_id", "host", "declared", name(F.col("text")).alias("text_lang"), name(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("score"))


def op4_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, model = trained(table(spark, sf_dir, "documents"))
    return fused(table(spark, sf_dir, "pages"), names, model)
