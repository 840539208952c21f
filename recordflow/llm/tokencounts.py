"""Token counts by prefix dynamic programming: the exact count of every prefix of a text, found once.

Byte-level BPE has one last token for each prefix: the only one that goes together with the last token of what is before it.
So a table over the prefixes, each a token longer than a shorter one, gives all of their counts, and questions about
budgets and cuts are answered from the table without encoding again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from recordflow.llm.common import mapped, table

TOKENIZER = "byte_bpe_50k.json"

#: Tokens beyond which a document is over the limit.
LIMIT = 1024

#: Units whose steps a worker keeps at hand in each of two generations, and the longest one of them; both bound its memory and change no count.
KEPT_UNITS, KEPT_CHARS = 400_000, 48

#: First bytes of pieces whose tables are remembered, and how many of them.
HEAD_BYTES, KEPT_HEADS = 5, 100_000

#: Pairs of tokens of which a worker remembers whether they stay two.
KEPT_PAIRS = 1_000_000

SPACE, WHITE, LETTER, NUMBER, OTHER = " ", "\t", "a", "1", "!"

#: The endings that the tokenizer splits from a word, and the letters in them.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes as letters: printable Latin-1 as itself, the others by number from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Classes(dict):
    """For ``str.translate``: each character as the one that stands for its class; classes are the tokenizer's own."""

    def __init__(self, split):
        self.split = split
        super().__init__({ord(c): c for c in " '" + "".join(CONTRACTIONS)[1:].replace("'", "")})

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if len(self.split(f"a{c}")) == 1:
            found = LETTER
        elif len(self.split(f"1{c}")) == 1:
            found = NUMBER
        else:
            found = OTHER if len(self.split(f"!{c}")) == 1 else WHITE
        self[code] = found
        return found


def unit_pattern(classes: Classes) -> re.Pattern:
    """White space and what follows it as one unit, over Latin-1 and the characters that stand for classes."""
    of = {kind: "".join(re.escape(chr(c)) for c in range(256) if classes[c] == kind or (kind == LETTER and chr(c) in "strevmld")) for kind in (WHITE, LETTER, NUMBER)}
    white, letter, number = f"[ {of[WHITE]}]", f"[{of[LETTER]}]", f"[{of[NUMBER]}]"
    other = f"[^ {of[WHITE]}{of[LETTER]}{of[NUMBER]}]"
    endings = "|".join(CONTRACTIONS)
    return re.compile(f" ?{letter}+|(?:{white}*[{of[WHITE]}])?(?:{endings})|{white}*(?:{letter}+|{number}+|{other}+)|{white}+")


class PrefixCounter:
    """Counts of all prefixes of a text, as steps: how much the count changes with each character."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        added = library.get_added_tokens_decoder()
        if library.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("only byte-level tokenizers without a normalizer, with plain added tokens")
        self.model = library.model
        letters = byte_letters()
        special = {t.content for t in added.values()}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.spelled = [""] * (library.get_vocab_size() + 1)  # the last one stands for no token
        #: A tree of the tokens read backwards: (node, byte) to node, and the token, if any, that a node is the start of.
        self.back: dict[int, int] = {}
        self.token_at = [-1]
        for token, i in library.get_vocab(with_added_tokens=False).items():
            if token in special:
                continue
            self.spelled[i], node = token, 0
            for c in reversed(token):
                step = node << 8 | letters[c]
                node = self.back.setdefault(step, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = i
        split = library.pre_tokenizer.pre_tokenize_str
        self.classes = Classes(split)
        self.pattern = unit_pattern(self.classes)
        self.pairs: dict[int, bool] = {}
        self.heads: dict[bytes, tuple[list[int], list[int]]] = {}
        self.units = Units(self)

    def stay(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, one after the other, encode as these two; a token alone if there is none on the left."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        got = [t.id for t in self.model.tokenize(self.spelled[left] + self.spelled[right])]
        found = self.pairs[left << 32 | right] = got == [t for t in (left, right) if self.spelled[t]]
        return found

    def piece_counts(self, piece: bytes) -> list[int]:
        """Tokens of the first 0, 1, ... bytes of what the tokenizer merges as one piece.

        Many pieces begin alike, so the table over their first bytes is taken over from an earlier one.
        """
        back, token_at, pairs, stay = self.back.get, self.token_at, self.pairs.get, self.stay
        head = piece[:HEAD_BYTES]
        found = self.heads.get(head)
        counts, last = (found[0][:], found[1][:]) if found else ([0], [len(self.spelled) - 1])
        for end in range(len(counts), len(piece) + 1):
            node, ending = 0, []
            for start in range(end - 1, -1, -1):
                node = back(node << 8 | piece[start])
                if node is None:
                    break
                if token_at[node] >= 0:
                    ending.append((start, token_at[node]))
            for start, token in reversed(ending):  # the longest is most often the one
                fits = pairs(last[start] << 32 | token)
                if fits or fits is None and stay(last[start], token):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends {piece[:end]!r}")
            if end == HEAD_BYTES:
                if len(self.heads) >= KEPT_HEADS:
                    self.heads.clear()
                self.heads[head] = (counts[:], last[:])
        return counts

    def prefixes(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a piece."""
        data = piece.encode()
        counts = self.piece_counts(data)
        if len(data) == len(piece):
            return counts[1:]
        return [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def unit_steps(self, unit: str) -> bytes:
        """The steps over white space and the letters, digits or other characters after it.

        While a prefix ends in white space, that is one piece. With more behind, its last character is a piece of its own or, if a space, part of the next.
        """
        core = unit.translate(self.classes).lstrip(SPACE + WHITE)
        white, core = unit[: len(unit) - len(core)], unit[len(unit) - len(core) :]
        counts = self.prefixes(white) if white and (core == "" or white != " ") else []
        if core:
            head, joined = (white[:-1], " ") if white[-1:] == " " else (white, "")
            base = (self.prefixes(head)[-1] if len(head) < 2 or joined else self.prefixes(head[:-1])[-1] + self.prefixes(head[-1])[-1]) if head else 0
            own = self.prefixes(joined + core)
            if not joined and core in CONTRACTIONS:
                own[:-1] = range(1, len(core))  # before its last letter it is no contraction, but a sign and a letter
            counts += [base + n for n in (own[1:] if joined and counts else own)]
        return bytes(b - a & 255 for a, b in zip([0, *counts], counts))

    def plain_steps(self, text: str) -> bytes:
        """The steps of a text that has no added token."""
        self.units.age()
        try:
            text.encode("latin-1")
            units = self.pattern.findall(text)
        except UnicodeEncodeError:
            units = [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.classes))]
        return b"".join(map(self.units.__getitem__, units))

    def steps(self, text: str) -> np.ndarray:
        """How the count changes with each character; their running sums are the counts of all prefixes.

        An added token is one token once it is complete; until then it is read on as ordinary text.
        """
        out, at = [], 0
        for found in self.special.finditer(text) if self.special else ():
            whole = np.frombuffer(self.plain_steps(text[at : found.end() - 1]), np.int8)
            before = int(whole[: found.start() - at].sum(dtype=np.int64))
            out += [whole, np.array([before + 1 - whole.sum(dtype=np.int64)], np.int8)]
            at = found.end()
        out.append(np.frombuffer(self.plain_steps(text[at:]), np.int8))
        return np.concatenate(out)


class Units(dict):
    """The steps of units, remembered while they are short; those not asked for in a whole generation are forgotten."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit) or self.counter.unit_steps(unit)
        if len(unit) <= KEPT_CHARS:
            self[unit] = found
        return found

    def age(self) -> None:
        if len(self) > KEPT_UNITS:
            self.older = dict(self)
            self.clear()


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, text: str = "text", tokenizer_path: str | None = None, steps: str = "steps", keep_text: bool = True) -> DataFrame:
    """The rows with ``steps``, a signed byte for each character of their text: by how much it changes the token count.

    The sum of the first n is the exact count of the first n characters, as the library encodes them. A null or empty text has no steps.
    Rows are independent, so ties and repeated rows change nothing; other columns are kept, and one named ``steps`` is replaced.
    """
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    kept = [f for f in docs.schema.fields if f.name != steps and (keep_text or f.name != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = counter(path)
        for batch in batches:
            found = [table_.steps(x).tobytes() if x else b"" for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(found, pa.binary())], [*(f.name for f in kept), steps])

    return mapped(docs, run, T.StructType([*kept, T.StructField(steps, T.BinaryType())]))


def answered(rows: DataFrame, limit: int = LIMIT, chars: str | None = None, steps: str = "steps") -> DataFrame:
    """The rows of ``prefix_counts`` without their steps, but with ``n_tokens`` and ``fit_chars``.

    ``fit_chars`` is the length of the longest prefix of at most ``limit`` tokens. With ``chars``, a column of prefix lengths, ``tokens_at``
    is the count of that prefix: of the whole text beyond its end, none below 1, null for null. Null steps are those of an empty text;
    columns of these names are replaced.
    """
    names = ["n_tokens", "fit_chars", *(["tokens_at"] if chars else [])]
    kept = [f for f in rows.schema.fields if f.name not in (*names, steps)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(chars).to_pylist() if chars else [None] * batch.num_rows
            out = []
            for x, n in zip(batch.column(steps).to_pylist(), wanted, strict=True):
                counts = np.cumsum(np.frombuffer(x or b"", np.int8), dtype=np.int64)
                fits = np.flatnonzero(counts <= limit)
                at = None if n is None else int(counts[min(n, len(counts)) - 1]) if n > 0 and len(counts) else 0
                out.append((int(counts[-1]) if len(counts) else 0, int(fits[-1]) + 1 if len(fits) else 0, at))
            found = [pa.array([o[i] for o in out], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *found], [*(f.name for f in kept), *names])

    return mapped(rows, run, T.StructType([*kept, *(T.StructField(n, T.LongType()) for n in names)]))


def truncated(rows: DataFrame, limit: int = LIMIT, text: str = "text", steps: str = "steps") -> DataFrame:
    """The rows of ``prefix_counts`` with ``text`` cut to its longest prefix of at most ``limit`` tokens; null stays null."""
    out = answered(rows, limit, steps=steps)
    return out.withColumn(text, F.expr(f"substring(`{text}`, 1, int(fit_chars))")).drop("n_tokens", "fit_chars")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    rows = answered(prefix_counts(docs, keep_text=False))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
