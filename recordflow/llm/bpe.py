"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import free_name, mapped, table

RANKS = "byte_bpe_multi_50k.tiktoken"

#: Characters of a text that are encoded at once.
PIECE_CHARS = 1 << 16

_SPACES = regex.compile(r"\s+")
_SPACE_AHEAD = regex.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """The text in pieces that no match of the pattern crosses; true marks a piece that is one match.

    No match goes from a character that is not white space to white space, so a text may be cut
    there. Runs of white space beyond ``most`` are one match but for their last character, which
    may belong to what follows; the library's regular expression can't take such runs itself.
    """
    at = 0
    while len(text) - at > most:
        cut = _SPACE_AHEAD.search(text, at + most // 2)
        end = cut.start() if cut else len(text)
        if end - at > most:
            for run in _SPACES.finditer(text, at, end):
                if run.end() - run.start() > most // 2:
                    stop = run.end() if run.end() == len(text) else run.end() - 1
                    if run.start() > at:
                        yield text[at : run.start()], False
                    yield text[run.start() : stop], True
                    at = stop
        if end > at:
            yield text[at:end], False
        at = end
    if at < len(text):
        yield text[at:], False


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a whole text, as ``encode_ordinary`` gives them for texts that it can take."""
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece, whole in safe_pieces(text):
        ids += enc._encode_single_piece(piece.encode()) if whole else enc.encode_ordinary(piece)
    return ids


def encode(
    docs: DataFrame,
    text: str = "text",
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    ids: str = "ids",
) -> DataFrame:
    """The rows with their token ids, packed as little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Rows are independent, so ties and repeated rows change
    nothing; other columns are kept, and an ``ids`` column that is there already is replaced.
    """
    ranks_path = ranks_path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            packed = [np.array(encode_text(enc, x or ""), dtype="<u4").tobytes() for x in batch.column(text).to_pylist()]
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != ids]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(packed, pa.binary())], [n for n, _ in kept] + [ids])

    fields = [f for f in docs.schema.fields if f.name != ids]
    return mapped(docs, run, T.StructType([*fields, T.StructField(ids, T.BinaryType())]))


def decode(
    tokens: DataFrame,
    ids: str = "ids",
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    decoded: str = "decoded",
) -> DataFrame:
    """The rows with the bytes of their packed ids.

    Bytes, not text: one id may hold part of a character. Null ids give empty bytes, and an id
    that the rank file lacks is an error.
    """
    ranks_path = ranks_path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            texts = [enc.decode_bytes(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in batch.column(ids).to_pylist()]
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != decoded]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(texts, pa.binary())], [n for n, _ in kept] + [decoded])

    fields = [f for f in tokens.schema.fields if f.name != decoded]
    return mapped(tokens, run, T.StructType([*fields, T.StructField(decoded, T.BinaryType())]))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs).drop("text")).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encoded_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: ids as an array, and a digest of the text they decode to."""
    rows = encode(docs, ids=(ids := free_name(docs, "ids")))
    out = decode(rows, ids=ids, decoded=(decoded := free_name(rows, "decoded")))
    return out.select(
        "doc_id",
        "source",
        "lang",
        F.expr(f"octet_length({ids}) div 4").alias("n_tokens"),
        F.col(ids).alias("ids"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
