"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_blocks

#: Characters from which a text is cut before it reaches tiktoken's regular expression.
LONG = 100_000
_ENCODINGS: dict = {}


def encoding(rank_file: str, pattern: str):
    """The encoding of a rank file, made once a process."""
    import tiktoken

    key = (rank_file, pattern)
    if key not in _ENCODINGS:
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


def safe_parts(text: str, most: int = LONG) -> list[str]:
    """Cut a long text where a match must end.

    A space after a character that is no white space starts a match of its own under patterns
    in which white space only leads a match or fills it.  A part may stay long if it has no such place.
    """
    if len(text) <= most:
        return [text]
    parts, start = [], 0
    for m in re.finditer(r"(?<=\S) ", text):
        if m.start() - start >= most:
            parts.append(text[start : m.start()])
            start = m.start()
    return [*parts, text[start:]]


def encode_text(enc, text: str) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    out = []
    for part in safe_parts(text):
        if len(part) <= 4 * LONG:
            out.append(enc.encode_to_numpy(part, disallowed_special=()))
            continue
        import regex  # one match may be megabytes long here: tiktoken's matcher may run out of steps, but not its merges

        for m in regex.finditer(enc._pat_str, part):
            out.append(np.array(enc._encode_single_piece(m[0]), dtype=np.uint32))
    return np.concatenate(out).astype("<u4") if out else np.empty(0, "<u4")


def encode_documents(df: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (packed little-endian unsigned 32-bit numbers) to every row.

    Each match of ``pattern`` is merged by itself; no text is a special token.  Null and empty
    texts give no ids; repeated rows are encoded each by itself, and an empty table stays empty.  Columns that already have these names are replaced.  ``rank_file`` must
    be at the same path on every executor.
    """
    df = df.drop("n_tokens", "ids")
    schema = T.StructType([*df.schema.fields, T.StructField("n_tokens", T.LongType(), False), T.StructField("ids", T.BinaryType(), False)])

    def make():
        enc = encoding(rank_file, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed = [encode_text(enc, x or "").tobytes() for x in batch.column(text).to_pylist()]
            counts = pa.array([len(x) // 4 for x in packed], pa.int64())
            return pa.RecordBatch.from_arrays([*batch.columns, counts, pa.array(packed, pa.binary())], [*batch.schema.names, "n_tokens", "ids"])

        return step

    return map_blocks(df, text, make, schema)


def decode_documents(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the raw bytes of packed ids as ``out`` (binary: a cut through a character stays as it is).

    Null ids give no bytes; an id outside the vocabulary fails the task.
    """
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType(), False)])

    def make():
        enc = encoding(rank_file, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = [enc.decode_bytes(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(ids).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, out])

        return step

    return map_blocks(df, ids, make, schema)


def default_rank_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    rank_file, pattern = default_rank_file()
    encoded = encode_documents(documents(spark, sf_dir).select("doc_id", "text"), rank_file, pattern).drop("text")
    both = decode_documents(encoded, rank_file, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
