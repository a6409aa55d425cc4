"""Problem 8: token ids of a public byte-level vocabulary, and back."""

from __future__ import annotations

import base64
import functools
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts longer than this are encoded in parts, so that no call holds a whole book's pieces.
PART_CHARS = 100_000


def rank_file(name: str = "byte_bpe_50k") -> str:
    """The local rank file: in the folder QUIRELAKE_TOKENIZERS names, else of the installed package, else in /opt/tokenizers."""
    folder = os.environ.get("QUIRELAKE_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(folder, f"{name}.tiktoken")


@functools.lru_cache(maxsize=4)
def encoding(path: str):
    """The encoding of a rank file, read once per Python worker; it has no special tokens."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size``, cut where the pattern always ends a piece.

    That is before a single U+0020 with other characters than white space on both sides. Where no
    such place follows, the part is longer.
    """
    start = 0
    while len(text) - start > size:
        at = start + size
        while (at := text.find(" ", at)) > 0 and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def encode(text: str | None, path: str) -> np.ndarray:
    """The ids of ``text``; none for null and empty. Strings of special tokens are plain text."""
    if not text:
        return np.empty(0, np.int32)
    enc = encoding(path)
    if len(text) <= PART_CHARS:
        return enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    return np.concatenate([enc.encode_to_numpy(p, disallowed_special=()) for p in safe_parts(text)]).astype(np.int32)


def decode(ids, path: str) -> bytes:
    """The raw bytes of ``ids``: exact also where a token ends within a character."""
    return encoding(path).decode_bytes([int(i) for i in ids])


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None, counts_only: bool = False) -> DataFrame:
    """One row for each row of ``df``: ``key`` and ``ids`` (or ``n_tokens``), by a map without shuffle.

    Null and empty texts have the empty list (0 tokens). Repeated texts are encoded once per batch.
    Columns other than these two are not read; a null key is kept.
    """
    path = ranks or rank_file()
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: dict[str, np.ndarray] = {}
            made = []
            for value in batch.column(1):
                value = value.as_py() or ""
                if value not in done:
                    done[value] = encode(value, path)
                made.append(done[value])
            lengths = np.fromiter(map(len, made), np.int64, len(made))
            if counts_only:
                second = pa.array(lengths)
            else:
                ends = np.concatenate([[0], np.cumsum(lengths)])
                flat = np.concatenate(made) if made else np.empty(0, np.int32)
                second = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), second], [key, "n_tokens" if counts_only else "ids"])

    value = T.StructField("n_tokens", T.LongType()) if counts_only else T.StructField("ids", T.ArrayType(T.IntegerType()))
    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, T.StructType([T.StructField(key, kind), value]))


def decode_corpus(df: DataFrame, key: str = "doc_id", ids: str = "ids", ranks: str | None = None) -> DataFrame:
    """``key``, ``raw`` (the exact bytes) and ``text`` (the bytes as UTF-8, broken sequences replaced) of each row; null ids give no bytes."""
    path = ranks or rank_file()
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [decode(v.as_py() or (), path) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw])], [key, "raw", "text"])

    fields = [T.StructField(key, kind), T.StructField("raw", T.BinaryType()), T.StructField("text", T.StringType())]
    return df.select(key, ids).mapInArrow(run, T.StructType(fields))
