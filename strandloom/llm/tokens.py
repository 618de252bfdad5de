"""Encoding of texts with a public byte-level tokenizer (problem 7).

Texts are encoded in Arrow batches inside the tasks with the tiktoken library and a local rank
file, whose folder is a parameter.  A long text is cut into pieces at places where the
tokenizer's own pre-splitting pattern always ends a match, so that the ids of the pieces, one
after the other, are the ids of the whole text.  Null, empty: an empty list.  Text that looks
like a special token is ordinary text.
"""

from __future__ import annotations

import base64
import functools
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the pre-splitting pattern that belongs to the byte_bpe ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a piece of a long text, before looking for the next safe place to cut.
PIECE = 1 << 16
#: Places where the pattern always ends a match, whatever stands around them: no alternative runs
#: from a non-blank into a blank, from a letter into a non-letter or from a digit into a non-digit,
#: and what a match after the cut looks at lies to its right.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


def default_folder() -> str:
    """Where the public tokenizer files are installed."""
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec else "/opt/tokenizers"


@functools.lru_cache(maxsize=4)
def encoder(folder: str, name: str = RANKS) -> tiktoken.Encoding:
    """The encoder of one rank file; loaded once per Python worker."""
    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > size:
        hit = _SAFE.search(text, at + size)
        if hit is None:
            break
        yield text[at : hit.start()]
        at = hit.start()
    yield text[at:]


def encode(enc: tiktoken.Encoding, text: str | None, size: int = PIECE) -> np.ndarray:
    """The ids of one text."""
    if not text:
        return np.zeros(0, np.int32)
    if len(text) <= size:
        return enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    return np.concatenate([enc.encode_to_numpy(p, disallowed_special=()) for p in pieces(text, size)]).astype(np.int32)


def decode(enc: tiktoken.Encoding, ids: list[int]) -> str:
    """The text of ``ids``: raw bytes are joined first, then read as UTF-8."""
    return enc.decode_bytes(list(ids)).decode("utf-8", errors="replace")


def _encoded(folder: str, name: str, counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            keep = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            texts = batch.column(batch.num_columns - 1)
            for lo in range(0, len(texts), 256):  # bounds the ids held at once
                ids = [encode(enc, t.as_py()) for t in texts.slice(lo, 256)]
                if counts:
                    out = pa.array([len(i) for i in ids], pa.int64())
                else:
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    out = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*[k.slice(lo, 256) for k in keep], out], [*names, "_out"])

    return run


def _apply(df: DataFrame, keep: list[str], text: str, folder: str | None, name: str, counts: bool, out: str) -> DataFrame:
    picked = df.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    made = picked.mapInArrow(_encoded(folder or default_folder(), name, counts), f"{kinds}, _out {'long' if counts else 'array<int>'}")
    return made.withColumnRenamed("_out", out)


def encode_column(df: DataFrame, keep: list[str], text: str = "text", folder: str | None = None, name: str = RANKS) -> DataFrame:
    """``keep`` and ``ids`` (array of int), one row per input row; no shuffle.

    Repeated rows stay, other columns of ``df`` are not read.
    """
    return _apply(df, keep, text, folder, name, False, "ids")


def count_column(df: DataFrame, keep: list[str], text: str = "text", folder: str | None = None, name: str = RANKS) -> DataFrame:
    """``keep`` and ``n_tokens`` (long), one row per input row; the ids stay in the task."""
    return _apply(df, keep, text, folder, name, True, "n_tokens")


def _round_trip(folder: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            texts = [decode(enc, encode(enc, t.as_py()).tolist()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"])

    return run


def decoded_column(df: DataFrame, keep: list[str], text: str = "text", folder: str | None = None, name: str = RANKS) -> DataFrame:
    """``keep`` and ``decoded``: each text encoded and decoded again; null and empty texts give an empty one."""
    picked = df.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(_round_trip(folder or default_folder(), name), f"{kinds}, decoded string")
