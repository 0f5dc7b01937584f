"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpusloom.functions.casts import not_blank

#: A vocabulary of ranks for byte-level BPE; another path may be given, or named in the environment.
VOCABULARY = os.environ.get("CORPUSLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")

# Fixed value: how the byte-level vocabularies cut a text into words before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Longer texts are encoded in slices of about this many characters, so that no long one is held in pieces at once.
SLICE = 100_000

# Where PATTERN always parts a text, whatever stands around: before one blank between two signs of text, between letters and digits.
BOUNDARY = regex.compile(r"(?<=[\p{L}\p{N}\p{P}]) (?=[\p{L}\p{N}\p{P}])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@cache
def encoder(path: str):
    """The tokenizer of a file of ranks; once for each Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str, path: str) -> int:
    """The number of tokens of the whole text; slices change nothing about it, since they end where words do."""
    return sum(len(encoder(path).encode_ordinary(piece)) for piece in slices(text))


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """``text`` in slices of at least ``size`` characters, each up to the next BOUNDARY; a text without one stays whole."""
    at = 0
    while len(text) - at > size:
        cut = BOUNDARY.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def token_counts(rows: DataFrame, id_col: str, text_col: str, *carried: str, path: str = VOCABULARY) -> DataFrame:
    """(id_col, carried columns, n_tokens) for each row with an id and a text that is not blank."""
    kept = rows.filter(F.col(id_col).isNotNull() & not_blank(F.col(text_col))).select(id_col, *carried, F.col(text_col).alias("_text"))
    names = [id_col, *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [count(t, path) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sizes, pa.int64())], [*names, "n_tokens"])

    schema = kept.drop("_text").schema.add("n_tokens", LongType())
    return kept.mapInArrow(run, schema)
