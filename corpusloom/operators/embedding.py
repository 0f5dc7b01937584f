"""Embedding of texts through an exchangeable model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from typing import Protocol

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import not_blank, with_role


class Embedder(Protocol):
    """Turns texts into a float32 matrix; made once in each Python worker."""

    dim: int

    def __call__(self, texts: list[str]) -> np.ndarray: ...


class HashingEmbedder:
    """Stands in for a trained model: signed hashes of words summed into ``dim`` buckets, of length 1."""

    def __init__(self, dim: int = 64, most_words: int | None = None):
        self.dim, self.most_words = dim, most_words

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, text in enumerate(texts):
            for word in re.findall(r"\w+", text.lower())[: self.most_words]:
                h = xxhash.xxh64_intdigest(word)
                out[i, h % self.dim] += 1.0 if h >> 63 else -1.0
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length == 0, 1, length)


class OnnxEmbedder:
    """A model and tokenizer from files: tokens, mean of the last states over the mask, length 1."""

    def __init__(self, model: str, tokenizer: str, most_tokens: int = 512):
        import onnxruntime
        from tokenizers import Tokenizer

        self.session = onnxruntime.InferenceSession(model, providers=["CPUExecutionProvider"])
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.enable_truncation(most_tokens)
        self.tokenizer.enable_padding()
        self.inputs = {i.name for i in self.session.get_inputs()}
        self.dim = self.session.get_outputs()[0].shape[-1]

    def __call__(self, texts: list[str]) -> np.ndarray:
        encoded = self.tokenizer.encode_batch(texts)
        feed = {"input_ids": np.array([e.ids for e in encoded]), "attention_mask": np.array([e.attention_mask for e in encoded]), "token_type_ids": np.array([e.type_ids for e in encoded])}
        states = self.session.run(None, {k: v for k, v in feed.items() if k in self.inputs})[0]
        return unit_rows(mean_pool(states, feed["attention_mask"]))


def mean_pool(states: np.ndarray, mask: np.ndarray, least: float = 1e-9) -> np.ndarray:
    """Mean over the tokens whose mask is 1."""
    m = mask[:, :, None].astype(states.dtype)
    return (states * m).sum(axis=1) / np.maximum(m.sum(axis=1), least)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; all-zero rows stay."""
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length == 0, 1, length)


@cache
def _made(make: Callable[[], Embedder]) -> Embedder:
    return make()


def embedded(rows: DataFrame, make: Callable[[], Embedder] = HashingEmbedder, id_col: str = "id", text_col: str = "mdtext", role: str = "passage", batch: int = 512) -> DataFrame:
    """(id, embedding, error): the vector of every text that is not blank.

    Texts get the prefix of their ``role``.  Within a partition they go by length, so batches need little padding.
    A batch that fails is tried again text by text; a text that fails has a null vector and the error, never zeros.
    Null and blank texts are left out.
    """
    kept = rows.filter(not_blank(F.col(text_col))).select(F.col(id_col).alias("id"), with_role(F.col(text_col), role).alias("text"))
    kind = dict(kept.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _made(make)
        for rows_ in batches:
            for i in range(0, rows_.num_rows, batch):
                part = rows_.slice(i, batch)
                texts = part.column("text").to_pylist()
                vectors: list = []
                errors: list = [None] * len(texts)
                try:
                    vectors = list(model(texts))
                except Exception:
                    for j, text in enumerate(texts):
                        try:
                            vectors.append(model([text])[0])
                        except Exception as e:
                            vectors.append(None)
                            errors[j] = repr(e)[:500]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())], ["id", "embedding", "error"])

    return kept.sortWithinPartitions(F.length("text")).mapInArrow(run, f"id {kind}, embedding array<float>, error string")


def query_vector(text: str, model: Embedder, role: str = "query") -> list[float]:
    """The vector of one query; ValueError for blank text."""
    if not text or not text.strip():
        raise ValueError("blank query")
    prefix = {"query": "query: ", "passage": "passage: "}[role]
    return [float(x) for x in model([prefix + text])[0]]
