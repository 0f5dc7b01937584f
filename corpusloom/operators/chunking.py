"""Overlapping windows of tokens with exact character offsets and ids made from their content."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: white space that separates tokens: blank, tab, line feed, carriage return, form feed.
GAP = r" \t\n\r\u000C"

#: Windows whose lengths are summed at once.
RUN = 512

CHUNK_COLUMNS = ("id", "doc_id", "chunk_id", "start_char", "end_char", "mdtext", "num_tokens", "source_path", "doc_checksum")


def chunk_id(doc_id: Column, number: Column, start: Column, end: Column) -> Column:
    return F.sha1(F.concat(doc_id, F.lit(":"), number.cast("string"), F.lit("@"), start.cast("string"), F.lit("-"), end.cast("string")))


def token_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"[^{GAP}]+"), 0))


def stride_of(window: int, overlap: int) -> int:
    return max(1, window - overlap)


def window_count(n: Column, window: int, overlap: int) -> Column:
    """How many windows ``n`` tokens give: none for none, else one and as many as it takes to reach the end."""
    more = F.greatest(F.ceil((n - window) / stride_of(window, overlap)), F.lit(0))
    return F.when(n > 0, 1 + more).otherwise(F.lit(0)).cast("int")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def chunk_documents(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 512, overlap: int = 64, source: str = "") -> DataFrame:
    """The windows of ``window`` tokens, ``overlap`` shared, of every text: CHUNK_COLUMNS.

    Tokens are runs without white space; offsets count code points; ``id`` is the SHA-1 of
    ``doc_id:chunk_id@start-end`` and ``doc_checksum`` that of the text.  All in the JVM and without a shuffle.
    Null ids are left out (see ``without_id``); null, empty and blank texts give no window;
    a text of any length is cut whole, in time that grows with its length; equal ids give equal chunk ids.  Other columns are dropped.
    """
    step = stride_of(window, overlap)
    docs = rows.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("_text")).filter("doc_id is not null and _text is not null")
    # Each piece is a token with the white space before it, so the pieces tile the text.
    docs = docs.withColumn("_pieces", F.regexp_extract_all("_text", F.lit(f"[{GAP}]*[^{GAP}]+"), 0)).filter(F.size("_pieces") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("_pieces") - window) / step)).cast("int")
    each = F.sequence(F.lit(0), last)
    # Lengths of the pieces from one window's start to the next one's, and their sums by RUN of them: where a
    # window starts follows from at most RUN of either, so the work grows with the text and not with its square.
    docs = docs.select("doc_id", F.sha1("_text").alias("doc_checksum"), "_pieces", F.transform(each, lambda i: F.length(F.array_join(F.slice("_pieces", i * step + 1, F.lit(step)), ""))).alias("_strides"))
    runs = F.sequence(F.lit(0), F.floor((F.size("_strides") - 1) / RUN).cast("int"))
    docs = docs.select("*", F.transform(runs, lambda j: _total(F.slice("_strides", j * RUN + 1, F.lit(RUN)))).alias("_runs"))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_strides") - 1),
        lambda i: F.struct(
            i.alias("chunk_id"),
            (_total(F.slice("_runs", F.lit(1), F.floor(i / RUN).cast("int"))) + _total(F.slice("_strides", F.floor(i / RUN).cast("int") * RUN + 1, F.pmod(i, F.lit(RUN))))).alias("from"),
            F.array_join(F.slice("_pieces", i * step + 1, F.lit(window)), "").alias("body"),
            F.least(F.lit(window), F.size("_pieces") - i * step).alias("num_tokens"),
        ),
    )
    cut = docs.select("doc_id", "doc_checksum", F.explode(windows).alias("w")).select("doc_id", "doc_checksum", "w.*", F.regexp_replace("w.body", f"^[{GAP}]+", "").alias("mdtext"))
    end = F.col("from") + F.length("body")
    cut = cut.select("*", (end - F.length("mdtext")).alias("start_char"), end.alias("end_char"))
    return cut.select(
        chunk_id(F.col("doc_id"), F.col("chunk_id"), F.col("start_char"), F.col("end_char")).alias("id"),
        "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), F.col("start_char").cast("int").alias("start_char"), F.col("end_char").cast("int").alias("end_char"),
        "mdtext", F.col("num_tokens").cast("int").alias("num_tokens"), F.lit(source).alias("source_path"), "doc_checksum",
    )


def without_id(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that ``chunk_documents`` leaves out for want of an id."""
    return rows.filter(F.col(id_col).isNull())


def chunk_with_tokenizer(rows: DataFrame, spans: Callable[[str], list[tuple[int, int]]], id_col: str = "doc_id", text_col: str = "text", window: int = 512, overlap: int = 64, source: str = "") -> DataFrame:
    """As ``chunk_documents`` with another tokenizer: ``spans`` gives the (start, end) of each token of a text.

    Windows of no width are skipped and ``chunk_id`` numbers the others."""
    step = stride_of(window, overlap)
    docs = rows.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tokens, at, number = spans(text), 0, 0
                while tokens and (at == 0 or at - step + window < len(tokens)):
                    part = tokens[at : at + window]
                    if part[0][0] < part[-1][1]:
                        out.append((doc, number, part[0][0], part[-1][1], text[part[0][0] : part[-1][1]], len(part), text))
                        number += 1
                    at += step
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "chunk_id", "start_char", "end_char", "mdtext", "num_tokens", "_text"])

    cut = docs.mapInArrow(run, "doc_id string, chunk_id int, start_char int, end_char int, mdtext string, num_tokens int, _text string")
    made = chunk_id(F.col("doc_id"), F.col("chunk_id"), F.col("start_char"), F.col("end_char"))
    return cut.select(made.alias("id"), "doc_id", "chunk_id", "start_char", "end_char", "mdtext", "num_tokens", F.lit(source).alias("source_path"), F.sha1("_text").alias("doc_checksum"))
