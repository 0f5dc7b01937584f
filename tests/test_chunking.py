import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.casts import integer_key, safe_int, safe_string
from corpusloom.functions.text import id_column, millions_label, not_blank, preview, shortened, text_column
from corpusloom.operators.chunking import CHUNK_COLUMNS, chunk_documents, chunk_with_tokenizer, without_id


def spans(text):
    return [m.span() for m in re.finditer(r"[^ \t\n\r\f]+", text)]


def by_hand(doc, text, window, overlap):
    tokens, step, out, at = spans(text), max(1, window - overlap), [], 0
    whole = hashlib.sha1(text.encode()).hexdigest()
    while tokens:
        part = tokens[at : at + window]
        a, b, n = part[0][0], part[-1][1], len(out)
        digest = hashlib.sha1(f"{doc}:{n}@{a}-{b}".encode()).hexdigest()
        out.append((digest, str(doc), n, a, b, text[a:b], len(part), "", whole))
        if at + window >= len(tokens):
            break
        at += step
    return out


TEXTS = ["", " \t\n ", "a", "a b c d", "a b c d e", "a b c d e f g", "a b c d e f g h", "ıİ😀 x\ty\fz\r\nq  ", "  lead " + "w " * 500, None]


@pytest.mark.parametrize(("window", "overlap"), [(4, 1), (2, 5), (3, 0), (512, 64)])
def test_windows(spark, window, overlap):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "lost id", "y"), (3, "a b c d", "again")]
    df = spark.createDataFrame(rows, "doc_id int, text string, mdtext string")
    want = sorted(x for i, t, _ in rows if i is not None and t for x in by_hand(i, t, window, overlap))
    got = chunk_documents(df, window=window, overlap=overlap)
    assert got.columns == list(CHUNK_COLUMNS)
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, chunk_with_tokenizer(df, spans, window=window, overlap=overlap).collect())) == want
    assert without_id(df).count() == 1


def test_no_shuffle_and_empty(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    assert chunk_documents(df).count() == 0
    plan = chunk_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_id_digest(spark):
    df = spark.createDataFrame([("a", " x")], "doc_id string, text string")
    assert chunk_documents(df).first().id == "ea0992fd78c15be7170d881b7aee9bddee010bff"


def test_casts(spark):
    values = [None, "", "x", " 12 ", "12.7", "-3", "1e3", "inf", "NaN", "1e40"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(safe_int(F.col("v"))).collect()] == [0, 0, 0, 12, 12, -3, 1000, 0, 0, 0]
    assert df.select(safe_string(F.col("v"), "-")).first()[0] == "-"
    keys = ["12", " 12\n", "12.0", "1.2E1", "00012", "12.5", "nan", "None", "", None, " 12", "99999999999999999999", "-7"]
    df = spark.createDataFrame([(v,) for v in keys], "v string")
    assert [r[0] for r in df.select(integer_key(F.col("v"))).collect()] == [12, 12, 12, 12, 12, None, None, None, None, None, 12, None, -7]


def test_text(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 50, 51, 199, 200, 201)], "t string")
    assert [len(r[0]) for r in df.select(preview(F.col("t"))).collect()] == [0, 50, 51, 199, 200, 203]
    assert [len(r[0]) for r in df.select(shortened(F.col("t"))).collect()] == [0, 50, 50, 50, 50, 50]
    labels = spark.createDataFrame([(n,) for n in (0, 1_000_000, 6_600_000, 1_000_010, 10_000_000)], "n long")
    assert [r[0] for r in labels.select(millions_label(F.col("n"))).collect()] == ["0m", "1m", "6.6m", "1m", "10m"]
    blanks = spark.createDataFrame([(None,), ("",), ("  \t",), ("​",), (" a",)], "t string")
    assert [r[0] for r in blanks.select(not_blank(F.col("t"))).collect()] == [False, False, False, False, True]
    assert text_column(["id", "content", "text"]) == "text" and text_column(["a", "b"]) == "a"
    assert id_column(["x", "documentid"]) == "documentid" and id_column(["x"]) is None


def test_a_very_long_text(spark):
    text = "  " + "".join(f"w{i % 977}{' ' * (1 + i % 3)}" for i in range(1_000_000))
    got = chunk_documents(spark.createDataFrame([(1, text)], "doc_id int, text string")).orderBy("chunk_id").collect()
    assert sorted(map(tuple, got)) == sorted(by_hand(1, text, 512, 64))
