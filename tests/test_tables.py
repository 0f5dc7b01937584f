import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.embedding import HashingEmbedder, embedded, mean_pool, query_vector, unit_rows
from corpusloom.operators.enrichment import enriched, missing_documents, vector_records
from corpusloom.operators.profiling import duplicate_rows, duplicate_samples, id_uniqueness, length_statistics, sample_exact, value_counts
from corpusloom.operators.skew import hot_keys, repeat_rows, split_rows
from corpusloom.operators.validation import alignment, corpus_status, pair_status, single_dimension, status_counts
from corpusloom.sources import files
from corpusloom.streaming.index import compact, latest_index, upsert_stream, windowed_counts


@pytest.mark.parametrize(("ids", "unique", "dup_rows", "top"), [([1, 2], True, 0, []), ([1, 1, 2], False, 2, [(1, 2)]), ([1, None], False, 0, []), ([None, None, 3], False, 2, [])])
def test_uniqueness(spark, ids, unique, dup_rows, top):
    df = spark.createDataFrame([(i, "x") for i in ids], "id int, n string")
    assert id_uniqueness(df, "id").first().all_unique is unique
    assert duplicate_rows(df, "id").count() == dup_rows
    assert [tuple(r) for r in value_counts(df, "id", 10, least=2).collect()] == top
    assert duplicate_samples(df, "id").count() == sum(n for _, n in top)


def test_hot_ids(spark):
    rows = [(1, i, "x") for i in range(400)] + [(2, i, "x") for i in range(200)] + [(3 + i, 0, "y") for i in range(300)] + [(900 + i // 2, i, "z") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, part int, `count` string")
    got = sorted(map(tuple, duplicate_rows(df, "id", rows_per_part=30).collect()))
    assert got == sorted(r for r in rows if r[0] < 3 or r[0] >= 900)


def test_hot_keys(spark):
    # One key with half of all rows and 200 that are equally frequent: no part has over 50 rows by much.
    keys = spark.range(20_000).select(F.when(F.col("id") < 10_000, F.lit(-1)).otherwise(F.col("id") % 200).alias("key"), "id")
    hot = hot_keys(keys.groupBy("key").count(), "key", 20_000, 50)
    sizes = split_rows(keys, hot, "key", "id").groupBy("key", "part").count()
    assert sizes.agg(F.max("count")).first()[0] < 100 and sizes.filter("key = -1").count() == 200
    right = repeat_rows(keys.select("key").distinct(), hot, "key")
    assert split_rows(keys, hot, "key", "id").join(right, ["key", "part"]).count() == 20_000


@pytest.mark.parametrize(("values", "p50", "p90"), [([], 0.0, 0.0), ([7], 7.0, 7.0), ([1, 2, 3, 4], 2.5, 3.7), ([None, 5], 5.0, 5.0)])
def test_percentiles(spark, values, p50, p90):
    row = length_statistics(spark.createDataFrame([(v,) for v in values], "v int"), "v").first()
    assert (row.p50, row.p90, row.n) == (p50, p90, len([v for v in values if v is not None]))


def test_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    a, b = ({r.doc_id for r in sample_exact(df.repartition(n), 10, "doc_id").collect()} for n in (1, 7))
    assert a == b and len(a) == 10 and sample_exact(df, 500, "doc_id").count() == 100


def test_enrichment(spark):
    day = datetime(2024, 1, 1)
    doc = "documentid long, mdtext string, itemtype_name string, itemtype_description string, birimadi string, esasnoyil string, esasnosira string, kararnoyil string, kararnosira string, karartarihi timestamp_ntz, karartarihistr string, kesinlesmedurumu string, kararno string, esasno string, loaded_at timestamp_ntz"
    docs = spark.createDataFrame([(1, "t", None, "d", "u", "1999", "12.7", "x", None, day, None, "k", "a", "b", day), (1, "older", "T", "d", "u", "1", "1", "1", "1", day, "s", "k", "a", "b", None), (None, "t", *["x"] * 7, day, *["x"] * 4, day)], doc)
    chunk = "id string, doc_id string, chunk_id int, start_char int, end_char int, mdtext string, num_tokens int, doc_checksum string"
    chunks = spark.createDataFrame([("a", "1.0", 0, 0, 1, "x", 1, "c"), ("b", "7", 1, 0, 1, None, 1, None), ("c", None, 2, 0, 1, "x", 1, "c")], chunk)
    got = {r.id: r for r in enriched(chunks, docs).collect()}
    assert len(got) == 3 and got["a"].itemTypeName == "UNKNOWN" and got["a"].found and (got["a"].esasNoYil, got["a"].esasNoSira, got["a"].kararNoYil) == (1999, 12, 0)
    assert got["b"].documentId == "7" and not got["b"].found and got["b"].birimAdi == "Unknown" and got["b"].mdtext == ""
    assert [r.doc_id for r in missing_documents(chunks, docs).collect()] == ["7"]
    vectors = spark.createDataFrame([("a", [1.0]), ("a", None), ("z", [2.0])], "id string, embedding array<float>")
    record = vector_records(enriched(chunks, docs), vectors).collect()
    assert [r.id for r in record] == ["doc_1.0_chunk_0"] and len(record[0].metadata) == 19
    assert enriched(chunks.limit(0), docs).count() == 0 and enriched(chunks, docs.limit(0)).count() == 3


def test_validation(spark):
    a = spark.createDataFrame([("s1",), ("s1",), ("s2",), (None,)], "shard string")
    b = spark.createDataFrame([("s1",), ("s1",), ("s2",), ("s2",), ("s3",)], "shard string")
    assert {(r.shard, r.status, r.match) for r in pair_status(a, b).collect()} == {("s1", "valid", True), ("s2", "mismatch", False), ("s3", "missing_chunks", False), (None, "missing_embedding", False)}
    v = spark.createDataFrame([("p", [1.0, 0.0]), ("f", [2.0, 0.0]), ("n", [1.0, 0.0]), ("d", [1.0, 0.0]), ("d", [1.0])], "shard string, embedding array<float>")
    m = spark.createDataFrame([("p", 2, 1, True), ("f", 2, 1, True), ("d", 2, 2, False), ("none", 2, 0, True)], "shard string, dim int, n_vectors long, normalized boolean")
    assert {r.shard: r.status for r in corpus_status(v, m).collect()} == {"p": "PASS", "f": "FAIL", "n": "WARN", "d": "FAIL", "none": "SKIP"}
    assert {r.status: r.n for r in status_counts(corpus_status(v, m)).collect()} == {"PASS": 1, "FAIL": 2, "WARN": 1, "SKIP": 1}
    x = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id int, embedding array<float>")
    y = spark.createDataFrame([(1, [1.0, 0.01]), (2, [1.0, 0.0])], "id int, embedding array<float>")
    assert alignment(x, y).first().status == "PASS" and alignment(x, y, threshold=1.0).first().status == "FAIL" and alignment(x.limit(0), y).first().status == "WARN"
    assert single_dimension(x) == 2
    with pytest.raises(ValueError):
        single_dimension(v)


class Failing:
    dim = 2

    def __call__(self, texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("cannot read")
        return np.ones((len(texts), 2), np.float32)


def test_embedding(spark):
    df = spark.createDataFrame([("a", "one two"), ("b", "bad"), ("c", None), ("d", " "), ("e", "one two")], "id string, mdtext string")
    got = {r.id: r for r in embedded(df).collect()}
    assert set(got) == {"a", "b", "e"} and got["a"].embedding == got["e"].embedding and abs(np.linalg.norm(got["a"].embedding) - 1) < 1e-6
    failed = {r.id: r for r in embedded(df, Failing).collect()}
    assert failed["b"].embedding is None and "cannot read" in failed["b"].error and failed["a"].error is None
    with pytest.raises(ValueError):
        query_vector("  ", HashingEmbedder())
    assert query_vector("one", HashingEmbedder()) != query_vector("one", HashingEmbedder(), "passage")
    pooled = mean_pool(np.array([[[2.0, 0.0], [4.0, 0.0], [9.0, 9.0]]]), np.array([[1, 1, 0]]))
    assert pooled.tolist() == [[3.0, 0.0]] and unit_rows(np.array([[0.0, 0.0], [0.0, 5.0]])).tolist() == [[0, 0], [0, 1]]


def test_sources(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"content": "é"}\n{"content": null}\nnot json\n[1]\n')
    assert sorted(r.content for r in files.read_json_lines(spark, str(tmp_path / "in.jsonl")).collect()) == ["", "", "", "é"]
    df = spark.createDataFrame([("ğ",), (None,)], "t string").coalesce(1)
    files.write_json_lines(df, str(tmp_path / "out"), "t")
    assert sorted(r.content for r in files.read_json_lines(spark, str(tmp_path / "out")).collect()) == ["", "ğ"]
    x = np.arange(600, dtype=np.float16).reshape(150, 4)
    x.tofile(tmp_path / "m.npy")
    rows = files.read_matrix(spark, str(tmp_path / "m.npy"), 4).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(150)) and np.array_equal([r.embedding for r in rows], x)
    with pytest.raises(ValueError):
        files.read_matrix(spark, str(tmp_path / "m.npy"), 7)
    folder = tmp_path / "docs_0m_1m"
    folder.mkdir()
    (folder / "meta_0m_1m.json").write_text(json.dumps({"dim": 4, "normalized": True, "model": "m"}))
    meta = files.read_sidecar(spark, str(folder / "meta_0m_1m.json")).first()
    assert (meta.dim, meta.normalized, meta.n_vectors, meta.shard) == (4, True, None, "docs_0m_1m")
    with pytest.raises(FileNotFoundError, match="chunks, embeddings"):
        files.shard_files(spark, str(tmp_path), "0m", "1m")
    assert files.resolve_shard(spark, str(tmp_path), "0m").endswith("docs_0m_1m") and files.resolve_shard(spark, str(tmp_path), "0m", "1m").endswith("docs_0m_1m")
    with pytest.raises(FileNotFoundError):
        files.resolve_shard(spark, str(tmp_path), "3m")
    names = spark.createDataFrame([(n,) for n in ("docs_10m_11m", "docs_2m_3m", "docs_0m_1m", "docs_x_y")], "s string")
    assert [r.s for r in names.orderBy(files.shard_order(F.col("s")), "s").collect()] == ["docs_0m_1m", "docs_x_y", "docs_2m_3m", "docs_10m_11m"]
    spark.range(20).coalesce(1).write.parquet(str(tmp_path / "p"))
    assert [r.id for r in files.read_rows(spark, str(tmp_path / "p"), "id", start=5, end=7).collect()] == [5, 6]
    assert files.read_rows(spark, str(tmp_path / "p"), start=90).count() == 0 and len(files.find_files(spark, str(tmp_path))) >= 1 and files.find_files(spark, str(tmp_path / "none")) == []
    chunks = spark.createDataFrame([(i, f"c{i}", 0.0) for i in range(150)], "row_index long, id string, embedding double")
    both = files.zipped(chunks, files.read_matrix(spark, str(tmp_path / "m.npy"), 4)).orderBy("row_index").collect()
    assert [r.id for r in both] == [f"c{i}" for i in range(150)] and np.array_equal([r.embedding_right for r in both], x)
    with pytest.raises(ValueError, match="149 rows"):
        files.zipped(chunks.limit(149), files.read_matrix(spark, str(tmp_path / "m.npy"), 4))
    assert files.zipped(chunks.limit(0), files.read_matrix(spark, str(tmp_path / "m.npy"), 4), strict=False).count() == 0
    seen = files.file_statistics(spark, str(tmp_path / "p")).collect()
    assert [(r.n_rows, r.n_columns, r.columns) for r in seen] == [(20, 1, "id bigint")] and seen[0].file.endswith(".parquet")
    files.write_duplicates(spark.createDataFrame([(2, "x"), (None, "y"), (1, "z")], "id int, n string"), "id", str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def test_stream(spark, tmp_path):
    schema = "namespace string, id int, updated_at int, v string"
    source = str(tmp_path / "in")
    for rows in ([("n", 1, 1, "a"), ("n", 2, 1, "a")], [("n", 1, 2, "b"), ("n", 2, 0, "late"), ("m", 1, 1, "c")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert_stream(stream, str(tmp_path / "index"), str(tmp_path / "cp")).awaitTermination()
    want = {("n", 1, "b"), ("n", 2, "a"), ("m", 1, "c")}
    seen = lambda: {(r.namespace, r.id, r.v) for r in latest_index(spark, str(tmp_path / "index")).collect()}
    assert seen() == want and latest_index(spark, str(tmp_path / "none")) is None
    compact(spark, str(tmp_path / "index"))
    assert seen() == want and [p.name for p in (tmp_path / "index").iterdir()] == ["m=1"]
    spark.createDataFrame([("m", 1, 5, "d")], schema).coalesce(1).write.mode("append").parquet(source)
    upsert_stream(spark.readStream.schema(schema).parquet(source), str(tmp_path / "index"), str(tmp_path / "cp")).awaitTermination()
    assert seen() == {("n", 1, "b"), ("n", 2, "a"), ("m", 1, "d")}
    events = spark.createDataFrame([(datetime(2024, 1, 1, 1, 5), "x", 1.0), (datetime(2024, 1, 1, 1, 50), "x", 3.0)], "ts timestamp, event_type string, value double")
    assert [(r.n, r.mean_value) for r in windowed_counts(events).collect()] == [(2, 2.0)]
