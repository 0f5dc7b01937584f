import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import vectors as V
from corpusloom.operators.filters import filtered
from corpusloom.operators.search import batch_top_k, fetched, index_stats, ivf_top_k, top_k, upserted
from corpusloom.operators.subset import assigned, kmeans_subset, label_centres, medoids, members

DATA = [(0, [1.0, 0.0], "a"), (1, [0.0, 2.0], "b"), (2, [1.0, 0.0], "a"), (3, [0.0, 0.0], "b"), (4, None, "a"), (5, [1.0], "b"), (6, [3.0, 4.0], None)]


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame(DATA, "id long, values array<float>, kind string")


def test_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0], [1.0])], "a array<float>, b array<float>, z array<float>, s array<float>")
    a, b, z, s = map(F.col, "abzs")
    row = df.select(V.dot(a, b), V.norm(a), V.cosine(a, b), V.cosine(a, z), V.squared_distance(a, b), V.normalised(a), V.normalised(z), V.dot(a, s)).first()
    assert list(row)[:5] == [24.0, 5.0, 0.96, 0.0, 2.0] and list(row[5]) == [0.6, 0.8] and list(row[6]) == [0.0, 0.0] and row[7] is None
    with pytest.raises(ValueError):
        V.score("nearest", a, b)


@pytest.mark.parametrize("metric", V.METRICS)
def test_one_and_many_agree(spark, index, metric):
    one = [(r.rank, r.id, r.score) for r in top_k(index, [1.0, 0.0], 3, metric).collect()]
    queries = spark.createDataFrame([(9, [1.0, 0.0]), (10, None)], "id long, values array<float>")
    many = [(r.rank, r.id, r.score) for r in batch_top_k(index, queries, 2, 3, metric).orderBy("rank").collect()]
    assert one == many and len(one) == 3


def test_ties_filters_and_bounds(spark, index):
    assert [r.id for r in top_k(index, [1.0, 0.0], 99).collect()] == [0, 2, 6, 1, 3]
    assert [r.id for r in top_k(index, [1.0, 0.0], 1, condition={"kind": "b"}).collect()] == [1]
    assert top_k(index, [1.0, 0.0], 5, condition={"kind": "none"}).count() == 0
    assert [r.id for r in batch_top_k(index, index.filter("id = 0"), 2, 1, skip_self=True).collect()] == [2]
    assert batch_top_k(index.limit(0), index, 2, 1).count() == 0
    assert batch_top_k(index, index.limit(0), 2, 1).count() == 0


def test_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, values array<float>").repartition(5)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    s = np.round(u @ u.T, 6)
    want = {(q, r + 1, int(i)) for q in range(0, 300, 20) for r, i in enumerate(np.lexsort((np.arange(300), -s[q]))[:4])}
    assert {(r.query_id, r.rank, r.id) for r in batch_top_k(df, df.filter("id % 20 = 0"), 8, 4).collect()} == want


def test_filter_language(spark):
    df = spark.createDataFrame([(1, "x", ("p", 5)), (2, None, ("q", None)), (3, "xy", None)], "id int, t string, m struct<a:string,b:int>")
    ids = lambda c: [r.id for r in filtered(df, c).orderBy("id").collect()]
    assert ids(None) == ids({}) == [1, 2, 3]
    assert ids({"t": "x"}) == [1] and ids({"t": {"$ne": "x"}}) == [3] and ids({"t": {"$contains": "x"}}) == [1, 3]
    assert ids({"m.b": {"$gte": 5, "$lt": 6}}) == [1] and ids({"m.none": 1}) == [] and ids({"none": {"$ne": 1}}) == []
    assert ids({"$or": [{"id": {"$in": [3]}}, {"$and": [{"m.a": "q"}, {"id": {"$nin": [1]}}]}]}) == [2, 3]
    for bad in ({"t": {"$like": "x"}}, {"$not": []}):
        with pytest.raises(ValueError):
            filtered(df, bad)


def test_index_table(spark, index):
    assert [r.id for r in fetched(index, [2, 99]).collect()] == [2]
    stats = {r.namespace: r.n_vectors for r in index_stats(index, "kind").collect()}
    assert stats == {"a": 3, "b": 3, "": 1, None: 7}
    old = spark.createDataFrame([("n", 1, 5, "old"), ("n", 2, 5, "old"), ("m", 1, 5, "old")], "ns string, id int, at int, v string")
    new = spark.createDataFrame([("n", 1, 5, "new"), ("n", 2, 4, "late"), ("n", 3, None, "first")], "ns string, id int, at int, v string")
    assert {(r.ns, r.id, r.v) for r in upserted(old, new, ["ns", "id"], "at").collect()} == {("n", 1, "new"), ("n", 2, "old"), ("m", 1, "old"), ("n", 3, "first")}


def test_pruned(spark, index):
    cells = index.withColumn("cell", F.when(F.col("id").isin(0, 2, 6), 0).otherwise(1))
    centres = [[1.0, 0.0], [0.0, 1.0]]
    assert [r.id for r in ivf_top_k(cells, [1.0, 0.0], centres, 1, 9).collect()] == [0, 2, 6]
    assert ivf_top_k(cells, [1.0, 0.0], centres, 2, 9).collect() == top_k(index, [1.0, 0.0], 9).collect()


def test_pruned_batch(spark):
    from corpusloom.operators.search import cell_centres, enough_probes, ivf_batch_top_k

    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(20, 8)), 50, axis=0) + 0.2 * rng.normal(size=(1000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [1.0]), (1002, [0.0] * 8)], "id long, values array<float>")
    queries = df.filter("id % 20 = 0")
    centres = cell_centres(df, 8)
    probes = enough_probes(df, centres)
    want = {tuple(r) for r in batch_top_k(df, queries, 8, 10, skip_self=True).collect()}
    pairs = lambda rows: {(r[0], r[2]) for r in rows}
    got = ivf_batch_top_k(df, queries, centres, probes, skip_self=True).collect()
    assert 1 < len(centres) and probes < len(centres)
    assert len(pairs(got) & pairs(want)) >= 0.9 * len(want)
    assert {tuple(r) for r in ivf_batch_top_k(df, queries, centres, len(centres), skip_self=True).collect()} == want
    assert len(cell_centres(df.limit(0), 8)) == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_recall_of_search_pruned(spark):
    from corpusloom.plans.vector_queries import DIM, _index, search_pruned

    rows = _index(spark, "/root/testdata/sf0.01")
    want = {(r.query_id, r.id) for r in batch_top_k(rows, rows.filter("id % 20 = 0"), DIM, 10, skip_self=True).collect()}
    got = {(r.query_id, r.id) for r in search_pruned(spark, "/root/testdata/sf0.01").collect()}
    assert len(want) and len(got & want) >= 0.9 * len(want)


def test_subset(spark):
    rows = spark.createDataFrame([(i, [float(i % 3), float(i // 3)], i % 2) for i in range(12)] + [(99, None, 0)], "vec_id long, embedding array<float>, label int")
    centres = label_centres(rows.filter("embedding is not null"))
    near = assigned(rows, centres, 2)
    got = medoids(near).collect()
    assert near.count() == 12 and len(got) == 2
    best = {r.cid: min((x.distance, x.vec_id) for x in near.collect() if x.cid == r.cid) for r in got}
    assert all(best[r.cid] == (r.distance, r.vec_id) for r in got)
    assert assigned(rows, centres.limit(0), 2).count() == 0
    assert members(rows.union(rows), spark.createDataFrame([(3,)], "vec_id long")).count() == 2
    nan = spark.createDataFrame([(0, 1, float("nan")), (0, 2, 0.5), (1, 3, float("nan"))], "cid long, vec_id long, distance double")
    assert [tuple(r) for r in medoids(nan).collect()] == [(0, 2, 0.5)]
    usable = rows.filter("embedding is not null")
    assert 1 <= kmeans_subset(usable, 3, 2).count() <= 3
    with pytest.raises(ValueError):
        kmeans_subset(usable, 13, 2)


def test_text_search(spark):
    from corpusloom.operators.embedding import HashingEmbedder, embedded
    from corpusloom.operators.search import text_search

    docs = spark.createDataFrame([("a", "tax law ruling"), ("b", "bread recipe"), ("c", "tax appeal")], "id string, mdtext string")
    index = embedded(docs, role="query").select(F.lit("n").alias("namespace"), "id", F.col("embedding").alias("values"), F.struct(F.col("id").alias("documentId")).alias("metadata"))
    got = text_search(index, "tax law ruling", HashingEmbedder(), 2, namespace="n").collect()
    assert got[0].id == "a" and got[0].metadata.documentId == "a" and "values" not in got[0].asDict()
    only = text_search(index, "tax law ruling", HashingEmbedder(), 2, namespace="n", condition={"metadata.documentId": {"$ne": "a"}}, include_values=True).collect()
    assert [r.id for r in only] == ["c", "b"] and len(only[0]["values"]) == 64
    assert text_search(index, "x", HashingEmbedder(), namespace="other").count() == 0
    with pytest.raises(ValueError):
        text_search(index, " ", HashingEmbedder())


def test_sql_functions(spark):
    from corpusloom.functions.register import register_functions

    assert "vector_cosine" in register_functions(spark)
    row = spark.sql("select vector_dot(array(3, 4), array(4, 3)), vector_norm(array(3, 4)), vector_cosine(array(3, 4), array(4, 3)), vector_cosine(array(0, 0), array(1, 1)), vector_distance(array(1, 2), array(2, 4)), window_count(1000, 512, 64), window_count(0, 4, 1)").first()
    assert [round(x, 9) for x in row] == [24.0, 5.0, 0.96, 0.0, 5.0, 3, 0]


def test_blocks_agree(spark, monkeypatch):
    from corpusloom.operators import search, subset

    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(300)], "id long, values array<float>").repartition(3)
    whole = sorted(map(tuple, batch_top_k(rows, rows, 4, 5, skip_self=True).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        monkeypatch.setattr(search, "QUERY_VALUES", 40)
        assert sorted(map(tuple, batch_top_k(rows, rows.limit(300), 4, 5, skip_self=True).collect())) == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    centres = rows.filter("id < 40").selectExpr("id as cid", "values as centre")
    near = sorted(map(tuple, assigned(rows, centres, 4, "id", "values").collect()))
    monkeypatch.setattr(subset, "BLOCK_VALUES", 30)
    assert sorted(map(tuple, assigned(rows, centres, 4, "id", "values").collect())) == near and len(near) == 300
    x = {r.id: np.array(r["values"]) for r in rows.collect()}
    assert all((c, d) == min((j, float(round(((x[i] - x[j]) ** 2).sum(), 6))) for j in range(40) if round(((x[i] - x[j]) ** 2).sum(), 6) == min(round(((x[i] - x[m]) ** 2).sum(), 6) for m in range(40))) for i, c, d in near)


def test_hydrated(spark, index):
    from corpusloom.operators.search import hydrated

    hits = spark.createDataFrame([(1, 0, 0.9), (2, 6, 0.8), (3, 77, 0.7), (4, None, 0.6)], "rank int, id long, score double")
    rows = spark.createDataFrame([(0, "a", 1.0), (6, "b", 2.0), (6, "c", 3.0), (None, "d", 4.0)], "row_index long, text string, score double")
    got = sorted(((r.rank, r.text, r.score, r.score_row) for r in hydrated(hits, rows, "row_index", "text", "score").collect()), key=str)
    assert got == [(1, "a", 0.9, 1.0), (2, "b", 0.8, 2.0), (2, "c", 0.8, 3.0), (3, None, 0.7, None), (4, None, 0.6, None)]
    assert hydrated(hits.limit(0), rows, "row_index", "text").count() == 0 and hydrated(hits, rows.limit(0), "row_index", "text").count() == 4


def test_no_local_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from corpusloom.session import discarded, shared_folder, written

    conf = SimpleNamespace(get=lambda *_: None)
    far = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError, match="share"):
        shared_folder(far)
    kept = written(spark.range(3).toDF("x"), "test")
    path = kept._written_to.removeprefix("file:")
    assert kept.count() == 3 and os.path.isdir(path)
    discarded(kept)
    assert not os.path.exists(path)


def test_shuffles_of_finished_work_go(spark):
    import gc
    import time

    from corpusloom.session import released, written

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    released(spark)
    time.sleep(2)
    gc.disable()
    try:
        before = shuffles()
        table = written(spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").applyInArrow(lambda t: t, "k bigint, id bigint").filter("id >= 0"), "test")
        made = shuffles() - before
        released(spark)
        end = time.time() + 20
        while made & shuffles() and time.time() < end:
            time.sleep(0.2)
        assert made and not made & shuffles() and table.count() == 1000
    finally:
        gc.enable()


def test_shuffles_are_let_go_at_once(spark):
    import gc
    import time

    from corpusloom.session import CLEANUP, written

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    gc.disable()
    try:
        before = shuffles()
        rows = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").applyInArrow(lambda t: t, "k bigint, id bigint").filter("id >= 0")
        table = written(rows, "test", let_go=True)
        end = time.time() + 10
        while shuffles() - before and time.time() < end:
            time.sleep(0.2)
        assert not shuffles() - before and spark.conf.get(CLEANUP) == "false"
        # What was written from can be used again.
        assert table.count() == 1000 and rows.count() == 1000 and written(rows, "test").count() == 1000
    finally:
        gc.enable()
