import functools

import numpy as np
import pytest

from corpusloom.llm import clusters, neighbours, subset, vectors as vectors_module
from corpusloom.llm.clusters import cluster_profiles, markov_clusters, mutual_clusters, similarity_clusters
from corpusloom.llm.neighbours import most_similar, similar_pairs
from corpusloom.llm.subset import Features, Tree, _parted, _unlike, agglomerate, varied_subsets
from corpusloom.llm.vectors import Cells, drawn_rows, nearest_cells, pack, pairs_of, sample_size, tiled, train_cells, units, unpack, usable_and_drawn, usable_vectors

DIM = 64
SCHEMA = "id string, embedding array<float>, vec string, tile int, hash string"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "v", 1, "h") for i, v in vectors], SCHEMA)


def planted(groups, lone, seed=0, noise=0.08):
    """Groups of vectors around random directions, lone vectors, some repeated and scaled ones."""
    rng = np.random.default_rng(seed)
    out = []
    for g, n in enumerate(groups):
        centre = rng.normal(size=DIM)
        centre /= np.linalg.norm(centre)
        out += [(f"g{g:02}-{i:04}", (centre + noise * rng.normal(size=DIM) / 2) * (1 + i % 3)) for i in range(n)]
    out += [(f"l{i:04}", v) for i, v in enumerate(rng.normal(size=(lone, DIM)))]
    return [(i, v.astype(np.float16)) for i, v in out]


def cosines(vectors):
    x = np.array([v for _, v in vectors], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    return np.round(x @ x.T, 6)


def nearest_by_hand(vectors, k=3, least=0.75):
    vectors = sorted(vectors)
    ids, s = [i for i, _ in vectors], cosines(vectors)
    out = {}
    for q in range(len(ids)):
        order = [j for j in np.lexsort((np.arange(len(ids)), -s[q])) if j != q and s[q, j] >= least][:k]
        out[ids[q]] = [(ids[j], float(s[q, j])) for j in order]
    return out


def cliques_by_hand(vectors, least=0.75, size=5):
    vectors = sorted(vectors)
    linked = cosines(vectors) >= least
    return {(vectors[np.flatnonzero(r)[0]][0], i) for (i, _), r in zip(vectors, linked) if r.sum() >= size and all((linked[j] == r).all() for j in np.flatnonzero(r))}


BAD = [("n", None), ("e", []), ("s", [1.0] * 3), ("z", [0.0] * DIM), ("i", [float("inf")] + [1.0] * (DIM - 1)), ("q", [float("nan")] * DIM), (None, [1.0] * DIM)]


def test_bytes_keep_every_value():
    half = np.array([[1.5, -2.0], [0.0, 65504.0]], np.float32)
    mixed = np.array([[1.5, 0.1], [3e38, 1e-30]], np.float32)
    for x in (half, mixed, np.concatenate([half, mixed]), half[:0]):
        assert np.array_equal(unpack(pack(x), 2), x)
    sliced = pack(np.concatenate([half, half])).slice(1, 2)
    assert np.array_equal(unpack(sliced, 2), np.concatenate([half, half])[1:3])


def test_usable(spark):
    rows = table(spark, [*BAD, ("a", [1.0] * DIM), ("a", None), ("a", [1.0] * DIM), ("b", [2.0] * DIM), ("c", [3.0] * DIM), ("c", [1.0] * DIM)])
    got = {r.id: np.frombuffer(r.vec, np.float16)[0] for r in usable_vectors(rows, DIM).collect()}
    assert got["a"] == 1.0 and got["b"] == 2.0 and set(got) == {"a", "b", "c"} and got["c"] in (1.0, 3.0)
    assert usable_vectors(rows.limit(0), DIM).count() == 0


@pytest.mark.parametrize("few, names", [(50_000, ["repeated", "many"]), (10, ["repeated"])])
def test_usable_and_drawn(spark, monkeypatch, few, names):
    """Repeated ids are looked for once for the table and the rows that are drawn from it."""
    rng = np.random.default_rng(1)
    rows = table(spark, [*BAD, *((f"x{i}", rng.normal(size=DIM)) for i in range(400)), *((f"x{i}", rng.normal(size=DIM)) for i in range(0, 400, 5)), ("x7", None)])
    n, asked = 400 * 4096 // 100, []
    monkeypatch.setattr(vectors_module, "BROADCAST_IDS", few)
    monkeypatch.setattr(vectors_module, "sample_size", lambda n_rows: n_rows // 3)
    of = lambda df: {(r.id, bytes(r.vec)) for r in df.collect()}
    want = of(usable_vectors(rows, DIM)), of(usable_vectors(drawn_rows(rows, n), DIM))
    write = vectors_module.written
    monkeypatch.setattr(vectors_module, "written", lambda df, name: asked.append(name) or write(df, name))
    got = usable_and_drawn(rows, n, DIM)
    assert tuple(map(of, got)) == want and len(want[0]) == got[0].count() == 400 and 80 < len(want[1]) == got[1].count() < 200
    assert asked == names


def test_largest_and_pairs():
    rng = np.random.default_rng(2)
    x, centres = (rng.normal(size=(n, 16)).astype(np.float32) for n in (1500, 40))
    dots = x @ centres.T
    order = np.argsort(-dots, axis=1)
    for most in (1, 4, 8, 9, 40, 50):
        got = nearest_cells(x, centres, most, 100.0)
        assert np.array_equal(got, order[:, :most])
    got = nearest_cells(x, centres, 4, 0.5)
    best = np.take_along_axis(dots, order[:, :4], axis=1)
    assert np.array_equal(got, np.where(best >= best[:, :1] - np.float32(0.5), order[:, :4], -1))
    for mask in (dots > 8, dots > 1e9, dots[:0] > 0, dots[:, :0] > 0):
        assert all(map(np.array_equal, pairs_of(mask), np.nonzero(mask)))
    # Dots near the threshold are taken again in double precision.
    a = units(np.array([[1, 0, 0], [3, 4, 0], [0.6, 0.8, 1e-7]], np.float32))
    assert clusters._linked(a, a, 0.6)[0].all() and not clusters._linked(a, a, 0.6 + 1e-6)[0][0, 1]


def test_every_pair_of_a_cell_meets(spark):
    vectors = planted([40], 20)
    unit = units(np.array([v for _, v in vectors], np.float32)).astype(np.float32)
    cells = train_cells(unit, 60, block=7)
    assert cells.blocks.max() > 2
    seen = tiled(usable_vectors(table(spark, vectors), DIM), cells, DIM).select("tile", "cell", "side", "id").collect()
    by_tile, by_cell = {}, {}
    for r in seen:
        by_tile.setdefault(r.tile, []).append((r.side, r.id))
        by_cell.setdefault(r.cell, set()).add(r.id)
    met = {frozenset((a, b)) for rows in by_tile.values() for s, a in rows for t, b in rows if a != b and (s == -1 or s != t)}
    assert met == {frozenset((a, b)) for ids in by_cell.values() for a in ids for b in ids if a != b}


def test_cells_grow_with_the_table():
    sample = units(np.random.default_rng(5).normal(size=(20_000, 8))).astype(np.float32)
    cells = train_cells(sample, 1_000_000, alike=1.1)
    assert len(cells.centres) > 8000 and sample_size(2_000_000) == 320_000
    assert np.allclose(np.linalg.norm(cells.centres, axis=1), 1, atol=1e-5)
    rows = neighbours.drawn(np.arange(100_000).reshape(-1, 1), 8192)
    assert len(set(rows.ravel())) == 8192 and abs(rows.mean() - 50_000) < 2000


@pytest.fixture
def came(spark, monkeypatch):
    """Of how many vectors tables came to the driver, where 64 of a sample may and there are over 4 centres."""
    from corpusloom.llm import vectors as module

    monkeypatch.setattr(module, "FLAT", 4)
    monkeypatch.setattr(module, "PER_CENTRE", 25)
    kind, sizes = type(spark.range(1)), []
    arrow = kind.toArrow

    def seen(self):
        out = arrow(self)
        sizes.extend([out.num_rows] if "vec" in out.column_names else [])
        return out

    monkeypatch.setattr(kind, "toArrow", seen)
    return sizes


def test_clusters_from_a_large_sample(spark, came):
    vectors = planted([150, 40, 6, 5, 4], 1200) + [(f"same{i:03}", np.ones(DIM, np.float16)) for i in range(300)]
    got = [(r.cluster_id, r.id) for r in mutual_clusters(similarity_clusters(table(spark, [*vectors, *BAD, vectors[0]]), DIM)).collect()]
    want = cliques_by_hand(vectors)
    assert len(got) == len(set(got)) and set(got) == want and came and max(came) <= 128


def test_neighbours_from_a_large_sample(spark, came):
    vectors = planted([60, 30, 5, 2], 1200)
    got = {(r.id, r.other) for r in most_similar(table(spark, [*vectors, *BAD]), DIM).collect()}
    want = {(i, o) for i, n in nearest_by_hand(vectors).items() for o, _ in n}
    assert len(got & want) / len(want) >= 0.95 and came and max(came) <= 128


@pytest.mark.parametrize("block", [16_384, 60])
def test_neighbours(spark, monkeypatch, block):
    vectors = planted([120, 30, 5, 2], 200)
    vectors += [(f"copy{i:03}", vectors[3][1]) for i in range(90)]
    monkeypatch.setattr(neighbours, "train_cells", functools.partial(train_cells, block=block))
    rows = table(spark, [*vectors, *BAD, vectors[0], (vectors[1][0], None)])
    found = most_similar(rows, DIM)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.other, r.cosine))
    want = {i: n for i, n in nearest_by_hand(vectors).items() if n}
    right = sum(len(set(got.get(i, [])) & set(n)) for i, n in want.items())
    assert right / sum(map(len, want.values())) >= 0.97
    assert all(got[i] == want[i] for i in got if i.startswith("copy"))
    pairs = {(r.id_a, r.id_b) for r in similar_pairs(found).collect()}
    assert all(a < b for a, b in pairs) and pairs == {(min(i, o), max(i, o)) for i, n in got.items() for o, _ in n}


def test_neighbours_of_little(spark):
    assert most_similar(table(spark, []), DIM).count() == 0
    assert most_similar(table(spark, BAD), DIM).count() == 0
    assert most_similar(table(spark, [("a", [1.0] * DIM)]), DIM).count() == 0
    assert [(r.id, r.other, r.cosine) for r in most_similar(table(spark, [("a", [1.0] * DIM), ("b", [2.0] * DIM)]), DIM).orderBy("id").collect()] == [("a", "b", 1.0), ("b", "a", 1.0)]


@pytest.mark.parametrize("block", [16_384, 40])
def test_clusters(spark, monkeypatch, block):
    vectors = planted([150, 40, 6, 5, 4], 150)
    vectors += [(f"same{i}", vectors[-1][1]) for i in range(7)]
    # A chain: neighbours are linked, its ends are not.
    turn = np.radians(25)
    chain = [(f"chain{i}", np.array([np.cos(i * turn), np.sin(i * turn)] + [0.0] * (DIM - 2), np.float16)) for i in range(7)]
    vectors += chain
    monkeypatch.setattr(clusters, "train_cells", functools.partial(train_cells, block=block))
    monkeypatch.setattr(clusters, "BLOCK", block)
    rows = table(spark, [*vectors, *BAD, vectors[0]])
    found = similarity_clusters(rows, DIM)
    got = {(r.cluster_id, r.id) for r in mutual_clusters(found).collect()}
    want = cliques_by_hand(vectors)
    assert got == want and len({c for c, _ in want}) >= 5
    profiles = {r.cluster_id: r for r in cluster_profiles(found).collect()}
    sizes = {}
    for c, _ in want:
        sizes[c] = sizes.get(c, 0) + 1
    assert all(profiles[c].n_members == n and len(profiles[c].typical_ids) == 3 and (c, profiles[c].typical_ids[0]) in want for c, n in sizes.items())


@pytest.mark.parametrize("centres, held", [(60, 32_768), (60, 100), (10_000, 100)])
def test_clusters_that_share_no_cell(spark, monkeypatch, centres, held):
    """Each vector in one of many cells, or all but alone in it: what has no link there gets a second chance, and whole groups
    are found from any two linked members."""
    vectors = planted([80, 40, 12, 6, 5, 4], 100, noise=0.1)
    first = vectors[0][1].astype(float) / np.linalg.norm(vectors[0][1].astype(float))
    across = np.eye(DIM)[0] - first[0] * first
    # Linked with some members of the first group only.
    vectors.append(("outside", (0.75 * first + 0.66 * across / np.linalg.norm(across)).astype(np.float16)))
    calls = []

    def scattered(sample, n, most, margin):
        calls.append(n)
        if len(calls) > 1:
            return train_cells(sample, n, most, margin)
        chosen = sample[np.random.default_rng(3).permutation(len(sample))[:centres]]
        return Cells(chosen, np.ones(len(chosen), np.int64), 1, 0.0)

    monkeypatch.setattr(clusters, "train_cells", scattered)
    monkeypatch.setattr(clusters, "HELD", held)
    monkeypatch.setattr(clusters, "BLOCK", 30)
    got = [(r.cluster_id, r.id) for r in mutual_clusters(similarity_clusters(table(spark, vectors), DIM)).collect()]
    want = cliques_by_hand(vectors)
    assert len(got) == len(set(got)) and set(got) == want and len({c for c, _ in want}) >= 3 and len(calls) == 2


@pytest.mark.parametrize("block", [16_384, 25])
def test_clusters_that_are_no_cliques(spark, monkeypatch, block):
    """Two crowded arcs, each too wide for all of its vectors to be linked, with a bridge: the flow parts them, as it does on the whole graph."""
    rng = np.random.default_rng(9)
    degrees = np.concatenate([rng.uniform(0, 50, 60), rng.uniform(80, 130, 60), [65.0]])
    x = np.stack([np.cos(np.radians(degrees)), np.sin(np.radians(degrees))], axis=1)
    vectors = [(f"v{i:03}", np.concatenate([v, np.zeros(DIM - 2)]).astype(np.float16)) for i, v in enumerate(x)] + [(f"twin{i}", np.concatenate([x[3], np.zeros(DIM - 2)]).astype(np.float16)) for i in range(20)]
    monkeypatch.setattr(clusters, "train_cells", functools.partial(train_cells, block=block))
    monkeypatch.setattr(clusters, "BLOCK", 50)
    found = similarity_clusters(table(spark, vectors), DIM)
    got = {}
    for r in found.members.collect():
        got.setdefault(r.cluster, set()).add(r.id)
    ordered = sorted(vectors)
    linked = cosines(ordered) >= 0.75
    edges = [(i, j, 1.0) for i, j in zip(*np.nonzero(linked)) if i < j]
    flow = by_hand_mcl(len(ordered), edges, {})
    want = {}
    for i, to in enumerate(flow):
        want.setdefault(to, set()).add(ordered[i][0])
    assert set(map(frozenset, got.values())) == set(map(frozenset, want.values()))
    # Linked all the way, so that without the flow they would be one group, and none of them is mutual.
    reach = np.linalg.matrix_power(linked.astype(float), 12) > 0
    assert reach[0].all() and 2 <= len(got) <= 4 and found.rounds > 1 and found.settled
    assert mutual_clusters(found).count() == 0
    profiles = cluster_profiles(found).collect()
    assert sorted(r.n_members for r in profiles) == sorted(map(len, got.values())) and all(set(r.typical_ids) <= next(g for g in got.values() if r.cluster_id in g) for r in profiles)


def test_clusters_of_little(spark):
    for few in ([], BAD, [("a", [1.0] * DIM)]):
        found = similarity_clusters(table(spark, few), DIM)
        assert mutual_clusters(found).count() == 0 and cluster_profiles(found).count() == 0


def by_hand_mcl(n, edges, loops, inflation=2.0, least=0.004):
    m = np.diag([loops.get(i, 1.0) for i in range(n)]).astype(float)
    for a, b, w in edges:
        m[a, b] = m[b, a] = w
    keep = lambda x: np.where((x >= least) | (x == x.max(axis=0)), x, 0) / np.where((x >= least) | (x == x.max(axis=0)), x, 0).sum(axis=0)
    m = keep(m / m.sum(axis=0))
    for _ in range(60):
        m = (m @ m) ** inflation
        m = keep(m / m.sum(axis=0))
    top = np.round(m, 6).argmax(axis=0)
    return [int(top[top[j]]) for j in range(n)]


def test_markov_clustering(spark):
    edges = [(0, 1, 1.0), (1, 2, 1.0), (0, 2, 1.0), (2, 3, 0.1), (3, 4, 1.0), (4, 5, 1.0), (3, 5, 1.0), *[(6, i, 2.0) for i in range(7, 60)]]
    df = spark.createDataFrame([(f"{a:02}", f"{b:02}", w) for a, b, w in edges], "a string, b string, w double")
    none = spark.createDataFrame([], "node string, w double")
    flow = markov_clusters(df, none)
    got = {int(r.node): int(r.attractor) for r in flow.settled.collect()}
    want = by_hand_mcl(60, edges, {})
    same = lambda of: {frozenset(i for i in range(60) if of[i] == of[j]) for j in range(60)}
    assert same(got) == same(want) and flow.unrest < 1e-4
    stopped = markov_clusters(df, none, most_rounds=1)
    assert stopped.rounds == 1 and stopped.unrest >= 1e-4
    assert markov_clusters(df.limit(0), none).settled.count() == 0


@pytest.mark.parametrize("dense", [2048, 40])
def test_markov_clustering_drops_nothing(spark, monkeypatch, dense):
    """Two arcs of points with links to all that are near, of which more than 250 share a column's flow, a chain and a star of 303 nodes: the
    clusters of the whole matrix, whether it is held by a task or multiplied in stripes."""
    monkeypatch.setattr(clusters, "DENSE", dense)
    monkeypatch.setattr(clusters, "VALUES", 40_000)
    monkeypatch.setattr(clusters, "STRIPE", 100_000)
    rng = np.random.default_rng(1)
    at = np.concatenate([rng.uniform(0, 50, 300), rng.uniform(80, 130, 300), [65.0]])
    edges = [(i, j, 1.0) for i in range(601) for j in range(i) if abs(at[i] - at[j]) <= 41.4]
    edges += [(i, i + 1, 1.0) for i in range(700, 730)] + [(800, i, 1.0) for i in range(801, 1103)]
    df = spark.createDataFrame([(f"{a:04}", f"{b:04}", w) for a, b, w in edges], "a string, b string, w double")
    flow = markov_clusters(df, spark.createDataFrame([], "node string, w double"))
    rows = flow.settled.collect()
    got = {int(r.node): int(r.attractor) for r in rows}
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    number = {x: i for i, x in enumerate(nodes)}
    want = by_hand_mcl(len(nodes), [(number[a], number[b], w) for a, b, w in edges], {}, least=0)
    same = lambda of: {frozenset(j for j in of if of[j] == of[i]) for i in of}
    assert len(rows) == len(nodes) and same(got) == same({x: nodes[want[i]] for x, i in number.items()}) and flow.unrest < 1e-4
    assert len({got[i] for i in range(601)}) == 2


def test_clusters_of_many_links(spark):
    """Vectors with hundreds of links each, all with links of their own."""
    rng = np.random.default_rng(1)
    x = np.zeros((1400, DIM))
    x[:, :8] = 0.2 * rng.normal(size=(1400, 8))
    x[:700, 0] += 1
    x[700:, :2] += [0.45, 0.9]
    vectors = [(f"v{i:04}", v.astype(np.float16)) for i, v in enumerate(x)]
    linked = cosines(vectors) >= 0.75
    flow = by_hand_mcl(len(vectors), [(i, j, 1.0) for i, j in zip(*np.nonzero(linked)) if i < j], {}, least=0)
    got, want = {}, {}
    for r in similarity_clusters(table(spark, vectors), DIM).members.collect():
        got.setdefault(r.cluster, set()).add(r.id)
    for (i, _), to in zip(vectors, flow):
        want.setdefault(to, set()).add(i)
    assert linked.sum(axis=0).max() > 251 and len(want) == 2 and set(map(frozenset, got.values())) == set(map(frozenset, want.values()))


def test_nodes_of_several_vertices(spark):
    """A node for vertices with the same links gives what the vertices give."""
    rng = np.random.default_rng(2)
    sizes = {i: int(rng.integers(1, 6)) for i in range(14)}
    pairs = {tuple(sorted(map(int, rng.choice(14, 2, replace=False)))) for _ in range(22)}
    vertices = [(i, c) for i in range(14) for c in range(sizes[i])]
    whole = [(vertices.index(x), vertices.index(y), 1.0) for x in vertices for y in vertices if x < y and (x[0] == y[0] or tuple(sorted((x[0], y[0]))) in pairs)]
    want = by_hand_mcl(len(vertices), whole, {}, least=0)
    edges = spark.createDataFrame([(f"{a:02}", f"{b:02}", 1.0) for a, b in pairs], "a string, b string, w double")
    own = spark.createDataFrame([(f"{i:02}", float(n)) for i, n in sizes.items()], "node string, w double")
    got = {int(r.node): int(r.attractor) for r in markov_clusters(edges, own, least=0.0).settled.collect()}
    for x in vertices:
        for y in vertices:
            if x[0] in got and y[0] in got:
                assert (got[x[0]] == got[y[0]]) == (vertices[want[vertices.index(x)]][0] == vertices[want[vertices.index(y)]][0])


def test_centres_in_groups(monkeypatch):
    from corpusloom.llm import vectors as module

    rng = np.random.default_rng(4)
    centres = units(rng.normal(size=(600, 16))).astype(np.float32)
    x = units(rng.normal(size=(500, 16))).astype(np.float32)
    want = module.Centres.of(centres).nearest(x, 3, 0.2)
    monkeypatch.setattr(module, "FLAT", 64)
    grouped = module.Centres.of(centres)
    got = grouped.nearest(x, 3, 0.2)
    assert len(grouped.lists) > 10 and sorted(np.concatenate(grouped.lists)) == list(range(600))
    assert (got[:, 0] == want[:, 0]).mean() > 0.97 and module.sample_size(10**10) == 16 * 65_536
    sample = units(rng.normal(size=(4000, 16))).astype(np.float32)
    cells = train_cells(sample, 10**6, alike=0.9)
    assert 1000 < len(cells.centres) <= 4000


def test_ward_by_rounds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 4)).astype(np.float32)
    f = Features(x, np.ones(40), np.ones(40, np.int64), np.zeros(40, bool))
    _, merges = agglomerate(f, 1, 2.0)
    steps = sorted((c, a, b) for m in merges for a, b, c in zip(*(v.tolist() for v in m)))
    groups = [[i] for i in range(40)]
    for k in (30, 10, 3):
        while len(groups) > k:
            cost = [(len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
            _, i, j = min(cost)
            groups[i] += groups.pop(j)
        up = _parted(40, [(a, b) for _, a, b in steps[: 40 - k]])
        assert {frozenset(g) for g in groups} == {frozenset(np.flatnonzero(up == g).tolist()) for g in np.unique(up)}


def test_tree():
    rng = np.random.default_rng(8)
    centres = units(rng.normal(size=(90, DIM)))
    x = units(centres[rng.integers(90, size=3000)] + 0.03 * rng.normal(size=(3000, DIM))).astype(np.float32)
    tree = Tree(DIM, 1000, 0.75)
    tree.add(x)
    assert 90 <= len(tree.f) <= 120 and tree.f.count.sum() == 3000 and np.bincount(tree.node).max() <= 32 and tree.f.tight.all()
    small = Tree(DIM, 40, 0.75)
    small.add(x)
    assert len(small.f) <= 40 and small.f.count.sum() == 3000 and len(small.node) == len(small.f)
    # Many equal vectors: one entry.
    same = Tree(DIM, 40, 0.75)
    same.add(np.tile(x[:1], (5000, 1)))
    assert len(same.f) == 1 and same.f.count[0] == 5000


def test_unlike():
    x = units(np.array([[1, 0], [1, 0.01], [0, 1], [0.02, 1], [-1, 0]]))
    assert _unlike(x, 3, 0.75).tolist() == [0, 2, 4] and _unlike(x, 4, 0.75).tolist() == [0, 2, 4, 1] and _unlike(x[:1], 3, 0.75).tolist() == [0]


@pytest.mark.parametrize("cell_rows", [2048, 30])
def test_subsets(spark, cell_rows):
    vectors = planted([200, 60, 20, 8], 60)
    vectors += [(f"same{i:02}", vectors[0][1]) for i in range(40)]
    sizes = spark.createDataFrame([("a", 4), ("b", 50), ("c", 388), ("all", 388), ("more", 389), ("none", 0), ("null", None)], "subset_name string, n_select int")
    rows = table(spark, [*vectors, *BAD, vectors[0]]).repartition(3)
    assert len(vectors) == 388
    got = {}
    for r in varied_subsets(rows, sizes, DIM, cell_rows=cell_rows).collect():
        got.setdefault(r.subset_name, []).append(r.id)
    assert {k: (len(v), len(set(v))) for k, v in got.items()} == {"a": (4, 4), "b": (50, 50), "c": (388, 388), "all": (388, 388)}
    groups = [i.split("-")[0] for i in got["b"] if i.startswith("g")]
    assert set(groups) == {"g00", "g01", "g02", "g03"} and max(map(groups.count, groups)) <= 3
    # However the rows are partitioned, the same ids come out.
    again = {}
    for r in varied_subsets(rows.repartition(7, "tile", "id"), sizes, DIM, cell_rows=cell_rows).collect():
        again.setdefault(r.subset_name, []).append(r.id)
    assert {k: sorted(v) for k, v in again.items()} == {k: sorted(v) for k, v in got.items()}
    assert varied_subsets(rows.limit(0), sizes, DIM).count() == 0 and varied_subsets(rows, sizes.limit(0), DIM).count() == 0


def test_subsets_that_lack_many(spark, monkeypatch):
    """Those that make up the number are picked by the same rule however many are missing: unlike each other first, the farthest of the others then."""
    vectors = [(f"{n}{i}", v) for n, noise in enumerate((0.02, 0.05, 0.1, 0.14)) for i, v in planted([40, 40, 40], 0, seed=n, noise=noise)]
    rows, sizes = table(spark, vectors), spark.createDataFrame([("a", 60), ("all", 480)], "subset_name string, n_select int")
    got = []
    for most in (20_000, 7):
        monkeypatch.setattr(subset, "PICKED", most)
        got.append(sorted((r.subset_name, r.id) for r in varied_subsets(rows, sizes, DIM).collect()))
    assert got[0] == got[1] and len(set(got[0])) == 540
    wanted = [("far", 0.9, 0), ("next", 0.8, 0), ("other", 0.1, 1), ("last", 0.05, 2), ("near", 0.01, 0)]
    few = usable_vectors(table(spark, [(i, np.eye(DIM)[a]) for i, _, a in wanted]), DIM).join(spark.createDataFrame([(i, far) for i, far, _ in wanted], "id string, far double"), "id")
    few = few.select("far", "id", "vec")
    monkeypatch.setattr(subset, "PICKED", 1)
    picked = lambda n: sorted(r.id for r in subset._filled(few, n, 0.75, DIM).collect())
    assert picked(2) == ["far", "other"] and picked(3) == ["far", "last", "other"] and picked(4) == ["far", "last", "next", "other"]
