"""Operators 1 and 8 against brute force, with edge rows and groups that need
more than one tile."""

import random

import numpy as np
import pytest

import edge
from daycast.llm import jaccard, neardup_hnsw
from daycast.llm.common import components


def union(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    random.seed(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    edges += [(300 + random.randrange(80), 300 + random.randrange(80)) for _ in range(60)]
    random.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = union({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k in got} and {k for e in edges if e[0] != e[1] for k in e} == set(got)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = union(range(n), links)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root[i]] = min(ids.get(root[i], d), d)
    return sorted(((d is None, d or 0, len(sets[i]), d if not sets[i] else ids.get(root[i])) for i, (d, _) in enumerate(rows)), key=str)


def family(seed, size, words, edits):
    """Near copies: each changes a few words of the first."""
    rng = random.Random(seed)
    first = edge.prose(seed, words).split()
    out = [" ".join(first)]
    for _ in range(size - 1):
        w = list(first)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("tile", [1024, 16])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "FLUSH", 3000)
    passage = edge.prose(77, 60)
    texts = [t for s in range(6) for t in family(s, 25, 30 + 25 * s, 2 + s)]
    texts += [edge.prose(500 + i, 40) + " " + passage + " " + edge.prose(900 + i, 40) for i in range(40)]  # a shared passage links nothing
    texts += [passage + f" e{i}" for i in range(30)] + ["one two three four", "One two three FOUR", "one two three four five"]
    texts += ["a b c d e " * 40, "a b c d e " * 50]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(d, t) for d, t, _, _ in edge.ROWS]
    df = edge.frame(spark, [(d, t, None, None) for d, t in rows])
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == brute_components(rows)


def test_jaccard_all_links_and_threshold(spark):
    rows = [(i, t, None, None) for i, t in enumerate(family(4, 30, 60, 3))]
    df = edge.frame(spark, rows)
    sets = {i: shingle_set(t) for i, t, _, _ in rows}
    keys = {jaccard._key(jaccard.shingles(t.encode())): i for i, t, _, _ in rows}
    links = {tuple(sorted((keys[bytes(r["u"])], keys[bytes(r["v"])]))) for r in jaccard.class_links(df, jaccard.digests(df), every=True).collect()}
    distinct = sorted(keys.values())
    want = {(i, j) for i in distinct for j in distinct if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert links == want


def test_tile_product_in_strips_equals_brute_force():
    """Small memory for a whole tile, the same links within a block and between two."""
    import tracemalloc
    rng = np.random.default_rng(4)
    base = [rng.choice(1 << 40, 12, replace=False) for _ in range(60)]
    sets = [np.unique(np.concatenate([base[i % 60][: 12 - i % 3], rng.choice(1 << 40, i % 3)])) for i in range(1200)]
    sizes = np.array([len(s) for s in sets])
    same = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    left, right = np.arange(150), np.arange(1000, 1200)
    for a, b in ((left, left), (left, right)):
        got = set(zip(*(x.tolist() for x in jaccard._product(None, sizes, sets, a, b, 75))))
        assert got == {(i, j) for i in a.tolist() for j in b.tolist() if (a is not b or i < j) and same(i, j)}
    whole = np.arange(1024)
    tracemalloc.start()
    jaccard._product(None, sizes, sets, whole, whole, 75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6  # whole matrices of 64-bit numbers: over 20 MB


def test_keep_one_of_each_group(spark):
    df = edge.frame(spark)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    texts = [x[2] for x in ids]
    assert texts.count(edge.BASE) == 1 and edge.NEAR not in texts and texts.count("Short one") + texts.count("short ONE") == 1
    assert len(ids) == len(edge.ROWS) - 4  # two copies, one near copy, one short copy
    assert jaccard.keep_one(edge.frame(spark, [])).count() == 0


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "'x' AS c", "'y' AS links", "'z' AS shard")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_links_equal_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + 0.12 * rng.normal(size=(20, 16)) for c in centres] + [rng.normal(size=(300, 16))])
    x = x.astype(np.float32).astype(np.float64)
    x[5], x[6] = x[4], 3 * x[4]
    rows = [(1000 - i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] + [1.0] * 15, 1), (2004, [], 1),
             (2005, [float("inf")] + [0.0] * 15, 1), (2006, [1.0, 2.0], 1), (2007, [1.0, 2.0], 1), (None, x[4].tolist(), 2)]
    got = {}
    for r in neardup_hnsw.near_duplicates(vectors(spark, rows, kind), shard_rows=150, query_rows=200).collect():
        got[r["vec_id"]] = (r["n_links"], r["component_id"], r["kept"])
    good = [(d, np.array(v, np.float64)) for d, v, _ in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(i, j) for i in range(len(good)) for j in range(i) if len(good[i][1]) == len(good[j][1])
             and good[i][1] @ good[j][1] / (np.linalg.norm(good[i][1]) * np.linalg.norm(good[j][1])) >= 0.95]
    root, n = union(range(len(good)), links), [0] * len(good)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    low = {}
    for i, (d, _) in enumerate(good):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    want = {d: (0, d, True) for d, _, _ in rows}
    want.update({d: (n[i], low[root[i]], low[root[i]] == d) for i, (d, _) in enumerate(good)})
    assert got == want
    assert neardup_hnsw.near_duplicates(vectors(spark, [], kind)).count() == 0


def test_graph_recall_and_saturated_beams():
    rng = np.random.default_rng(9)
    dense = rng.normal(size=32) + 0.05 * rng.normal(size=(700, 32))  # more hits than any first beam holds
    unit = neardup_hnsw._unit(rng.permutation(np.concatenate([dense, rng.normal(size=(3000, 32))])))
    graph = neardup_hnsw.Graph(unit)
    audit = np.arange(0, 3700, 48)
    q, n, _ = neardup_hnsw.range_search(graph, unit, audit, 0.95)
    truth = (unit @ unit.T >= 0.95).sum()
    assert len(q) >= 0.98 * truth and len(set(zip(q.tolist(), n.tolist()))) == len(q)
    ids, _ = graph.search(unit[:500], 64)
    top = np.argsort(-(unit[:500] @ unit.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(top.tolist(), ids[:, :10].tolist())]) > 0.8


def test_audit_goes_by_query_and_is_never_empty():
    rng = np.random.default_rng(9)
    dense = rng.normal(size=32) + 0.05 * rng.normal(size=(700, 32))
    single = rng.normal(size=(1500, 32))
    unit = neardup_hnsw._unit(rng.permutation(np.concatenate([dense, single, single + 0.1 * rng.normal(size=single.shape)])))
    graph = neardup_hnsw.Graph(unit)
    graph.layers[0][(unit @ unit.T >= 0.95).sum(axis=1) < 50] = -1  # outside the group a beam finds its entry alone
    for x in (unit, neardup_hnsw._unit(rng.normal(size=(400, 32)))):  # many pairs by few queries; no pairs at all
        q, n, beam = neardup_hnsw.range_search(graph, x, np.arange(0, len(x), 48), 0.95)
        assert beam == 0 and len(q) == (x @ unit.T >= 0.95).sum()


def test_a_link_found_from_one_side_counts_on_both(spark, monkeypatch):
    rng = np.random.default_rng(3)
    near = rng.normal(size=(100, 16))
    x = np.concatenate([rng.normal(size=16) + 0.05 * rng.normal(size=(60, 16)), near, near + 0.03 * rng.normal(size=near.shape), near[:9]])
    x = x.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]

    def one_sided(graph, q, audit, bound, own):
        """A third scanned; the others find each link from its later end only."""
        a, b = graph.scan(q, bound)
        scanned = np.arange(len(q)) % 3 == 0
        on = scanned[a] | (b <= a)
        return a[on], b[on], 16, scanned

    monkeypatch.setattr(neardup_hnsw, "audited_search", one_sided)
    got = {r["vec_id"]: r["n_links"] for r in neardup_hnsw.near_duplicates(vectors(spark, rows, "double")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert got == dict(enumerate(((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()))
