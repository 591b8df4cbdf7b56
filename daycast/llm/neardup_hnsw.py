"""Embedding near-duplicates: hierarchical navigable small-world graphs per shard.

Vectors with equal values are one class (they link by definition and need no
search). Classes are dealt to shards by hash; every shard builds one graph, and
every block of queries searches every shard. A query's beam is widened while it
holds nothing but hits; queries whose beam would pass ``MAX_BEAM`` are answered
by the exact scan. Per (shard, block) the others are audited: sampled queries
that have links, and ``PROBES`` vectors at the threshold from nodes of the graph,
so there is always something to find. All beams are widened until the mean recall
of a query, its own vector left out, reaches ``AUDIT_RECALL`` for both; blocks
whose audit still fails at ``MAX_BEAM`` are scanned, so no cap drops a link.
Candidates are verified by cosine in double precision; a link that one side found
counts for both; links are united into components.

Graph: nodes are inserted in hash order, in batches that search the graph so
far together; layer l holds the first 1/16^l of the nodes; neighbours are chosen
for closeness and diversity, links go both ways and are pruned the same way.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link; rows of
one id or without an id stay rows of their own (a component without ids has a
null component id); other columns are ignored; an empty table gives an empty
result.

Scale: a shard's graph (tens of MB) meets a block of queries in one task; a task
returns a row per query, a spanning forest of its links and the pairs of queries
that were not scanned (under ``MAX_BEAM`` each), never all pairs of a large group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import components, cut

THRESHOLD = 0.95
SHARD_ROWS = 131_072  # every query searches every shard: few large ones (64 dimensions: 50 MB) cost least
QUERY_ROWS = 32_768   # a shard's graph goes to every block of queries
LEAST_ROWS = 8_192    # smaller blocks, down to this, where there would be fewer groups than tasks
M, M0 = 12, 24
BUILD_BEAM = 24
FIRST_BEAM, MAX_BEAM = 16, 256
AUDIT_RECALL = 0.98
AUDIT_EVERY = 48  # about one query in so many, up to one in AUDIT_MOST while few of them have links
AUDIT_MOST, AUDIT_LINKED = 16, 64
PROBES = 256
SLACK = 1e-3  # of the single-precision search below the threshold
STEP_QUERIES = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


class Graph:
    """Layers of neighbour lists over unit vectors, nodes in insertion order."""

    def __init__(self, unit: np.ndarray):
        self.v = unit
        n, sizes = len(unit), []
        while True:
            sizes.append(n)
            if n <= 32:
                break
            n = -(-n // 16)
        self.layers = [np.full((s, M0 if i == 0 else M), -1, np.int32) for i, s in enumerate(sizes)]
        for level in range(len(sizes) - 1, -1, -1):
            self._fill(level)

    @classmethod
    def of(cls, unit, layers):
        g = cls.__new__(cls)
        g.v, g.layers = unit, layers
        return g

    def _fill(self, level: int):
        """Insert a layer's nodes; the layers above are complete."""
        links = self.layers[level]
        n, width = links.shape
        have = 0
        while have < n:
            take = min(n - have, max(32, min(have, STEP_QUERIES)))
            new = np.arange(have, have + take)
            x = self.v[new]
            among = x @ x.T
            np.fill_diagonal(among, -2)
            k = min(take - 1, BUILD_BEAM)
            near = np.argpartition(-among, max(0, k - 1), axis=1)[:, :k] if k > 0 else np.zeros((take, 0), np.int64)
            ids, sims = new[near], np.take_along_axis(among, near, axis=1)
            if have:
                got, got_sims = self._beam(x, level, self._entries(x, level, have), BUILD_BEAM, have)
                ids, sims = np.concatenate([got, ids], axis=1), np.concatenate([got_sims, sims], axis=1)
            chosen = self._choose(ids, sims, width)
            links[new] = chosen
            have += take
            self._link_back(links, new, chosen)

    def _choose(self, ids, sims, width):
        """Closest candidates that are closer to the node than to one chosen
        before; free places go to the closest of the others."""
        order = np.argsort(-np.where(ids >= 0, sims, -3), axis=1, kind="stable")[:, :48]
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        out = np.full((len(ids), width), -1, np.int32)
        for at in range(0, len(ids), 256):
            i, s = ids[at:at + 256], sims[at:at + 256]
            c = self.v[np.maximum(i, 0)]
            between = c @ c.transpose(0, 2, 1)
            good = np.zeros(i.shape, bool)
            for j in range(i.shape[1]):
                worst = np.where(good, between[:, j], -2).max(axis=1, initial=-2)
                good[:, j] = (i[:, j] >= 0) & (s[:, j] > worst) & (good.sum(axis=1) < width)
            rank = np.where(i < 0, 2, np.where(good, 0, 1)) * 100 + np.arange(i.shape[1])
            best = np.argsort(rank, axis=1, kind="stable")[:, :width]
            out[at:at + 256, :best.shape[1]] = np.take_along_axis(i, best, axis=1)
        return out

    def _link_back(self, links, new, chosen):
        src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        src, dst = np.concatenate([src, links[np.unique(dst)].ravel()]), np.concatenate([dst, np.repeat(np.unique(dst), links.shape[1])])
        ok = (src >= 0) & (src != dst)
        pairs = np.unique(dst[ok].astype(np.int64) << 32 | src[ok])
        dst, src = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int64)
        sims = np.einsum("ij,ij->i", self.v[dst], self.v[src])
        order = np.lexsort((-sims, dst))
        dst, src, sims = dst[order], src[order], sims[order]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(first, count)
        fit = place < 48
        row = np.repeat(np.arange(len(nodes)), count)
        ids, near = np.full((len(nodes), 48), -1, np.int64), np.full((len(nodes), 48), -3.0, np.float32)
        ids[row[fit], place[fit]], near[row[fit], place[fit]] = src[fit], sims[fit]
        few = count <= links.shape[1]
        links[nodes[few]] = ids[few][:, :links.shape[1]]
        if (~few).any():
            links[nodes[~few]] = self._choose(ids[~few], near[~few], links.shape[1])

    def _entries(self, x, level, have):
        """One entry per query: greedy descent through the layers above."""
        at = np.zeros(len(x), np.int64)
        for up in range(len(self.layers) - 1, level, -1):
            got, _ = self._beam(x, up, at, 4, len(self.layers[up]))
            at = got[:, 0]
        return np.where(at < have, at, 0)

    def _beam(self, x, level, entry, beam, have):
        """Best nodes ``(ids, sims)`` of each query, closest first; all queries
        go one expansion a step."""
        links, q = self.layers[level], len(x)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -2.0, np.float32)
        ids[:, 0], sims[:, 0] = entry, np.einsum("ij,ij->i", self.v[entry], x)
        open_ = np.zeros((q, beam), bool)
        open_[:, 0] = True
        seen = np.zeros((q, have + 1), bool)  # the last place stands for no node
        seen[np.arange(q), entry], seen[:, have] = True, True
        live = np.arange(q)
        while len(live):
            score = np.where(open_[live], sims[live], -3)
            best = score.argmax(axis=1)
            on = score[np.arange(len(live)), best] > -3
            live, best = live[on], best[on]
            if not len(live):
                break
            open_[live, best] = False
            near = links[ids[live, best]].astype(np.int64)
            near[(near < 0) | (near >= have)] = have
            fresh = ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            s = np.matmul(self.v[np.minimum(near, have - 1)], x[live][:, :, None])[:, :, 0]
            s = np.where(fresh, s, -2).astype(np.float32)
            all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
            all_sims = np.concatenate([sims[live], s], axis=1)
            all_open = np.concatenate([open_[live], fresh], axis=1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live] = np.take_along_axis(all_ids, keep, axis=1), np.take_along_axis(all_sims, keep, axis=1)
            open_[live] = np.take_along_axis(all_open, keep, axis=1) & (sims[live] > -2)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)

    def search(self, x, beam):
        return self._beam(x, 0, self._entries(x, 0, len(self.v)), min(beam, len(self.v)), len(self.v))

    def scan(self, x, bound):
        """Exact: ``(query, node)`` of all pairs of at least ``bound``."""
        out = [np.nonzero(x[i:i + 256] @ self.v.T >= bound) for i in range(0, max(1, len(x)), 256)]
        return (np.concatenate([a + 256 * k for k, (a, _) in enumerate(out)]), np.concatenate([b for _, b in out]))


def _probes(graph: Graph, cosine: float) -> np.ndarray:
    """Vectors at ``cosine`` from nodes of the graph, in random directions."""
    rng = np.random.default_rng(11)
    node = graph.v[rng.permutation(len(graph.v))[:PROBES]].astype(np.float64)
    away = rng.normal(size=node.shape)
    away -= (away * node).sum(axis=1, keepdims=True) * node
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-9)
    return _unit(cosine * node + np.sqrt(1 - cosine * cosine) * away)


def _recall(truth: tuple, found: tuple, scanned: np.ndarray) -> float | None:
    """Mean over the queries that have links and were not scanned; None without
    any. Pairs are ``(query, node)``."""
    pairs = np.unique(found[0].astype(np.int64) << 32 | found[1])
    on = ~scanned[truth[0]]
    q, n = truth[0][on].astype(np.int64), truth[1][on]
    if not len(q):
        return None
    per = np.bincount(q)
    return float((np.bincount(q, np.isin(q << 32 | n, pairs))[per > 0] / per[per > 0]).mean())


def _widened(graph: Graph, x: np.ndarray, beam: int, bound: float):
    """``(query, node)`` of at least ``bound`` from ``beam`` on, and which
    queries were scanned."""
    pairs, todo, width = [], np.arange(len(x)), beam
    while len(todo) and width <= MAX_BEAM and width < len(graph.v):
        full = []
        for at in range(0, len(todo), STEP_QUERIES):
            some = todo[at:at + STEP_QUERIES]
            ids, sims = graph.search(x[some], width)
            hit = sims >= bound
            whole = hit.all(axis=1)  # nothing but hits: there may be more
            full.append(some[whole])
            hit[whole] = False
            r, c = np.nonzero(hit)
            pairs.append((some[r], ids[r, c]))
        todo, width = np.concatenate(full), 2 * width
    scanned = np.zeros(len(x), bool)
    scanned[todo] = True
    if len(todo):
        q, n = graph.scan(x[todo], bound)
        pairs.append((todo[q], n))
    q, n = (np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, np.int64) for i in (0, 1))
    return q, n, scanned


def audited_search(graph: Graph, x: np.ndarray, audit: np.ndarray, bound: float, own: np.ndarray | None = None):
    """``(query, node, beam, scanned)``: pairs of at least ``bound``, the beam at
    which the audit passed (0: exact scan) and the queries that were scanned.
    ``own``: each query's own node, -1 without one."""
    own = np.full(len(x), -1) if own is None else own

    def truth_of(some):
        q, n = graph.scan(x[some], bound)
        other = n != own[some[q]]
        return some[q[other]], n[other]

    truth = truth_of(audit)
    step = AUDIT_EVERY
    while step > AUDIT_MOST and len(np.unique(truth[0])) < AUDIT_LINKED:
        step = max(AUDIT_MOST, step // 2)
        more = np.setdiff1d(np.arange(0, len(x), step), audit)
        got = truth_of(more)
        truth = np.concatenate([truth[0], got[0]]), np.concatenate([truth[1], got[1]])
        audit = np.concatenate([audit, more])
    probes = _probes(graph, min(1.0, bound + SLACK))
    probe_truth = graph.scan(probes, bound)
    beam = FIRST_BEAM
    while beam <= MAX_BEAM:
        # the audit's own queries first: a beam that fails is not tried on the others
        some = np.unique(np.concatenate([audit, truth[0]]))
        a, b, scanned = _widened(graph, x[some], beam, bound)
        place = np.searchsorted(some, truth[0])
        real = _recall((place, truth[1]), (a, b), scanned)
        p, r, probes_scanned = _widened(graph, probes, beam, bound)
        planted = _recall(probe_truth, (p, r), probes_scanned)
        if (real is None or real >= AUDIT_RECALL) and (probes_scanned.all() or planted is not None and planted >= AUDIT_RECALL):
            q, n, scanned = _widened(graph, x, beam, bound)
            return q, n, beam, scanned
        beam *= 2
    q, n = graph.scan(x, bound)
    return q, n, 0, np.ones(len(x), bool)


def range_search(graph: Graph, x: np.ndarray, audit: np.ndarray, bound: float):
    """``(query, node, beam)`` of ``audited_search``."""
    return audited_search(graph, x, audit, bound)[:3]


def _classes(kind: str):
    dtype = np.float32 if kind == "float" else np.float64

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, values = [], []
            for e in pdf["e"]:
                v = None if e is None or not len(e) or any(y is None for y in e) else np.asarray(e, dtype)
                if v is None or not np.isfinite(v).all() or not v.any() or not np.isfinite(np.square(v.astype(np.float64)).sum()):
                    keys.append(None)
                    values.append(None)
                else:
                    raw = (v + dtype(0)).tobytes()  # -0 and 0 are one value
                    keys.append(xxhash.xxh3_128_digest(raw))
                    values.append(raw)
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "c": keys, "v": values, "d": [0 if v is None else len(v) // dtype().itemsize for v in values]})
    return run, dtype


def _build(dtype):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c").reset_index(drop=True)  # keys are hashes: a random order, the same in every run
        x = np.stack([np.frombuffer(v, dtype) for v in pdf["v"]])
        g = Graph(_unit(x))
        return pd.DataFrame({"d": [pdf["d"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "n": [len(x)], "keys": [b"".join(pdf["c"])],
                             "sizes": [pdf["size"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()],
                             "links": [[layer.tobytes() for layer in g.layers]]})
    return run


#: A row per query (``links`` of a scanned one), the forest ``u, v``, and links
#: ``a`` to ``b`` of weight ``w``, whose ``b`` is of shard ``side``.
FOUND = "c binary, shard long, links long, scanned boolean, u binary, v binary, a binary, b binary, w long, side long, beam long"


def _search(dtype, threshold):
    def run(queries: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in FOUND.split(", ")]
        if not len(queries) or not len(graphs):
            return pd.DataFrame([], columns=columns)
        g = graphs.iloc[0]
        queries = queries.sort_values("c").reset_index(drop=True)
        n, d = int(g["n"]), int(g["d"])
        x = np.frombuffer(g["x"], dtype).reshape(n, d)
        layers = [np.frombuffer(b, np.int32).reshape(-1, M0 if i == 0 else M) for i, b in enumerate(g["links"])]
        graph = Graph.of(_unit(x), layers)
        q = np.stack([np.frombuffer(v, dtype) for v in queries["v"]])
        keys, own = [g["keys"][16 * i:16 * i + 16] for i in range(n)], queries["c"].tolist()
        sample = np.array([i for i, k in enumerate(own) if k[0] % AUDIT_EVERY == 0 or i < 8], np.int64)
        node_of = {k: i for i, k in enumerate(keys)}
        a, b, beam, scanned = audited_search(graph, _unit(q), sample, threshold - SLACK, np.array([node_of.get(k, -1) for k in own]))
        links, parent, edges, pairs = np.zeros(len(q), np.int64), {}, [], []
        weight, home, here = queries["size"].tolist(), queries["home"].tolist(), int(g["shard"])
        sizes = np.frombuffer(g["sizes"], np.int64)

        def find(k):
            while parent.get(k, k) != k:
                parent[k] = parent.get(parent[k], parent[k])
                k = parent[k]
            return k

        qn, xn = np.linalg.norm(q.astype(np.float64), axis=1), np.linalg.norm(x.astype(np.float64), axis=1)
        for at in range(0, len(a), 100_000):
            i, j = a[at:at + 100_000], b[at:at + 100_000]
            cosine = np.einsum("ij,ij->i", q[i].astype(np.float64), x[j].astype(np.float64)) / (qn[i] * xn[j])
            for s, t in zip(i[cosine >= threshold].tolist(), j[cosine >= threshold].tolist()):
                if own[s] == keys[t]:
                    continue
                if scanned[s]:
                    links[s] += sizes[t]
                else:
                    pairs += [(own[s], keys[t], int(sizes[t]), here), (keys[t], own[s], weight[s], home[s])]
                p, r = find(own[s]), find(keys[t])
                if p != r:
                    parent[max(p, r)] = min(p, r)
                    edges.append((own[s], keys[t]))
        out = pd.DataFrame({"c": own, "shard": here, "links": links, "scanned": scanned, "beam": beam})
        return pd.concat([out, pd.DataFrame(edges, columns=["u", "v"], dtype=object),
                          pd.DataFrame(pairs, columns=["a", "b", "w", "side"], dtype=object)], ignore_index=True).reindex(columns=columns).astype(
            {"shard": "Int64", "links": "Int64", "scanned": "boolean", "beam": "Int64", "w": "Int64", "side": "Int64"})
    return run


def _returned(dtype, threshold):
    """Links of scanned queries seen from the other side, where that searched
    by beam."""
    def run(searched: pd.DataFrame, scanned: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(searched) and len(scanned):
            x, y = (np.stack([np.frombuffer(v, dtype) for v in f["v"]]).astype(np.float64) for f in (searched, scanned))
            xn, yn = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            ux, uy = _unit(x), _unit(y)
            for at in range(0, len(x), 256):
                i, j = np.nonzero(ux[at:at + 256] @ uy.T >= threshold - SLACK)
                i += at
                on = np.einsum("ij,ij->i", x[i], y[j]) / (xn[i] * yn[j]) >= threshold
                out.append(pd.DataFrame({"a": searched["c"].to_numpy()[i[on]], "b": scanned["c"].to_numpy()[j[on]],
                                         "w": scanned["size"].to_numpy()[j[on]], "side": scanned["home"].to_numpy()[j[on]]}))
            return pd.concat(out)[["a", "b", "w", "side"]]
        return pd.DataFrame([], columns=["a", "b", "w", "side"])
    return run


def _link_counts(found: DataFrame, dealt: DataFrame, dtype, threshold: float) -> DataFrame:
    """``c, links``: a link counts on both sides, whichever search found it.
    Scanned queries know all their links in a shard; for the others the pairs
    that either side found are united."""
    scanned = found.where("scanned").select("c", "shard")
    pairs = found.where("a IS NOT NULL").select("a", "b", "w", "side")
    vectors = dealt.select("c", "d", "v", "size", F.col("shard").alias("home"))
    if not scanned.isEmpty():
        far = scanned.join(vectors, "c").withColumnRenamed("shard", "other")
        far = far.toDF(*far.columns)  # columns of its own: both sides come from one table
        near = found.where("NOT scanned").select("c", F.col("shard").alias("other")).join(vectors, "c")
        # shard pairs, so at most the square of the shards
        met = far.select("d", F.col("home").alias("other"), F.col("other").alias("home")).distinct()
        near = near.join(met, ["d", "other", "home"], "left_semi")
        pairs = pairs.unionAll(near.groupBy("d", "home", "other").cogroup(far.groupBy("d", "other", "home")).applyInPandas(
            _returned(dtype, threshold), "a binary, b binary, w long, side long"))
    known = scanned.select(F.col("c").alias("a"), F.col("shard").alias("side"))
    counted = pairs.distinct().join(known, ["a", "side"], "left_anti").select(F.col("a").alias("c"), F.col("w").alias("links"))
    return found.where("c IS NOT NULL").select("c", "links").unionAll(counted).groupBy("c").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS,
                    query_rows: int = QUERY_ROWS, embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    spark = vectors.sparkSession
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    run, dtype = _classes(kind)
    # rows of one small file would else be one task
    spread = vectors.select("vec_id", F.col(embedding).alias("e")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = cut(spread.mapInPandas(run, "vec_id long, c binary, v binary, d int"))
    classes = rows.where("c IS NOT NULL").groupBy("c").agg(F.first("v").alias("v"), F.first("d").alias("d"), F.count(F.lit(1)).alias("size"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = F.ceil(F.col("count") / shard_rows).cast("int")
    spread_out = F.least(F.ceil(F.col("count") / min(LEAST_ROWS, query_rows)), F.ceil(F.lit(tasks) / shards))
    shape = classes.groupBy("d").count().select("d", shards.alias("shards"),
                                               F.greatest(F.ceil(F.col("count") / query_rows), spread_out).cast("int").alias("blocks"))
    dealt = cut(classes.join(F.broadcast(shape), "d")  # a row per vector length
                .withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "c"), "shards").cast("int"))
                .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "c"), "blocks").cast("int")))
    graphs = cut(dealt.select("d", "shard", "c", "v", "size").groupBy("d", "shard").applyInPandas(
        _build(dtype), "d int, shard int, n int, keys binary, sizes binary, x binary, links array<binary>"))
    asked = dealt.select("d", "block", "c", "v", "size", F.col("shard").alias("home"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    offered = graphs.join(F.broadcast(shape), "d").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("shards", "blocks")
    found = cut(asked.groupBy("d", "shard", "block").cogroup(offered.groupBy("d", "shard", "block")).applyInPandas(
        _search(dtype, threshold), FOUND))
    links = _link_counts(found, dealt, dtype, threshold)
    roots = components(found.where("u IS NOT NULL").select("u", "v")).select(F.col("node").alias("c"), "root")
    sizes = dealt.select("c", "size")
    per = sizes.join(links, "c").join(roots, "c", "left").select("c", (F.col("size") - 1 + F.col("links")).alias("n_links"), F.coalesce("root", "c").alias("g"))
    # written sides: each join shuffles both for itself, so a hot class's rows can be split
    marked = rows.select("vec_id", "c").join(cut(per), "c", "left")
    low = cut(marked.where("g IS NOT NULL").groupBy("g").agg(F.min("vec_id").alias("low")))
    out = marked.join(low, "g", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("g").isNull(), F.col("vec_id")).otherwise(F.col("low")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
