"""M6: gradient-boosted regression trees on quantised features, one barrier stage.

Every column is cut into at most ``bins`` byte-sized bins. Each task of one barrier
stage holds its own rows' bins, gradients and predictions for all rounds; what tasks
exchange is, per tree level, the gradient sums and row counts by (node, column, bin),
whose size depends on the parameters and not on the rows. All tasks then pick the same
splits. So a run of 600 rounds is one job, not several jobs a round. A barrier costs
about a second and a tree one a level, so rows are split only where a task's share of
``rows_per_task`` is full (2,000,000 rows of 100 columns: 200 MB of bins).

Sums are of integers: gradients are scaled by a power of two, the largest for which the
sum over all rows stays exact in a double. Addition is then associative, and the trees
are the same for any number of tasks, cores and any order of rows. Rows are sampled by a
hash of their content and the round, columns once per tree.

Squared error: a row's gradient is prediction - target, its hessian 1; a leaf's value is
-G / (H + l2) times the learning rate; the gain of a split is
GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2).

The model is a node table (tree, node, column, threshold, children, value): rows go
left where ``value <= threshold``. It is written as Parquet; its size is bounded by the
parameters, so scoring tasks get it whole, or rows are joined to it level by level
(:mod:`daycast.operators.trees`).

Rows with a NULL or NaN input are skipped, in fitting and in scoring."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.session import shared_dir

NODES = ("tree int, node int, depth int, feature int, threshold double, left int, right int, "
         "value double, rows bigint")
MODEL_CLASS = "daycast.operators.boosting.BoostedTreesModel"
CHUNK = 16_384


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 600
    learning_rate: float = 0.05
    max_depth: int = 6
    row_share: float = 0.8
    column_share: float = 0.8
    l2: float = 1.0
    min_rows: int = 1
    min_gain: float = 1e-12
    bins: int = 256            # at most 256: a bin is one byte
    seed: int = 42
    bin_rows: int = 20_000     # bound of the row sample that bin edges are read from
    rows_per_task: int = 2_000_000


def complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` are neither NULL nor NaN."""
    # one predicate: a conjunction of two hundred makes the optimizer infer constraints from each
    return df.where(~F.exists(F.array(*[F.col(c).cast("double") for c in cols]), lambda v: v.isNull() | F.isnan(v)))


def bin_edges(rows: DataFrame, feature_cols: Sequence[str], p: BoostParams) -> list[np.ndarray]:
    """Upper edges of every column's bins: all midpoints of neighbouring values where
    there are few, else quantiles, of the ``bin_rows`` rows with the smallest hashes."""
    sample = rows.orderBy("_id").limit(p.bin_rows).select(*feature_cols).toArrow()
    edges = []
    for c in feature_cols:
        u = np.unique(sample.column(c).to_numpy())
        mid = (u[:-1] + u[1:]) / 2
        if len(mid) >= p.bins:
            mid = np.unique(mid[np.linspace(0, len(mid) - 1, p.bins - 1).astype(np.int64)])
        edges.append(mid)
    return edges


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled_rows(ids: np.ndarray, round_: int, p: BoostParams) -> np.ndarray:
    """Which rows a round's tree is grown from."""
    if p.row_share >= 1:
        return np.ones(len(ids), bool)
    salt = _mix(np.array([p.seed * 1_000_003 + round_], np.uint64))
    return _mix(ids ^ salt) < np.uint64(min(int(p.row_share * 2.0 ** 64), 2 ** 64 - 1))


def sampled_columns(n: int, round_: int, p: BoostParams) -> np.ndarray:
    k = max(1, round(p.column_share * n))
    return np.sort(np.random.default_rng([p.seed, round_]).permutation(n)[:k])


class _Alone:
    """What a single task learns from the others: nothing."""
    rank = 0

    def total(self, a: np.ndarray, peak: float) -> tuple[np.ndarray, float]:
        return a, peak


class _Barrier:
    """Elementwise sums of the tasks' integer arrays, and the largest of a number."""

    def __init__(self):
        from pyspark import BarrierTaskContext
        self.context = BarrierTaskContext.get()
        self.rank = self.context.partitionId()

    def total(self, a: np.ndarray, peak: float) -> tuple[np.ndarray, float]:
        packed = base64.b64encode(zlib.compress(a.astype("<i8").tobytes(), 1)).decode()
        sent = [s.split(" ") for s in self.context.allGather(f"{float(peak).hex()} {packed}")]
        parts = [np.frombuffer(zlib.decompress(base64.b64decode(s)), "<i8").reshape(a.shape) for _, s in sent]
        return np.sum(parts, axis=0), max(float.fromhex(x) for x, _ in sent)


def _histogram(bins: np.ndarray, cols: np.ndarray, width: int, rows: np.ndarray, slot: np.ndarray,
               grad: np.ndarray, slots: int) -> np.ndarray:
    """(2, slots, columns, width): sums of scaled gradients, and row counts."""
    size = slots * len(cols) * width
    out = np.zeros((2, size))
    shift = np.arange(len(cols)) * width
    for a in range(0, len(rows), CHUNK):
        r = rows[a:a + CHUNK]
        at = (bins[r][:, cols] + shift + (slot[a:a + CHUNK] * (len(cols) * width))[:, None]).ravel()
        out[0] += np.bincount(at, np.repeat(grad[r], len(cols)), size)
        out[1] += np.bincount(at, minlength=size)
    return out.astype(np.int64).reshape(2, slots, len(cols), width)


def _best_splits(hist: np.ndarray, sums: np.ndarray, scale: float, p: BoostParams) -> list[tuple]:
    """Per node: gain, column, bin, and (gradient, rows) on the left of its best split.

    Only bins that hold rows are looked at: behind an empty one the sums are those
    before it, and of equal gains the first counts."""
    nodes, cols, width = hist.shape[1:]
    count = hist[1].reshape(-1)
    at = np.flatnonzero(count)
    line = at // width                     # (node, column)
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(at) else at
    lens = np.diff(np.append(first, len(at)))
    left = []
    for values in (hist[0].reshape(-1)[at], count[at]):
        run = values.cumsum()
        left.append(run - np.repeat(run[first] - values[first], lens))
    node = line // cols
    total = sums[:, node]
    right = total - np.array(left) if len(at) else total
    g, c, rg, rc = left[0] / scale, left[1], right[0] / scale, right[1]
    gain = g * g / (c + p.l2) + rg * rg / np.maximum(rc + p.l2, 1e-300) - (total[0] / scale) ** 2 / (total[1] + p.l2)
    gain[(c < p.min_rows) | (rc < max(p.min_rows, 1))] = -np.inf
    edge = np.searchsorted(node, np.arange(nodes + 1))
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if a == b:
            out.append((-np.inf, 0, 0, 0, 0))
            continue
        k = a + int(gain[a:b].argmax())
        out.append((float(gain[k]), int(line[k] % cols), int(at[k] % width), int(left[0][k]), int(left[1][k])))
    return out


def grow(exchange, bins: np.ndarray, edges: list[np.ndarray], target: np.ndarray, ids: np.ndarray,
         p: BoostParams) -> Iterator[tuple]:
    """All rounds on one task's rows; yields the node rows (equal on every task)."""
    n, peak = exchange.total(np.array([len(target)]), np.abs(target).max(initial=0))
    n = int(n[0])
    width = max([len(e) + 1 for e in edges], default=1)
    scale = _scale(n, peak)
    sums, _ = exchange.total(np.array([np.rint(target * scale).astype(np.int64).sum()]), 0)
    base = float(sums[0] / scale / max(n, 1))
    yield -1, 0, 0, -1, None, -1, -1, base, n
    predicted, bound = np.full(len(target), base), peak + abs(base)
    for round_ in range(p.rounds):
        grad = predicted - target
        peak = np.abs(grad).max(initial=0)
        scale = _scale(n, bound)                   # no gradient is above the bound
        grad = np.rint(grad * scale)
        cols = sampled_columns(len(edges), round_, p)
        used = sampled_rows(ids, round_, p)
        node = np.zeros(len(target), np.int64)     # where each row is
        made, out = 1, []
        rows = np.flatnonzero(used)
        hist, peak = exchange.total(_histogram(bins, cols, width, rows, np.zeros(len(rows), np.int64), grad, 1), peak)
        nodes, sums = [0], hist[:, :, 0].sum(axis=2)   # of this level: node numbers, (gradient, rows) of each
        for depth in range(p.max_depth + 1):
            best = _best_splits(hist, sums, scale, p) if depth < p.max_depth else []
            split = []
            for k, number in enumerate(nodes):
                g, c = sums[:, k].tolist()
                value = -(g / scale) / (c + p.l2) * p.learning_rate if c + p.l2 > 0 else 0.0
                if best and best[k][0] > p.min_gain:
                    _, col, b, left_g, left_c = best[k]
                    f = int(cols[col])
                    out.append((round_, number, depth, f, float(edges[f][b]), made, made + 1, value, c))
                    here = np.flatnonzero(node == number)
                    node[here] = np.where(bins[here, f] <= b, made, made + 1)
                    split.append((k, made, 0 if 2 * left_c <= c else 1, (left_g, left_c), (g - left_g, c - left_c)))
                    made += 2
                else:
                    out.append((round_, number, depth, -1, None, -1, -1, value, c))
            if not split:
                break
            nodes = [first + side for _, first, *_ in split for side in (0, 1)]
            sums = np.array([s for *_, left, right in split for s in (left, right)], np.int64).T
            if depth + 1 == p.max_depth:
                continue
            # histograms of the smaller children; a sibling is its parent less the other
            slot_of = np.full(made, -1, np.int64)
            for s, (_, first, small, *_) in enumerate(split):
                slot_of[first + small] = s
            slots = slot_of[node[rows]]
            mine = np.flatnonzero(slots >= 0)
            part, _ = exchange.total(_histogram(bins, cols, width, rows[mine], slots[mine], grad, len(split)), 0)
            parents = hist[:, [k for k, *_ in split]]
            side = np.array([small for _, _, small, *_ in split])
            hist = np.empty((2, 2 * len(split), *part.shape[2:]), np.int64)
            hist[:, 2 * np.arange(len(split)) + side] = part
            hist[:, 2 * np.arange(len(split)) + 1 - side] = parents - part
        values = np.zeros(made)
        for row in out:
            if row[3] < 0:
                values[row[1]] = row[7]
        predicted = predicted + values[node]
        bound = peak + np.abs(values).max()
        yield from out


def _scale(n: int, peak: float) -> float:
    """A power of two by which ``n`` numbers up to ``peak`` add up to less than 2**52."""
    return 2.0 ** np.floor(52 - np.log2(max(n, 1) * max(peak, 2.0 ** -900)))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="left")
    return out


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in NODES.split(", ")]
    kinds = {"int": pa.int32(), "double": pa.float64(), "bigint": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[x.split()[1]])
                                       for c, x in zip(zip(*rows), NODES.split(", "))], names)


def boost(train: DataFrame, feature_cols: Sequence[str], target: str, p: BoostParams = BoostParams(),
          tasks: int | None = None) -> BoostedTreesModel:
    """Fit; ``tasks`` overrides the number of tasks (it does not change the model)."""
    if not 2 <= p.bins <= 256:
        raise ValueError("bins must lie in 2..256")
    spark = train.sparkSession
    cols = list(feature_cols)
    rows = complete(train, [*cols, target]).select(
        F.xxhash64(*[F.col(c).cast("double") for c in (target, *cols)]).alias("_id"),
        F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols])
    n = rows.count()
    if n == 0:
        raise ValueError("no complete training rows")
    edges = bin_edges(rows, cols, p)
    width = tasks or min(-(-n // p.rows_per_task), spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ys, xs = [np.zeros(0, np.uint64)], [np.zeros(0)], [np.zeros((0, len(cols)), np.uint8)]
        for b in batches:
            ids.append(b.column("_id").to_numpy().view(np.uint64))
            ys.append(b.column("_y").to_numpy())
            xs.append(_binned(np.column_stack([b.column(c).to_numpy() for c in cols]), edges))
        exchange = _Barrier() if width > 1 else _Alone()
        held = []
        for row in grow(exchange, np.concatenate(xs), edges, np.concatenate(ys), np.concatenate(ids), p):
            if exchange.rank == 0:
                held.append(row)
            if len(held) >= 10_000:
                yield _node_batch(held)
                held = []
        if held:
            yield _node_batch(held)

    path = shared_dir(spark)
    rows.repartition(width).mapInArrow(run, NODES, barrier=True).write.parquet(path)
    return BoostedTreesModel(spark.read.schema(NODES).parquet(path), cols)


class _Scorer:
    """Node rows as arrays by tree; a leaf's children are itself."""

    def __init__(self, table: pa.Table):
        t = {n: table.column(n).to_numpy() for n in ("tree", "node", "feature", "left", "right", "value")}
        threshold = table.column("threshold").to_pandas().to_numpy()
        order = np.lexsort((t["node"], t["tree"]))
        t = {k: v[order] for k, v in t.items()}
        threshold = threshold[order]
        self.base = float(t["value"][t["tree"] < 0].sum())
        inner = t["tree"] >= 0
        t = {k: v[inner] for k, v in t.items()}
        start = np.searchsorted(t["tree"], t["tree"])  # nodes of a tree are numbered from 0 without gaps
        leaf = t["feature"] < 0
        own = np.arange(len(leaf))
        self.feature = np.where(leaf, 0, t["feature"])
        self.threshold = np.where(leaf, np.inf, threshold[inner])
        self.left = np.where(leaf, own, start + t["left"])
        self.right = np.where(leaf, own, start + t["right"])
        self.value = t["value"]
        self.roots = np.unique(start)
        self.depth = int(table.column("depth").to_numpy().max(initial=0))

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out = out + self.value[at]
        return out


class BoostedTreesModel:
    """Fitted trees: ``nodes`` (schema ``NODES``; tree -1 is the base value) and the
    columns that its ``feature`` numbers count."""

    def __init__(self, nodes: DataFrame, feature_cols: Sequence[str]):
        self.nodes, self.feature_cols = nodes, list(feature_cols)

    def transform(self, df: DataFrame) -> DataFrame:
        cols, spark = self.feature_cols, df.sparkSession
        scorer = spark.sparkContext.broadcast(_Scorer(self.nodes.toArrow()))  # rounds * 2**(depth + 1) nodes at most
        kept = complete(df.drop("prediction"), cols)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scorer.value.predict(x))], [*b.schema.names, "prediction"])

        schema = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in kept.schema)
        return kept.mapInArrow(run, f"{schema}, prediction double")

    def save(self, path: str) -> None:
        """Nodes as Parquet beside a one-row JSON ``metadata``, replacing what is there."""
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(path + "/nodes")
        spark.createDataFrame([(MODEL_CLASS, "boosted_trees", spark.version, self.feature_cols)],
                              "class string, uid string, sparkVersion string, featureCols array<string>"
                              ).coalesce(1).write.mode("overwrite").json(path + "/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTreesModel:
        meta = spark.read.json(path + "/metadata").first()
        return cls(spark.read.schema(NODES).parquet(path + "/nodes"), meta["featureCols"])
