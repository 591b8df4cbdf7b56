"""Exact n-gram Jaccard join by a blocked sparse matrix product.

The incidence matrix has a row per class of documents with equal shingle sets
and a column per shingle. Row pairs reach the product only if size-derived
bounds leave them a chance; the product then adds overlap counts column by
column over tiles of rows, and pairs whose count stays below
``min_overlap(|a|, |b|)`` are discarded. Every link between different sets is
found; classes carry their copies.

1. *Digest* (text pass): per document its set size and class key (128-bit hash
   of the sorted set).
2. *Bound by a prefix block*: of two linked sets of sizes a, b the overlap is at
   least ceil(.75 max(a, b)), so by any fixed order of columns they share at
   least min(l(a), l(b)) of their first ``n - ceil(.75 n) + l(n)`` columns,
   l(n) = 15 % of n. Documents with fewer shared columns in that block than
   that link with nothing. Workers first merge their own columns, so a column
   costs one entry per worker however many documents hold it.
3. *Rare-first prefixes* of the remaining rows: columns are ordered by the
   number of rows that hold them; a row whose columns are its own beyond the
   prefix drops out; rows that share a prefix column form candidate blocks.
4. *Product* over each candidate block in tiles of ``TILE`` x ``TILE`` rows,
   each tile a group of its own; a tile returns a spanning forest of its links
   (enough for the components), or all its links if asked.
5. *Components* of the links over classes, then the smallest doc_id.

Defined results: null text, empty text and texts of white space only have an
empty set and link with nothing; fewer words than ``WORDS`` make one shingle of
the whole sequence; rows with equal text are copies of one class and all stay; a
null id takes part in its class, and a class without any id gets a null
component; other columns are ignored; an empty table gives an empty result.

Hashes are 64 bits a shingle and 128 a class; in step 2 only, where a
collision merely keeps a row longer, 48 bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import components, cut, lean_batches, lean_group, partitions_for, text_batches

WORDS = 5
PERCENT = 75
TILE = 1024
STRIP = 64  # rows of a tile compared at a time
FLUSH = 400_000  # columns a worker merges before it sends them
BUCKET_ENTRIES = 1_000_000
BROADCAST_ROWS = 200_000  # ids of 24 bytes: under 10 MB; beyond, a shuffled join
_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOW48 = np.uint64((1 << 48) - 1)


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    tokens = raw.lower().split()  # bytes: A-Z only, and the white space of ASCII
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = len(h) - words + 1
    out = np.zeros(n, np.uint64)
    for i in range(words):
        out ^= h[i:i + n]
        out = (out << np.uint64(29) | out >> np.uint64(35)) * _MULT
    out ^= out >> np.uint64(32)
    return np.unique(out)


def least(n, percent: int = PERCENT):
    """Smallest overlap of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def extra(n):
    return np.maximum(1, 3 * n // 20)


def prefix_block(n: int, percent: int = PERCENT) -> int:
    return min(n, n - least(n, percent) + int(extra(n)))


def _key(sh: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(sh.tobytes())


def _ids(pdf):
    return pdf["doc_id"].astype("Int64")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [(len(s), _key(s) if len(s) else None) for s in (shingles(x or b"") for x in pdf["raw"])]
        yield pd.DataFrame({"doc_id": _ids(pdf), "hash": pdf["hash"], "n": [n for n, _ in out], "c": [c for _, c in out]})


def _send_block(buckets: int, percent: int):
    """Workers' part of step 2: columns of the prefix blocks, merged per flush.
    A column held by several rows here is already known to be shared; each
    distinct column is sent once, with its row or a mark for several."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows, size, flushes = [], [], 0, 0
        done: set[bytes] = set()

        def flush():
            nonlocal held, rows, size, flushes
            done.clear()
            if not held:
                return None
            s = np.concatenate(held)
            c = np.repeat(np.array(rows, np.uint64), [len(x) for x in held])
            order = np.argsort(s, kind="stable")
            s, c = s[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            count = np.diff(np.append(first, len(s)))
            own, times = np.unique(c[np.repeat(count > 1, count)], return_counts=True)
            u, holder = s[first], np.where(count > 1, np.uint64(0), c[first])
            place = (u % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                at = order[cuts[b]:cuts[b + 1]]
                out.append((b, _six(u[at]), _six(holder[at]), b"", b""))
            out.append((flushes % buckets, b"", b"", own.tobytes(), times.astype(np.int64).tobytes()))
            held, rows, size, flushes = [], [], 0, flushes + 1
            return pd.DataFrame(out, columns=["b", "s", "holder", "own", "times"])

        for pdf in batches:
            for raw in pdf["raw"]:
                sh = shingles(raw or b"")
                if not len(sh):
                    continue
                key = _key(sh)
                if key in done:  # a copy of a row of this flush
                    continue
                done.add(key)
                part = sh[:prefix_block(len(sh), percent)] >> np.uint64(16)
                part = part[np.concatenate([[True], part[1:] != part[:-1]])]
                held.append(part)
                rows.append(int.from_bytes(key[:6], "little") or 1)
                size += len(part)
                if size >= FLUSH:
                    yield flush()
        last = flush()
        if last is not None:
            yield last
    return run


def _six(a: np.ndarray) -> bytes:
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(blobs) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel()


def _count_shared(parts: int):
    """Shared columns per row (48-bit row key) of one bucket of columns, as one
    array for each part of the rows."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s, c = _from_six(pdf["s"]), _from_six(pdf["holder"])
        order = np.lexsort((c, s))
        s, c = s[order], c[order]
        keep = np.concatenate([[True], (s[1:] != s[:-1]) | (c[1:] != c[:-1])]) if len(s) else np.empty(0, bool)
        s, c = s[keep], c[keep]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(s)))
        shared = np.repeat((count > 1) | (c[first] == 0), count) & (c != 0)
        keys = [c[shared]] + [np.frombuffer(x, np.uint64) for x in pdf["own"]]
        times = [np.ones(int(shared.sum()), np.int64)] + [np.frombuffer(x, np.int64) for x in pdf["times"]]
        u, total = _add(np.concatenate(keys), np.concatenate(times))
        part = (u % np.uint64(parts)).astype(np.int64)
        return pd.DataFrame([(p, u[part == p].tobytes(), total[part == p].tobytes()) for p in np.unique(part)],
                            columns=["p", "k", "cnt"])
    return run


def _add(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(keys, return_inverse=True)
    return u, np.bincount(inverse, weights=times, minlength=len(u)).astype(np.int64)


def _add_buckets(pdf: pd.DataFrame) -> pd.DataFrame:
    u, total = _add(np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["k"]]),
                    np.concatenate([np.frombuffer(x, np.int64) for x in pdf["cnt"]]))
    return pd.DataFrame({"k": u.view(np.int64), "cnt": total})


def _full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingles(x or b"") for x in pdf["raw"]]
        yield pd.DataFrame({"c": [_key(s) for s in sets], "n": [len(s) for s in sets],
                            "sh": [s.view(np.int64) for s in sets]})


def _product(keys, sizes, sets, left, right, percent: int):
    """Links ``(i, j)`` of one tile: rows ``left`` against rows ``right``."""
    rows = np.concatenate([left, right]) if left is not right else left
    s = np.concatenate([sets[r] for r in rows])
    at = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    order = np.lexsort((at, s))
    s, at = s[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    ends = np.append(first[1:], len(s))
    nl = len(left)
    overlap = np.zeros((nl, len(right)), np.int32)
    for b, e in zip(first[ends - first > 1].tolist(), ends[ends - first > 1].tolist()):
        held = at[b:e]
        if left is right:
            overlap[np.ix_(held, held)] += 1
        else:
            cut_at = np.searchsorted(held, nl)
            if 0 < cut_at < len(held):
                overlap[np.ix_(held[:cut_at], held[cut_at:] - nl)] += 1
    i, j = [], []
    for at in range(0, nl, STRIP):  # wide numbers for a strip of the tile at a time
        o = overlap[at:at + STRIP].astype(np.int64)
        x, y = np.nonzero(100 * o >= percent * (sizes[left[at:at + STRIP]][:, None] + sizes[right][None, :] - o))
        x += at
        keep = x < y if left is right else slice(None)
        i.append(x[keep])
        j.append(y[keep])
    return left[np.concatenate(i)], right[np.concatenate(j)]


def _tiles(percent: int, every: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby("k", sort=True):
            part = part.sort_values("c").reset_index(drop=True)
            keys, sizes = part["c"].tolist(), part["n"].to_numpy(np.int64)
            sets = part["sh"].tolist()
            i, j = int(part["i"].iloc[0]), int(part["j"].iloc[0])
            block = part["block"].to_numpy()
            left = np.flatnonzero(block == i)
            right = left if i == j else np.flatnonzero(block == j)
            if not len(left) or not len(right):
                continue
            a, b = _product(keys, sizes, sets, left, right, percent)
            parent = np.arange(len(keys))

            def find(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for x, y in zip(a.tolist(), b.tolist()):
                if every:
                    out.append((keys[x], keys[y]))
                    continue
                p, q = find(x), find(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    out.append((keys[x], keys[y]))
        return pd.DataFrame(out, columns=["u", "v"], dtype=object)
    return run


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, n, c`` per row, written to the shared folder."""
    return cut(_raw(docs).mapInPandas(lean_batches(_digest), "doc_id long, hash long, n int, c binary"))


def _raw(docs: DataFrame) -> DataFrame:
    return text_batches(docs).select("doc_id", F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("raw"))


def class_links(docs: DataFrame, digest: DataFrame, percent: int = PERCENT, every: bool = False) -> DataFrame:
    """Links ``(u, v)`` between class keys: a spanning forest of each tile's
    links, or all of them if ``every``."""
    spark = docs.sparkSession
    total = digest.agg(F.sum("n")).first()[0] or 0
    buckets = partitions_for(spark, total * 2 // 5, BUCKET_ENTRIES)
    sent = _raw(docs).select("raw").mapInPandas(
        lean_batches(_send_block(buckets, percent)), "b int, s binary, holder binary, own binary, times binary")
    counts = (sent.groupBy("b").applyInPandas(lean_group(_count_shared(buckets)), "p int, k binary, cnt binary")
              .groupBy("p").applyInPandas(lean_group(_add_buckets), "k long, cnt long"))
    # the first six bytes of the class key, little-endian, as step 2 has them
    flipped = F.concat(*[F.substring("c", i, 1) for i in range(6, 0, -1)])
    short = F.conv(F.hex(flipped), 16, 10).cast("long")
    need = F.greatest(F.lit(1), F.floor(3 * F.ceil(percent * F.col("n") / 100) / 20))
    rows = digest.where("n > 0").withColumn("k", F.when(short == 0, 1).otherwise(short))
    alive = (rows.join(counts, "k").where(F.col("cnt") >= need)
             .groupBy("c").agg(F.min(F.struct("doc_id", "hash")).alias("r"))
             .select(F.col("r.doc_id").alias("a_id"), F.col("r.hash").alias("a_hash")))
    alive = cut(alive)
    side = F.broadcast(alive) if alive.count() <= BROADCAST_ROWS else alive
    raw = _raw(docs)
    picked = raw.join(side, raw["doc_id"].eqNullSafe(side["a_id"]) & (raw["hash"] == side["a_hash"]), "left_semi").select("raw")
    full = cut(picked.mapInPandas(lean_batches(_full), "c binary, n int, sh array<long>").dropDuplicates(["c"]))

    entries = full.select("c", "n", F.explode("sh").alias("s"))
    held = entries.groupBy("s").count().where("count > 1")
    order = F.array_sort(F.collect_list(F.struct("count", "s")))
    shared = entries.join(held, "s").groupBy("c").agg(F.first("n").alias("n"), order.alias("sh"))
    # columns held once come first in the order and match nothing
    room = (F.col("n") - F.ceil(percent * F.col("n") / 100) + 1 - (F.col("n") - F.size("sh"))).cast("int")
    rows = cut(shared.where(room > 0).select("c", "n", F.transform("sh", lambda x: x["s"]).alias("sh"),
                                              F.transform(F.slice("sh", 1, room), lambda x: x["s"]).alias("pre")))
    prefix = rows.select("c", F.explode("pre").alias("s"))
    low = prefix.groupBy("s").agg(F.min("c").alias("v"), F.count(F.lit(1)).alias("m")).where("m > 1")
    star = prefix.join(low, "s").where("c <> v").select(F.col("c").alias("u"), "v")
    blocks = cut(components(star).withColumnRenamed("node", "c").withColumnRenamed("root", "k"))
    size = blocks.groupBy("k").agg(F.count(F.lit(1)).alias("m")).select("k", F.ceil(F.col("m") / TILE).cast("int").alias("parts"))
    placed = (rows.select("c", "n", "sh").join(blocks, "c").join(size, "k")
              .withColumn("block", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    # small candidate blocks share a group; tiles of large ones have their own
    groups = partitions_for(spark, blocks.count(), 1000)
    key = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("k"), F.lit(groups))).otherwise(F.xxhash64("k", "i", "j"))
    return (placed.withColumn("g", key).select("g", "k", "i", "j", "block", "c", "n", "sh")
            .groupBy("g", "i", "j").applyInPandas(lean_group(_tiles(percent, every)), "u binary, v binary"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, hash, n_shingles, component_id, group`` per row; ``hash`` (of
    the text) tells rows of one id apart, ``group`` is the component's class
    key (null for empty sets)."""
    digest = digests(docs)
    # written sides: each join shuffles both for itself, so a hot group's rows can be split
    # written links: tiles and the components' forests would else be two workers a task
    roots = cut(components(cut(class_links(docs, digest, percent))).select(F.col("node").alias("c"), "root"))
    labelled = digest.join(roots, "c", "left").withColumn("g", F.coalesce("root", "c"))
    lowest = cut(labelled.where("g IS NOT NULL").groupBy("g").agg(F.min("doc_id").alias("low")))
    return labelled.join(lowest, "g", "left").select(
        "doc_id", "hash", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("low")).alias("component_id"),
        F.col("g").alias("group"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that stay: one of each group — the row with the group's
    smallest id (of equal ids the smallest text hash; one row of equal rows).
    Documents without words stay. Columns as given."""
    marked = jaccard_components(docs, percent)
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash"))
    keep = (marked.where("n_shingles > 0").groupBy("group").agg(lowest.alias("r"))
            .select(F.col("r.doc_id").alias("k_id"), F.col("r.hash").alias("k_hash")))
    own = docs.withColumn("_jac_hash", F.xxhash64("text")).withColumn("_jac_words", F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    kept = own.where("_jac_words").join(keep, own["doc_id"].eqNullSafe(keep["k_id"]) & (own["_jac_hash"] == keep["k_hash"]), "left_semi")
    kept = kept.dropDuplicates(["doc_id", "_jac_hash"])
    return kept.select(*docs.columns).unionByName(own.where("NOT _jac_words").select(*docs.columns))
