"""Document fingerprints from prefix polynomial hashes.

For a text c_0..c_{n-1} of code points and a modulus p (two Mersenne-like
31-bit primes) the prefix array is P[i] = sum_{j<i} (c_j + 1) B^j mod p. The
span [i, i+k) has the position-free value (P[i+k] - P[i]) B^{-i}, so any two
spans of any two texts compare in O(1), and their longest common extension
(common prefix from two positions) is found by binary search.

A fingerprint is the hexadecimal text ``<length>-<whole hash, both moduli>-
<span>:<sketch>``; a sketch holds the ``SKETCH`` smallest mixed values of the
distinct spans of one length (the whole text where it is shorter). The span
length goes by the text's length (``SPANS``), so that short texts have many
spans too; a text not far above a bound also holds the sketch of the class
below, and two texts are compared by the shorter one's class (likeness 0 if the
longer one is too long to hold it). The share J of the smallest values of two fingerprints' union that both have
estimates the spans' Jaccard similarity; their likeness is 2 J / (1 + J), the
share of equal spans (0.5 for texts of one length that agree in one half), and
1 for equal fingerprints. Fingerprints of empty texts are equal to each other and unlike
all others.

The edited text needs the next document in id order. Ids are cut into ranges
of bounded bytes (from an id-only pass); a document goes to its range and the
first of a range also, as a closing row, to the range before. So texts cross
one shuffle, whatever the number of documents, and no task sees the whole
order.

Defined results: null text is empty; null ids come last, ties in id go by text;
equal rows stay; one document is its own next; other columns are ignored; an
empty table gives an empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
SPANS = [(0, 3), (60, 8), (400, 24)]  # from so many characters on: spans of that length
NEAR_CLASS = 4                        # texts under so many times their bound hold the class below
SKETCH = 64
RANGE_CHARS = 24_000_000
MAX_RANGES = 65_536  # beyond, ranges get larger; the driver holds one id a range
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """B^i and B^-i mod p, grown on demand."""

    def __init__(self, base: int, prime: int):
        self.p = np.uint64(prime)
        self.up, self.down = (self._start(base), self._start(pow(base, -1, prime)))

    @staticmethod
    def _start(b):
        return [b, np.ones(1, np.uint64)]

    def _to(self, side, n):
        base, have = side
        while len(have) < n:
            step = np.uint64(pow(int(base), len(have), int(self.p)))
            have = np.concatenate([have, have * step % self.p])
        side[1] = have
        return have[:n]

    def powers(self, n):
        return self._to(self.up, n)

    def inverse(self, n):
        return self._to(self.down, n)


POWERS = [Powers(b, p) for b, p in zip(BASES, PRIMES)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def prefix_array(points: np.ndarray, which: int) -> np.ndarray:
    """P[0..n] of one modulus. Running sums of residues stay under 2^63 for any
    text Spark can hold (2^31 characters)."""
    pw = POWERS[which]
    terms = (points + np.uint64(1)) * pw.powers(len(points)) % pw.p
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(terms, out=out[1:])
    return out % pw.p


def span_hash(prefix: np.ndarray, which: int, start, length) -> np.ndarray:
    """Position-free hashes of the spans ``[start, start + length)``."""
    pw = POWERS[which]
    start = np.asarray(start)
    inv = pw.inverse(int(start.max(initial=0)) + 1)
    return (prefix[start + length] + pw.p - prefix[start]) % pw.p * inv[start] % pw.p


def common_extension(a: list[np.ndarray], b: list[np.ndarray], i: int = 0, j: int = 0) -> int:
    """Length of the longest common extension from position i of one text and
    j of the other; both given by their prefix arrays."""
    lo, hi = 0, min(len(a[0]) - 1 - i, len(b[0]) - 1 - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if all(span_hash(x, w, i, mid) == span_hash(y, w, j, mid) for w, (x, y) in enumerate(zip(a, b))):
            lo = mid
        else:
            hi = mid - 1
    return lo


def span_lengths(n: int) -> list[int]:
    """Span lengths whose sketches a text of ``n`` characters holds, its own first."""
    own = max(i for i, (least, _) in enumerate(SPANS) if n >= least)
    return [SPANS[i][1] for i in ((own, own - 1) if own and n < NEAR_CLASS * SPANS[own][0] else (own,))]


def sketch(prefix: np.ndarray, span: int) -> np.ndarray:
    """The smallest distinct mixed hashes of spans, sorted."""
    n = len(prefix) - 1
    if n == 0:
        return np.empty(0, np.uint64)
    spans = max(1, n - span + 1)
    k = min(n, span)
    pw = POWERS[0]
    h = (prefix[k:k + spans] + pw.p - prefix[:spans]) % pw.p * pw.inverse(spans) % pw.p
    h = (h + np.uint64(1)) * _MIX >> np.uint64(16)
    share = 8 * SKETCH / spans
    while share < 1:  # only values under a bound are sorted; a wider bound where too few are
        low = np.unique(h[h < np.uint64(int(share * 2**48))])
        if len(low) >= SKETCH:
            return low[:SKETCH]
        share *= 8
    return np.unique(h)[:SKETCH]


def likeness(x: dict[int, np.ndarray], y: dict[int, np.ndarray], equal: bool = False) -> float:
    """Likeness of two texts by their sketches (span length -> values, own class first)."""
    if equal:
        return 1.0
    span = min(next(iter(x)), next(iter(y)))
    a, b = x.get(span, ()), y.get(span, ())
    if not len(a) or not len(b):
        return 0.0
    union = np.union1d(a, b)[:SKETCH]
    both = np.intersect1d(a, b, assume_unique=True)
    jaccard = np.isin(union, both, assume_unique=True).sum() / len(union)
    return float(2 * jaccard / (1 + jaccard))


def describe(text: str) -> tuple[str, list[np.ndarray], dict[int, np.ndarray]]:
    """Fingerprint, prefix arrays and sketches of a text."""
    points = code_points(text)
    arrays = [prefix_array(points, w) for w in (0, 1)]
    values = {k: sketch(arrays[0], k) for k in span_lengths(len(points))}
    whole = "".join(f"{int(a[-1]):08x}" for a in arrays)
    low = [f"{k}:" + v.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex() for k, v in values.items()]  # 48 bits each
    return f"{len(points):x}-{whole}-" + "+".join(low), arrays, values


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all)
    of the next document."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def with_next(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``doc_id, text, next_text`` in id order (the first after the last)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id", F.length("text").alias("n"))
    shape = ids.agg(F.sum("n"), F.count(F.lit(1)), F.min("doc_id"), F.count("doc_id"),
                    F.sum(F.when(F.col("doc_id").isNull(), F.col("n")))).first()
    if not shape[1]:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    parts = max(min(MAX_RANGES, -(-(shape[0] or 0) // range_chars)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = []
    if shape[3]:
        cuts = ids.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)
        bounds = sorted({int(x) for x in cuts if x > shape[2]})
    # range of an id: number of bounds at or below it; rows without an id come last, in
    # ranges of their text's hash, by which they are ordered
    edges = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    blank = max(1, -(-(shape[4] or 0) // range_chars))
    of_hash = F.floor((F.shiftright(F.xxhash64("text"), 32) + (1 << 31)) * blank / (1 << 32)).cast("int")
    where = F.when(F.col("doc_id").isNull(), len(bounds) + 1 + of_hash).otherwise(_range_of(edges, len(bounds)))
    placed = rows.withColumn("r", where)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    # the first document of every range closes the one before; the very first closes the last
    heads = (placed.select("doc_id", "r", F.xxhash64("text").alias("t")).groupBy("r")
             .agg(F.min(F.struct("doc_id", "t")).alias("h")).collect())  # one row per range
    heads = sorted((h["r"], h["h"]) for h in heads)
    closes = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}
    side = spark.createDataFrame([(r, x["doc_id"], x["t"], closes[r]) for r, x in heads], "r int, i long, t long, to int")
    flagged = placed.withColumn("t", F.xxhash64("text"))
    copies = (flagged.join(F.broadcast(side), (flagged["r"] == side["r"]) & flagged["doc_id"].eqNullSafe(side["i"]) & (flagged["t"] == side["t"]))
              .select("doc_id", "text", side["to"].alias("r"), F.lit(True).alias("closing")))
    all_rows = placed.withColumn("closing", F.lit(False)).unionByName(copies).repartition(4 * (parts + blank), "r")  # few ranges meet in a task
    follow = Window.partitionBy("r").orderBy("closing", *order)
    return (all_rows.withColumn("next_text", F.lead("text").over(follow))
            .where("NOT closing").select("doc_id", "text", "next_text"))


def _range_of(edges, n: int):
    """Number of edges at or below the id, by halving (few comparisons a row)."""
    if n == 0:
        return F.lit(0)
    middle = lambda s: F.floor((s["lo"] + s["hi"]) / 2).cast("int")
    state = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(n.bit_length())), state(F.lit(0), F.lit(n)),
        lambda s, _: F.when(s["lo"] >= s["hi"], s)
        .when(F.get(edges, middle(s)) <= F.col("doc_id"), state(middle(s) + 1, s["hi"]))
        .otherwise(state(s["lo"], middle(s))),
        lambda s: s["lo"])


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, prefix_edited long, prefix_next long")


def _fingerprint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out, known = [], (None, None)
        for doc_id, text, following in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), pdf["text"], pdf["next_text"]):
            # the next document is mostly the next row
            mine = known[1] if known[0] == text else describe(text)
            new = edited(text, following)
            print_new = describe(new)
            print_next = describe(following)
            known = (following, print_next)
            out.append((doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mine[0], print_new[0],
                        likeness(mine[2], print_new[2], mine[0] == print_new[0]),
                        likeness(mine[2], print_next[2], mine[0] == print_next[0]),
                        common_extension(mine[1], print_new[1]), common_extension(mine[1], print_next[1])))
        frame = pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                           "near_edited", "near_next", "prefix_edited", "prefix_next"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint report; ``prefix_*`` are the lengths in characters of the
    longest common prefix with the edited text and with the next document."""
    return with_next(docs).mapInPandas(_fingerprint, SCHEMA)
