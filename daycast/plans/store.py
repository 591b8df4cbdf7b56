"""A daily table that raw rows are added to: mergeable state, versions, one pointer.

**State.** Per series and day: the number of rows, for every aggregated column the sum
and the number of its parsed values, and the day's price as it came (not filled). Two
states add up, so new or late raw rows are rolled up alone and merged; averages and
fills are taken when the table is read. Beside it, per series and month, the first and
last known price: what a reader of the later months needs to fill them.

**Versions.** A refresh writes the months it changes into a folder of its own and then
commits a manifest that names, for every month, the folder that holds it. Manifests are
numbered and never rewritten; the highest number is the table. Readers of the version
before keep their files, a refresh that dies changes nothing, and of two refreshes
that start from one version the second fails.

**Scale.** The state is at day grain (series x days), whatever the raw volume; a refresh
reads the raw rows from its first day on (a predicate that reaches the scan) or just the
new rows, and rewrites only the months they touch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daycast.functions.casting import safe_cast_double
from daycast.operators.enrich import PRICE_COLUMNS, price_rename
from daycast.operators.rollup import DAILY_AGGREGATES, scan_range
from daycast.sources.files import with_year_month
from daycast.sources.hadoop import commit_text, list_names, read_text


def daily_state(blocks: DataFrame, start: str | None = None, end: str | None = None,
                series: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Mergeable roll-up of raw rows: ``blocks_count``, and ``{name}_total`` /
    ``{name}_known`` of every daily aggregate."""
    aggs = [F.count(F.lit(1)).alias("blocks_count")]
    for name, _, source, cast in DAILY_AGGREGATES:
        c = safe_cast_double(source) if cast else F.col(source)
        aggs += [F.sum(c).alias(f"{name}_total"), F.count(c).alias(f"{name}_known")]
    return (scan_range(blocks, start, end, ts)
            .groupBy(*[F.col(s) for s in series], F.to_date(F.col(ts)).alias("day")).agg(*aggs))


def merge_states(states: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """States with repeated days added up, one row per series and day."""
    total = [F.sum(c).alias(c) for c in states.columns if c not in (*series, "day", *PRICE_COLUMNS)]
    price = [F.max(c).alias(c) for c in PRICE_COLUMNS if c in states.columns]  # the day's one price, or NULL
    return states.groupBy(*series, "day").agg(*total, *price)


def finished(state: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Daily metrics of a state: sums and averages, prices as they are."""
    out = []
    for name, kind, *_ in DAILY_AGGREGATES:
        known, total = F.col(f"{name}_known"), F.col(f"{name}_total")
        out.append(F.when(known > 0, total if kind == "sum" else total / known).alias(name))
    return state.select(*series, "day", "blocks_count", *out, *[c for c in PRICE_COLUMNS if c in state.columns])


class DailyStore:
    """``path`` on any file system that Spark writes; one store has one set of series
    keys, and prices or none."""

    def __init__(self, spark: SparkSession, path: str, series: Sequence[str] = (), ts: str = "timestamp"):
        self.spark, self.path, self.series, self.ts = spark, path.rstrip("/"), list(series), ts

    # ---- versions

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in list_names(self.spark, f"{self.path}/manifest") if n.endswith(".json")]

    def _manifest(self, version: int | None = None) -> dict:
        found = self.versions()
        if not found:
            return {"version": 0, "months": {}, "schema": None}
        return json.loads(read_text(self.spark, f"{self.path}/manifest/{version or max(found):08d}.json"))

    def _months(self, manifest: dict, kind: str, schema: StructType, lo: str = "", hi: str = "9999-99") -> DataFrame:
        """Rows (with ``year_month``) of the months in range: one pruned scan a folder."""
        schema = StructType([*schema, StructField("year_month", StringType())])
        folders: dict[str, list[str]] = {}
        for month, folder in manifest["months"].items():
            if lo <= month <= hi:
                folders.setdefault(folder, []).append(month)
        scans = [self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/{f}").where(F.col("year_month").isin(months))
                 for f, months in sorted(folders.items())]
        return reduce(DataFrame.unionAll, scans) if scans else self.spark.createDataFrame([], schema)

    def _state(self, manifest: dict, lo: str = "", hi: str = "9999-99") -> DataFrame:
        return self._months(manifest, "state", StructType.fromJson(manifest["schema"]), lo, hi).drop("year_month")

    def _commit(self, base: dict, state: DataFrame, gone_from: str | None = None) -> int:
        """Write the months of ``state`` and name them; months from ``gone_from`` on that
        it does not hold leave the table."""
        folder = uuid.uuid4().hex
        # a month is one task and one file: at day grain it is small
        with_year_month(state).repartition("year_month").write.partitionBy("year_month").parquet(f"{self.path}/state/{folder}")
        schema = StructType([*state.schema, StructField("year_month", StringType())])
        written = self.spark.read.schema(schema).parquet(f"{self.path}/state/{folder}")
        prices = [c for c in PRICE_COLUMNS if c in state.columns]
        if prices:
            ends = [f(c, F.when(F.col(c).isNotNull(), F.col("day"))).alias(f"{edge}_{c}")
                    for c in prices for edge, f in (("first", F.min_by), ("last", F.max_by))]
            (written.groupBy(*self.series, "year_month").agg(*ends).repartition("year_month")
             .write.partitionBy("year_month").parquet(f"{self.path}/edges/{folder}"))
        months = {r[0] for r in written.select("year_month").distinct().collect()}  # calendar months
        keep = {m: v for m, v in base["months"].items() if gone_from is None or m < gone_from}
        new = {"version": base["version"] + 1, "series": self.series, "schema": state.schema.jsonValue(),
               "months": {**keep, **dict.fromkeys(sorted(months), folder)}}
        commit_text(self.spark, f"{self.path}/manifest/{new['version']:08d}.json", json.dumps(new))
        return new["version"]

    def _priced(self, state: DataFrame, price_raw: DataFrame | None) -> DataFrame:
        return state if price_raw is None else state.join(price_rename(price_raw), "day", "left").select(
            *state.columns, *PRICE_COLUMNS)

    # ---- writing

    def replace_from(self, blocks: DataFrame, price_raw: DataFrame | None = None, since: str | None = None,
                     end: str | None = None) -> int:
        """Days from ``since`` on (all days without it) become those of ``blocks``:
        stored days that have no raw rows any more go. Days before are not read again."""
        base = self._manifest()
        state = self._priced(daily_state(blocks, since, end, self.series, self.ts), price_raw)
        month = since[:7] if since else ""
        if since and month in base["months"]:
            head = self._state(base, month, month).where(F.col("day") < F.lit(since).cast("date"))
            state = head.unionByName(state)
        return self._commit(base, state, gone_from=month)

    def add_rows(self, blocks: DataFrame, price_raw: DataFrame | None = None) -> int:
        """Add raw rows that the table does not hold yet, of any days: only the months
        they fall in are rewritten. Prices are needed for days that are new."""
        base = self._manifest()
        new = self._priced(daily_state(blocks, None, None, self.series, self.ts), price_raw)
        if not base["months"]:
            return self._commit(base, new)
        stored_columns = StructType.fromJson(base["schema"]).names
        new = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast("double").alias(c) for c in stored_columns])
        months = new.select(F.date_format("day", "yyyy-MM").alias("m")).distinct()
        touched = [r[0] for r in months.collect()]  # calendar months
        if not touched:
            return base["version"]
        state = self._state({**base, "months": {m: v for m, v in base["months"].items() if m in touched}})
        return self._commit(base, merge_states(state.unionByName(new), self.series))

    # ---- reading

    def read(self, since: str | None = None, version: int | None = None) -> DataFrame:
        """The daily table with filled prices: what ``enriched_daily`` gives for all raw
        rows. With ``since`` only the months from it on are read; the prices before it
        are known from the months' edges."""
        manifest = self._manifest(version)
        if not manifest["months"]:
            raise FileNotFoundError(f"no version in {self.path}")
        month = since[:7] if since else ""
        rows = finished(self._state(manifest, month), self.series)
        prices = [c for c in PRICE_COLUMNS if c in rows.columns]
        if prices:
            rows = self._filled(rows, manifest, month, prices)
        return rows.where(F.col("day") >= F.lit(since).cast("date")) if since else rows

    def _filled(self, rows: DataFrame, manifest: dict, month: str, prices: list[str]) -> DataFrame:
        kind = {f.name: f.dataType for f in StructType.fromJson(manifest["schema"])}
        edges = StructType()
        for s in self.series:
            edges.add(s, kind[s])
        for c in prices:
            for edge in ("first", "last"):
                edges.add(f"{edge}_{c}", kind[c])
        every = self._months(manifest, "edges", edges)
        key = F.struct(*self.series) if self.series else F.lit(0)
        before = F.col("year_month") < month
        at = [F.min_by(f"first_{c}", F.when(F.col(f"first_{c}").isNotNull(), F.col("year_month"))).alias(f"_head_{c}") for c in prices]
        at += [F.max_by(f"last_{c}", F.when(before & F.col(f"last_{c}").isNotNull(), F.col("year_month"))).alias(f"_carry_{c}") for c in prices]
        known = every.groupBy(key.alias("_key")).agg(*at)  # one row per series
        # a null series key is a series like any other
        joined = rows.withColumn("_key", key).alias("r").join(
            known.alias("k"), F.col("r._key").eqNullSafe(F.col("k._key")), "left")
        past = Window.partitionBy(*self.series).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fills = {c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.col(f"_carry_{c}"), F.col(f"_head_{c}")) for c in prices}
        return joined.select(*[fills[c].alias(c) if c in fills else F.col(f"r.{c}").alias(c) for c in rows.columns])
