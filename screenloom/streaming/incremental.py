"""State that grows as tiles finish: upserts, running counters, progress logs; as batch jobs and as streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

TILE = ["well", "tile"]


def latest(rows: DataFrame) -> DataFrame:
    """The last row of each tile by time and event."""
    best = rows.groupBy(*TILE).agg(F.max(F.struct("ts", "event_id", "status", "value")).alias("m"))
    return best.select(*TILE, "m.ts", "m.event_id", "m.status", "m.value")


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with the rows of tiles in ``new`` replaced by the latest of these."""
    fresh = latest(new)
    return old.join(fresh, TILE, "left_anti").unionByName(fresh.select(*old.columns))


def well_counters(tiles: DataFrame) -> DataFrame:
    """Counters of each well, computed from one row per tile, so that a tile that ran twice counts once."""
    return tiles.groupBy("well").agg(
        F.count(F.lit(1)).alias("tiles"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "error").alias("failed"),
        F.array_join(F.sort_array(F.collect_set("tile")), ",").alias("tile_list"),
    )


class ChangeLog:
    """A table kept as a base and the changes since, in a folder that all machines share.

    Each batch writes only its own changes, in ``buckets`` by tile: ``changes/<batch>``. Once these hold ``share`` of
    the base's rows, or there are ``most`` of them, base and changes are combined into ``base/<batch>``; so over
    time a row is written few times however large the table is. The base before and the changes after it
    stay for whoever reads them just now; what is older goes. A folder counts once Spark has marked it
    complete. A batch that is replayed writes the same folder again, so nothing changes.

    ``combine`` makes one table of changes; combining combined tables must give the same as combining all at once.
    """

    def __init__(self, spark: SparkSession, folder: str, combine: Callable[[DataFrame], DataFrame], buckets: int = 8, share: float = 0.5, most: int = 100) -> None:
        self.spark, self.folder, self.combine, self.buckets, self.share, self.most = spark, folder.rstrip("/"), combine, buckets, share, most

    def _path(self, *names: object):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *[str(n) for n in names if n != ""]]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind that hold rows, ascending."""
        fs, path = self._path(kind)
        if not fs.exists(path):
            return []
        inside = lambda n: [x.getPath().getName() for x in fs.listStatus(self._path(kind, n)[1])]
        numbers = [int(n) for n in inside("") if n.isdigit()]
        return sorted(n for n in numbers if "_SUCCESS" in (names := inside(n)) and any(x.startswith("bucket=") for x in names))

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        bucket = F.pmod(F.xxhash64(*TILE), F.lit(self.buckets)).cast("int")
        rows.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{kind}/{number}")

    def _read(self, kind: str, numbers: list[int]) -> list[DataFrame]:
        # each folder by itself, since the bucket is part of the path below it
        return [self.spark.read.parquet(f"{self.folder}/{kind}/{n}").drop("bucket") for n in numbers]

    def _state(self) -> tuple[list[int], list[int]]:
        """The base, if there is one, and the changes after it."""
        base = self._complete("base")[-1:]
        return base, [n for n in self._complete("changes") if not base or n > base[0]]

    def append(self, changes: DataFrame, number: int) -> None:
        """Add the changes of a batch."""
        base, _ = self._state()
        if base and number <= base[0]:
            return  # a replay of what the base has already
        self._write(changes, "changes", number)
        base, since = self._state()
        rows = lambda tables: sum(t.count() for t in tables)  # noqa: E731  counted from the files' footers
        if len(since) < self.most and rows(self._read("changes", since)) < self.share * rows(self._read("base", base)):
            return
        self._write(self.read(), "base", number)
        for kind, last in (("base", base[0] - 1 if base else -1), ("changes", base[0] if base else -1)):
            for n in self._complete(kind):
                if n <= last:
                    fs, path = self._path(kind, n)
                    fs.delete(path, True)

    def read(self) -> DataFrame | None:
        """The table as it is now, or None if nothing was ever written."""
        base, since = self._state()
        tables = [*self._read("base", base), *self._read("changes", since)]
        if not tables:
            return None
        whole = tables[0]
        for t in tables[1:]:
            whole = whole.unionByName(t)
        return self.combine(whole)


def tile_log(spark: SparkSession, folder: str, **options) -> ChangeLog:
    """The log of one row per tile, the latest by time and event."""
    return ChangeLog(spark, folder, latest, **options)


def stream_upserts(arrivals: DataFrame, folder: str, checkpoint: str, **options):
    """Start a stream that keeps one row per tile, the latest by time and event, in the :func:`tile_log` of ``folder``."""

    def merge(batch: DataFrame, number: int) -> None:
        tile_log(batch.sparkSession, folder, **options).append(latest(batch), number)

    return arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_current(spark: SparkSession, folder: str) -> DataFrame | None:
    """The tiles that :func:`stream_upserts` keeps, or None before the first batch."""
    return tile_log(spark, folder).read()


def _net(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*TILE, "status").agg(F.sum("n").alias("n")).filter("n <> 0")


def status_changes(arrivals: DataFrame) -> DataFrame:
    """Of a stream of arrivals the changes of tiles' statuses: well, tile, status, n.

    The state of a tile is its latest arrival by time and event. When a later one has another status the former
    is retracted (n = -1); the same again, or an older one that comes late, changes nothing.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        before = tuple(state.get) if state.exists else None
        last = before
        for pdf in frames:
            for row in pdf[["at", "event_id", "status"]].itertuples(index=False, name=None):
                last = row if last is None or row > last else last
        state.update(last)
        if before is None or before[2] != last[2]:
            out = [(*key, last[2], 1)] + ([] if before is None else [(*key, before[2], -1)])
            yield pd.DataFrame(out, columns=[*TILE, "status", "n"])

    rows = arrivals.select(
        *TILE,
        F.coalesce(F.col("ts").cast("string"), F.lit("")).alias("at"),
        F.coalesce(F.col("event_id").cast("long"), F.lit(-(1 << 63))).alias("event_id"),
        F.coalesce("status", F.lit("")).alias("status"),
    )
    return rows.groupBy(*TILE).applyInPandasWithState(
        step, "well long, tile long, status string, n long", "at string, event_id long, status string", "update", GroupStateTimeout.NoTimeout
    )


def stream_counters(arrivals: DataFrame, folder: str, checkpoint: str, **options):
    """Start a stream of running counters by well, in which a tile counts once, with its latest status."""

    def add(batch: DataFrame, number: int) -> None:
        ChangeLog(batch.sparkSession, folder, _net, **options).append(_net(batch), number)

    changes = status_changes(arrivals)
    return changes.writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_counters(spark: SparkSession, folder: str) -> DataFrame | None:
    """The counters that :func:`stream_counters` keeps, as :func:`well_counters` gives them."""
    tiles = ChangeLog(spark, folder, _net).read()
    return None if tiles is None else well_counters(tiles)


def stream_log(arrivals: DataFrame, folder: str, checkpoint: str):
    """Start a stream that appends the status of each finished tile to a log of Parquet files."""
    log = arrivals.select("event_id", "ts", *TILE, "status")
    return log.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
