"""expire-after-write cache over an unbounded stream of accesses."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from restframe.operators.greedy import greedy_marks
from restframe.operators.sequence import is_hot, time_slices
from restframe.session import keep


def cache_stream(accesses: DataFrame, key: str, at: str, ident: str, ttl_ms: int) -> DataFrame:
    """(key, ident, at, hit) per access, answered as they come; the state of a key is the load time of its entry.

    Accesses are taken in time order within a micro-batch only, and a key's state lives on. For
    answers in time order however the stream is cut, see ``CachedStream``.
    """
    narrow = accesses.select(key, ident, at).withColumn("_us", F.unix_micros(F.col(at).cast("timestamp")))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (loaded,) = state.get if state.exists else (None,)
        ready: list[tuple] = []
        for pdf in frames:
            ready += zip(pdf["_us"].tolist(), pdf[ident].tolist(), strict=True)
        ready.sort()
        hits = []
        for us, _ in ready:
            hit = loaded is not None and us - loaded <= ttl_ms * 1000
            if not hit:
                loaded = int(us)
            hits.append(hit)
        state.update((loaded,))
        yield pd.DataFrame({key: [group[0]] * len(ready), ident: [i for _, i in ready], "_us": [us for us, _ in ready], "hit": hits})

    answered = narrow.groupBy(key).applyInPandasWithState(
        step,
        f"`{key}` {types[key]}, `{ident}` {types[ident]}, _us bigint, hit boolean",
        "loaded bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return answered.select(key, ident, F.timestamp_micros("_us").cast(types[at]).alias(at), "hit")


@dataclass(frozen=True)
class CachedStream:
    """The same cache for accesses that come out of order by up to ``lateness``, in time order.

    An access waits until the watermark (the latest time seen, of any key, less ``lateness``) has
    passed it; then it is answered, in the order of time and ``ident``. So the answers do not depend on
    how the stream is cut. The state is two tables in the shared folder ``state``, written anew for each
    micro-batch and named after it, so a repeated micro-batch starts from the same one:

    * *waiting*: the accesses the watermark has not passed, plain rows. A key with a third of all
      accesses is as many rows in as many tasks as it needs; nothing gathers the wait of a key.
    * *loaded*: the load time of each key's entry, the only thing that goes from one time slice of a
      key to the next. An entry that has expired before the watermark is dropped.

    What the watermark has passed is answered by the operator for chains, hot keys slice by slice. Answers are
    written below ``path``, a folder for each micro-batch.

    An access later than ``lateness`` is answered with the first ones after it, as if it came at the
    watermark it missed. At the end of a finite stream the last ``lateness`` still waits: ``finish`` answers
    it, or accesses marked by ``closing`` do, which move the watermark and get no answer.
    Null keys are one key; null times are never answered.
    """

    key: str
    at: str
    ident: str
    ttl_ms: int
    lateness: str
    path: str
    state: str
    closing: Column | None = None
    slice_of: str = "day"
    hot_slice_of: str = "minute"

    def start(self, accesses: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer to be started with a trigger of one's own."""
        closes = F.lit(False) if self.closing is None else F.coalesce(self.closing, F.lit(False))
        at = F.col(self.at).cast("timestamp")
        narrow = accesses.select(
            F.col(self.key).alias("key"), F.col(self.ident).alias("ident"), F.unix_micros(at).alias("us"), closes.alias("closes")
        ).where("us is not null")
        return narrow.writeStream.foreachBatch(self._step).option("checkpointLocation", checkpoint)

    def answers(self, spark: SparkSession, schema: str) -> DataFrame:
        """(key, ident, at, hit) of all accesses answered so far; ``schema`` gives the types of ``key`` and ``ident``."""
        read = spark.read.schema(f"{schema}, us long, hit boolean").parquet(f"{self.path}/part=*")
        at = F.timestamp_micros("us").alias(self.at)
        return read.select(F.col("key").alias(self.key), F.col("ident").alias(self.ident), at, "hit")

    def finish(self, spark: SparkSession) -> None:
        """Answer all that waits, once the stream has ended; a later start of it goes on from there."""
        epochs = [int(name) for name in _names(spark, self.state) if name.isdigit()]
        if epochs:
            name = str(max(epochs))
            waiting, loaded, newest, mark = self._held(spark, name)
            if not _exists(spark, f"{self.state}/{name}-end"):
                self._advance(spark, f"{name}-end", waiting, loaded, newest, mark, ending=True)

    def _step(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = f"{epoch - 1}-end" if _exists(spark, f"{self.state}/{epoch - 1}-end") else str(epoch - 1)
        rows = batch.select("key", "ident", F.col("us").alias("at_us"), "us", "closes")
        if _exists(spark, f"{self.state}/{before}/mark"):
            waiting, loaded, newest, mark = self._held(spark, before)
            rows = rows.withColumn("us", F.greatest("us", F.lit(mark)))
        else:
            waiting, newest = rows.drop("closes").where("false"), None
            loaded = waiting.select("key", "us")
        latest = rows.agg(F.max("at_us")).first()[0]
        newest = max((x for x in (latest, newest) if x is not None), default=None)
        lateness = spark.sql(f"select unix_micros(timestamp'1970-01-01 00:00:00Z' + interval '{self.lateness}')").first()[0]
        mark = -(2**62) if newest is None else newest - lateness
        waiting = waiting.unionByName(rows.where("not closes").drop("closes"))
        self._advance(spark, str(epoch), waiting, loaded, newest, mark)
        for name in (str(epoch - 2), f"{epoch - 2}-end"):
            _drop(spark, f"{self.state}/{name}")

    def _held(self, spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame, int | None, int]:
        folder = f"{self.state}/{name}"
        mark = spark.read.schema("newest long, mark long").parquet(f"{folder}/mark").first()
        return spark.read.parquet(f"{folder}/waiting"), spark.read.parquet(f"{folder}/loaded"), mark.newest, mark.mark

    def _advance(
        self, spark: SparkSession, name: str, rows: DataFrame, loaded: DataFrame, newest: int | None, mark: int, ending: bool = False
    ) -> None:
        """Answer what lies before the mark, keep the rest as the state ``name``."""
        passed = F.lit(True) if ending else F.col("us") < mark
        if rows.where(passed).isEmpty():
            hits, entries = rows.where("false").select("key", "ident", "us", F.lit(False).alias("hit")), loaded
        else:
            hits, entries = self._answered(rows.where(passed), loaded)
        hits.write.mode("overwrite").parquet(f"{self.path}/part={name}")
        folder = f"{self.state}/{name}"
        if not ending:
            entries = entries.where(F.col("us") + self.ttl_ms * 1000 >= mark)
        entries.write.mode("overwrite").parquet(f"{folder}/loaded")
        rows.where(~passed).write.mode("overwrite").parquet(f"{folder}/waiting")
        # Written last: a state without it is not one.
        told = spark.createDataFrame([(newest, mark)], "newest long, mark long")
        told.coalesce(1).write.mode("overwrite").parquet(f"{folder}/mark")

    def _answered(self, ready: DataFrame, loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Answers to accesses, and the entries that are held after them."""
        every = ready.withColumn("turn", F.lit(1))
        # The entry of a key comes first: it is the mark its accesses start from.
        every = every.unionByName(loaded.withColumn("turn", F.lit(0)), allowMissingColumns=True)
        every = every.withColumn("lane", F.coalesce(F.concat(F.lit("="), F.col("key").cast("string")), F.lit("")))
        every = every.withColumn("moment", F.timestamp_micros("us"))
        slices = time_slices(every, ["lane"], "moment", self.slice_of, self.hot_slice_of)
        every = every.withColumns({"slice": slices, "hot": is_hot(every, ["lane"])}).drop("moment")
        marked = greedy_marks(
            every, ["lane"], "slice", ["us", "turn", "ident"], "us", "us", self.ttl_ms * 1000, keep=["key", "at_us"],
            cut=F.col("hot"),
        )
        marked = keep(marked, "stream-answers")
        hits = marked.where("turn = 1").select("key", "ident", F.col("at_us").alias("us"), (~F.col("is_mark")).alias("hit"))
        return hits, marked.groupBy("key").agg(F.max("mark_lo").alias("us"))


def _folder(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.exists(where)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _folder(spark, path)
    return [one.getPath().getName() for one in files.listStatus(where)] if files.exists(where) else []


def _drop(spark: SparkSession, path: str) -> None:
    files, where = _folder(spark, path)
    files.delete(where, True)
