"""Structured Streaming: incremental novelty, first-wins proofs, running counters, candidate status, expiring rules."""

from __future__ import annotations

import contextlib
import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Only a local session may do without one: it gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|\Z)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = LOCAL.setdefault("root", "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return root.rstrip("/")


LOCAL: dict[str, str] = {}


def work_folder(spark: SparkSession, what: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_root(spark)}/{what}-{uuid.uuid4().hex}"


#: state lies on disk and not in executor memory; a session that says otherwise is set to it while a stream of here runs
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextlib.contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE[0])
        else:
            spark.conf.set(STORE[0], before)


def drain(stream: DataFrame, folder: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Runs a stream over all that is there, batch by batch, and stops. The checkpoint in ``folder`` is the cursor: the
    same call later goes on where this one ended. State that never expires, such as host-years, is kept by RocksDB."""
    with state_on_disk(stream.sparkSession):
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()


#: batches that are kept apart before they are made one
BATCHES = 16


def compact(spark: SparkSession, sink: str, schema: StructType, keys: list[str], most: int = BATCHES) -> None:
    """Makes one of a sink's batches if there are more than ``most``, so that reading a sink costs what it holds and not how
    often it was written. The new part is whole before the old ones go; a run that was cut off is ended first."""
    where = spark._jvm.org.apache.hadoop.fs.Path
    files = where(sink).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where(sink)):
        return
    names = [s.getPath().getName() for s in files.listStatus(where(sink))]
    for name in names:
        if name.startswith("compact-"):
            n = int(name.removeprefix("compact-"))
            if files.exists(where(f"{sink}/{name}/_SUCCESS")):
                replace(files, where, sink, n, names)
            else:
                files.delete(where(f"{sink}/{name}"), True)
    numbers = sorted(int(s.getPath().getName().removeprefix("batch=")) for s in files.listStatus(where(sink)) if s.getPath().getName().startswith("batch="))
    if len(numbers) > most:
        newest(spark, sink, schema, keys).write.mode("overwrite").parquet(f"{sink}/compact-{numbers[-1]}")
        replace(files, where, sink, numbers[-1], [f"batch={n}" for n in numbers])


def replace(files: object, where: object, sink: str, n: int, names: list[str]) -> None:
    for name in names:
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= n:
            files.delete(where(f"{sink}/{name}"), True)
    files.rename(where(f"{sink}/compact-{n}"), where(f"{sink}/batch={n}"))


def newest(spark: SparkSession, sink: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The last state of each key that an update stream has written batch by batch."""
    columns, where = StructType([*schema.fields, StructField("batch", LongType())]), spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/batch=*")
    some = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    rows = spark.read.schema(columns).option("basePath", sink).parquet(f"{sink}/batch=*") if some else spark.createDataFrame([], columns)
    state = [c for c in schema.names if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*state), "batch").alias("__s")).select(*keys, "__s.*")


def keep(updates: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """Drains a stream of updates into ``folder`` and gives the last state of each key. A batch that runs again overwrites
    its own part."""
    sink = f"{folder}/states"
    compact(updates.sparkSession, sink, updates.schema, keys)
    drain(updates, folder, lambda rows, number: rows.write.mode("overwrite").parquet(f"{sink}/batch={number}"), "update")
    compact(updates.sparkSession, sink, updates.schema, keys)
    return newest(updates.sparkSession, sink, updates.schema, keys)


def incremental_novelty(host_years: DataFrame, baseline: DataFrame, folder: str) -> DataFrame:
    """Novel host-years (host, year and the other columns of their first row by ``seq``) of a stream.

    Rows are joined against the static baseline, then a streaming aggregate keeps the first row of each host-year in the
    state store. A batch reads and writes only the keys that it holds, however long the stream has run. Host-years never
    expire; they lie on disk.
    """
    names = [c for c in host_years.columns if c not in ("host", "year")]
    new = host_years.join(baseline.select("host", "year"), ["host", "year"], "left_anti")
    first = new.groupBy("host", "year").agg(F.min_by(F.struct(*names), "seq").alias("__r")).select("host", "year", "__r.*")
    return keep(first, folder, ["host", "year"]).select(*host_years.columns)


def identity(*tables: DataFrame) -> str:
    """One digest of tables, whatever the order of their rows and columns: counts and sums of row hashes, so only a
    row a table is gathered."""
    marks = []
    for t in tables:
        columns = sorted(t.columns)
        row = t.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), *columns)).alias("x")).first()
        marks.append(f"{columns}\t{row.n}\t{row.s}\t{row.x}")
    return hashlib.sha256("\n".join(marks).encode()).hexdigest()


def novelty_under(host_years: DataFrame, baseline: DataFrame, model: DataFrame, root: str) -> DataFrame:
    """Incremental novelty under an authority, a baseline and a weight model. The cursor lies in a folder named after
    their digest: the same authority goes on where it ended, another one replays the stream from zero."""
    return incremental_novelty(host_years, baseline, f"{root.rstrip('/')}/authority-{identity(baseline.select('host', 'year'), model)}")


def running_counters(samples: DataFrame, folder: str) -> DataFrame:
    """Counters by name over a stream of (name, value, ts, id): a sum, last value, largest and smallest. Of values of the
    same time the one of the greatest id is last. Update mode; the sink keeps the newest state of each name."""
    order = F.struct("ts", "id") if "id" in samples.columns else F.struct("ts", "value")
    totals = samples.groupBy("name").agg(F.sum("value").alias("total"), F.max_by("value", order).alias("last"), F.max("value").alias("highest"), F.min("value").alias("lowest"), F.count("*").alias("n"))
    return keep(totals, folder, ["name"])


def candidate_status(events: DataFrame) -> DataFrame:
    """T5: (host, status) of events (host, seq, status): a candidate is ACTIVE until its first terminal event by ``seq`` and stays
    what that made it. Over a stream, whichever batch brings that event: a host's row comes whenever its events do. A built-in
    aggregate holds the state, so rows of a host are combined before they move and no host calls Python."""
    terminal = F.col("status") != "ACTIVE"
    return events.groupBy("host").agg(F.coalesce(F.min_by("status", F.when(terminal, F.col("seq"))), F.lit("ACTIVE")).alias("status"))


def candidate_status_batch(events: DataFrame) -> DataFrame:
    """T5 over a table: the same aggregate."""
    return candidate_status(events)


def status_history(events: DataFrame, folder: str) -> DataFrame:
    """T5 with history: (host, status, reason, seq), a row for each status that a host (of a stream of host, seq, status,
    reason) has had: ACTIVE from its first event, then what its first terminal event made it. Later terminal events change
    nothing. Built-in aggregates hold the state, so no Python and no certain state store are needed."""
    terminal = F.when(F.col("status") != "ACTIVE", F.col("seq"))
    own = F.struct("status", "reason", "seq")
    states = keep(events.groupBy("host").agg(F.min("seq").alias("since"), F.min_by(own, terminal).alias("end")), folder, ["host"])
    active = F.struct(F.lit("ACTIVE").alias("status"), F.lit(None).cast("string").alias("reason"), F.col("since").alias("seq"))
    steps = F.explode(F.filter(F.array(active, F.col("end")), lambda x: x.isNotNull())).alias("x")
    return states.select("host", steps).select("host", "x.*")


#: the end of what has none
FOREVER = 1 << 62


class Suppression(StatefulProcessor):
    """A suppression holds until it expires. A newer one of the same key replaces it; a timer ends it, whether or not its
    key is seen again."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", StructType([StructField("set_at", LongType()), StructField("expires_at", LongType()), StructField("reason", StringType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        last = pd.concat(list(rows)).sort_values(["set_us", "expires_us"]).iloc[-1]
        now = (int(last["set_us"]), int(last["expires_us"]), last["reason"])
        if self.held.exists():
            before = self.held.get()
            if (before[0], before[1]) >= now[:2]:
                return
            if before[1] < FOREVER:
                self.handle.deleteTimer(-(-before[1] // 1000))
        self.held.update(now)
        if now[1] < FOREVER:
            self.handle.registerTimer(-(-now[1] // 1000))
        yield self.row(key, now, True)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        if self.held.exists():  # else it was replaced meanwhile
            now = self.held.get()
            if expiredTimerInfo.getExpiryTimeInMs() >= -(-now[1] // 1000):
                self.held.clear()
                yield self.row(key, now, False)

    def row(self, key: tuple, now: tuple, live: bool) -> pd.DataFrame:
        return pd.DataFrame({"scope": [key[0]], "key": [key[1]], "set_us": [now[0]], "expires_us": [now[1]], "reason": [now[2]], "live": [live]})

    def close(self) -> None:
        pass


def suppressions(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """T6 as a stream: (scope, key, set_us, expires_us, reason, live; times in microseconds) whenever a suppression (scope, key, set_at, expires_at,
    reason) begins, is replaced, or is over: when the stream's clock, the latest ``set_at`` less ``lateness``, has passed its
    end. What comes in later than that is dropped by the stream, and state goes when a suppression ends. A null
    ``expires_at`` never ends (``FOREVER``)."""
    rows = events.withWatermark("set_at", lateness).select("scope", "key", "set_at", F.unix_micros("set_at").alias("set_us"), F.coalesce(F.unix_micros("expires_at"), F.lit(FOREVER)).alias("expires_us"), "reason")
    return rows.groupBy("scope", "key").transformWithStateInPandas(
        statefulProcessor=Suppression(), outputStructType="scope string, key string, set_us long, expires_us long, reason string, live boolean", outputMode="Update", timeMode="EventTime"
    )


def suppression_states(events: DataFrame, folder: str, lateness: str = "1 hour") -> DataFrame:
    """The last state of each key of a stream of suppressions; the same call later goes on where this one ended."""
    return keep(suppressions(events, lateness), folder, ["scope", "key"])


def live_suppressions(events: DataFrame, now: F.Column) -> DataFrame:
    """The latest suppression (scope, key, set_at, expires_at) of each key that isn't over."""
    last = events.groupBy("scope", "key").agg(F.max_by("expires_at", "set_at").alias("expires_at"))
    return last.where(F.col("expires_at") > now)
