"""The streaming path: parse, deduplicate, enrich, layer, write."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.storagelevel import StorageLevel

from strataloom.functions.values import MONEY_SUM, money_sum
from strataloom.operators.joins import small_enough
from strataloom.operators.model import to_core, to_staging
from strataloom.session import delete
from strataloom.sources.messages import decode_messages, encode_messages

# Columns of a message, as a broker delivers them.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

Writer = Callable[[DataFrame, int], None]


# What one micro-batch reads at most, unless the options say otherwise: bytes of a
# folder of files, messages of a broker's topic.
BATCH_BYTES = str(16 * 1024**3)
BATCH_MESSAGES = "50000000"
_LIMITS = {"maxbytespertrigger", "maxfilespertrigger", "maxoffsetspertrigger"}
# Copies of each static row in a stream-static join, between which a key's rows are dealt.
SALTS = 8
# Share of a stream's rows above which a key is hot.
HOT_SHARE = 0.01


def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], schema: T.StructType,
                corrupt: bool = False) -> DataFrame:
    """The rows inside a stream of messages, with the messages' ``timestamp``.

    ``fmt`` is ``kafka``, or a file format over a folder of messages.  A micro-batch
    is bounded, by ``BATCH_BYTES`` or ``BATCH_MESSAGES`` if the options have no limit.
    """
    if not _LIMITS & {o.lower() for o in options}:
        limit = {"maxOffsetsPerTrigger": BATCH_MESSAGES} if fmt == "kafka" else {"maxBytesPerTrigger": BATCH_BYTES}
        options = {**options, **limit}
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(MESSAGE)
    return decode_messages(reader.load(), schema, keep=["timestamp"], corrupt=corrupt)


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """One row per key, remembered for ``delay`` of event time.

    The state is bounded by ``delay``.  The price: a row older than that is
    dropped even if it repeats nothing; ``late_rows`` counts them.
    """
    if isinstance(df.schema[event_time].dataType, T.TimestampNTZType):
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def hot_keys(rows: DataFrame, on: str, share: float = HOT_SHARE) -> list:
    """Values of ``on`` that more than ``share`` of ``rows`` hold, so fewer than ``1 / share``.

    ``rows`` are those of a stream that have landed already.  Null joins nothing and is
    not among them.
    """
    counts = rows.groupBy(on).agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*").alias("_n")).first()["_n"]
    return [r[0] for r in counts.where((F.col("_n") > share * total) & F.col(on).isNotNull()).select(on).collect()]


def enrich_stream(stream: DataFrame, dim: DataFrame, on: str, how: str = "inner", salts: int = SALTS,
                  hot: Sequence | None = None) -> DataFrame:
    """Stream rows with the columns of a static table, which has one row per ``on``.

    The join keeps no state.  The static side is read again by each micro-batch.  If it
    is small when the stream is set up it is broadcast, so no row of the stream moves;
    a session whose ``autoBroadcastJoinThreshold`` is -1 never does that.  Else both are
    shuffled, and as adaptive execution, which splits hot keys in batch, is off in a
    stateful stream, the rows of the keys in ``hot`` (see ``hot_keys``) are dealt to
    ``salts`` copies of their static rows.  Without ``hot`` any key may be hot, and
    every static row is copied.  Rows are dealt by a hash of all their values, so that a
    task that runs again deals them alike; equal rows go to one copy.
    """
    if how not in ("inner", "left"):
        raise ValueError("a stream-static join is inner or left")
    if dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1" and small_enough(dim):
        return stream.join(F.broadcast(dim), on, how)
    if salts == 1 or (hot is not None and not hot):
        return stream.join(dim, on, how)
    salt = "_salt"
    while salt in {*stream.columns, *dim.columns}:
        salt += "_"
    dealt, copies = F.pmod(F.xxhash64(*stream.columns), F.lit(salts)).cast("int"), F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        known = F.coalesce(F.col(on).isin(list(hot)), F.lit(False))
        dealt, copies = F.when(known, dealt).otherwise(0), F.when(known, copies).otherwise(F.array(F.lit(0)))
    return stream.withColumn(salt, dealt).join(dim.withColumn(salt, F.explode(copies)), [on, salt], how).drop(salt)


def zoned(df: DataFrame, event_time: str) -> DataFrame:
    """``df`` with an event time that watermarks and windows take."""
    if isinstance(df.schema[event_time].dataType, T.TimestampNTZType):
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def window_totals(df: DataFrame, event_time: str, size: str, slide: str, keys: Sequence[str],
                  aggs: Sequence[Column], delay: str | None = None) -> DataFrame:
    """``aggs`` for each ``keys`` and window of ``size`` that begins every ``slide``.

    Columns ``window_start`` and ``window_end`` come first; equal ``size`` and ``slide``
    are tumbling windows.  With ``delay`` the rows are a stream: a window is emitted once
    the watermark, ``delay`` behind the newest row, has passed its end, and its state is
    dropped.  Rows for windows that are done are dropped, and ``LateRows`` counts them
    after they were summed up per task, window and keys.
    Without it the rows are a table and all windows come.  Rows without time count nowhere.
    """
    df = zoned(df, event_time)
    if delay:
        df = df.withWatermark(event_time, delay)
    totals = df.groupBy(F.window(event_time, size, slide).alias("_window"), *keys).agg(*aggs)
    return totals.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
                         *[c for c in totals.columns if c != "_window"])


def session_totals(stream: DataFrame, event_time: str, gap: str, keys: Sequence[str], aggs: Sequence[Column],
                   delay: str) -> DataFrame:
    """``aggs`` for each session of ``keys``: rows no more than ``gap`` apart.

    A session ends ``gap`` after its last row.  It is emitted once the watermark has
    passed that end; until then sessions that a new row connects are merged.  Columns
    ``session_start`` and ``session_end`` come first.  ``windows.sessions`` is its twin
    for tables.
    """
    timed = zoned(stream, event_time).withWatermark(event_time, delay)
    totals = timed.groupBy(F.session_window(event_time, gap).alias("_session"), *keys).agg(*aggs)
    return totals.select(F.col("_session.start").alias("session_start"), F.col("_session.end").alias("session_end"),
                         *[c for c in totals.columns if c != "_session"])


def join_streams(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, within: str,
                 delay: str, how: str = "inner") -> DataFrame:
    """Rows of two streams with equal ``on``, the right one at most ``within`` after the left.

    Both bounds are in.  Each side remembers its rows only as long as a partner can still
    come: the left ``within`` and ``delay``, the right ``delay``.  With ``how`` ``left`` a
    row without a partner comes with nulls once none can come any more.  Other columns
    must have different names.
    """
    if how not in ("inner", "left"):
        raise ValueError("a stream-stream join is inner or left")
    l = zoned(left, left_time).withWatermark(left_time, delay)
    r = zoned(right, right_time).withWatermark(right_time, delay).withColumnRenamed(on, "_on")
    after = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    return l.join(r, (F.col(on) == F.col("_on")) & after, "leftOuter" if how == "left" else "inner").drop("_on")


class LateRows(StreamingQueryListener):
    """Counts the rows that streams drop behind their watermarks, and keeps the counts.

    Each micro-batch that drops rows writes its number to a folder of its own, by
    stream and batch, so the count lasts beyond the driver and a batch that is told
    of twice counts once.  A batch is told of after its commit: if the driver dies in
    between, that batch's number is lost, so the counts are a lower bound.  Add it
    with ``spark.streams.addListener`` before the stream starts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        if dropped:
            row = self.spark.createDataFrame([(dropped,)], "dropped bigint")
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/stream={progress.id}/batch={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def settle(self, seconds: float = 60) -> None:
        """Waits until a stream that has ended is fully counted."""
        if not self.ended.wait(seconds):
            raise TimeoutError("the stream's end was not told")

    def counted(self) -> DataFrame:
        """Rows (stream, batch, dropped)."""
        schema = "dropped bigint, stream string, batch bigint"
        # The folder is made by the first batch that drops rows.
        self.spark.createDataFrame([], "dropped bigint").write.mode("append").parquet(f"{self.path}/stream=none/batch=-1")
        return self.spark.read.schema(schema).parquet(self.path).select("stream", "batch", "dropped")


def batch_files(path: str) -> Writer:
    """A writer that gives each micro-batch a folder of its own.

    A batch that is replayed after a failure replaces its own folder.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def broker_messages(key_cols: Sequence[str], options: Mapping[str, str], fmt: str = "kafka") -> Writer:
    """A writer that sends each row as a message.

    A replayed batch sends its messages again; their readers deduplicate by key.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        encode_messages(df, key_cols).write.format(fmt).options(**options).mode("append").save()

    return write


def write_each_batch(stream: DataFrame, writers: Sequence[Writer], checkpoint: str,
                     trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Write each micro-batch to several targets while computing it once.

    Delivery is at least once, so a writer must key what it writes on the batch
    number, as ``batch_files`` does.  Between the writers the micro-batch, which
    ``read_stream`` bounds, lies on the executors' disks.
    """
    def fan_out(batch: DataFrame, batch_id: int) -> None:
        if len(writers) == 1:
            return writers[0](batch, batch_id)
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(fan_out).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def layers(root: str, source: str, load_ts: str, spec: Mapping[str, str]) -> Writer:
    """A writer that takes a micro-batch of events through staging and core into a mart.

    The mart holds counters per user *and batch*.  A replayed batch replaces its
    own share, and no batch rewrites the counters of the others.
    """
    def run_layers(batch: DataFrame, batch_id: int) -> None:
        to = lambda layer: batch_files(f"{root}/{layer}")
        to("staging")(to_staging(batch, source, load_ts), batch_id)
        spark = batch.sparkSession
        staged = spark.read.parquet(f"{root}/staging/batch_id={batch_id}")
        to("core")(to_core(staged, spec), batch_id)
        core = spark.read.parquet(f"{root}/core/batch_id={batch_id}")
        to("mart")(user_counters(core), batch_id)

    return run_layers


def user_counters(core: DataFrame) -> DataFrame:
    """Events, value and last activity per user of ``core(user_id, ts, value)``."""
    return core.groupBy("user_id").agg(
        F.count("*").alias("events"), money_sum(core, "value").alias("value"), F.max("ts").alias("last_seen"),
    )


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_id").agg(
        F.sum("events").alias("events"), F.sum("value").cast(MONEY_SUM).alias("value"),
        F.max("last_seen").alias("last_seen"),
    )


def counters_view(spark: SparkSession, root: str, made: int | None = None) -> DataFrame:
    """The mart of ``layers``, summed over its batches; ``made`` is the last ``fold_batches``."""
    parts = spark.read.parquet(f"{root}/mart")
    if made is not None:
        base = spark.read.parquet(f"{root}/base/upto={made}")
        parts = parts.where(F.col("batch_id") > made).select(*base.columns).unionByName(base)
    return _summed(parts)


def fold_batches(spark: SparkSession, root: str, upto: int, made: int | None = None) -> int:
    """Sums the mart's shares of the batches up to ``upto`` into one base table.

    ``made`` is what the last call returned, to be kept with the job; readers pass
    it to ``counters_view``.  Only batches that are finished may be folded.  The base
    goes to a folder of its own, so a fold that fails is simply run again, and readers
    of the older base are not disturbed; ``drop_folded`` removes what is not read
    any more.
    """
    start = -1 if made is None else made
    if upto <= start:
        return start
    whole = spark.read.parquet(f"{root}/mart").where(F.col("batch_id").between(start + 1, upto)).drop("batch_id")
    if made is not None:
        whole = whole.unionByName(spark.read.parquet(f"{root}/base/upto={made}"))
    _summed(whole).write.mode("overwrite").parquet(f"{root}/base/upto={upto}")
    return upto


def drop_folded(spark: SparkSession, root: str, made: int) -> None:
    """Deletes the layers' shares of all batches that the base ``made`` holds."""
    for layer in ("staging", "core", "mart"):
        batches = spark.read.parquet(f"{root}/{layer}").select("batch_id").where(F.col("batch_id") <= made).distinct()
        for r in batches.toLocalIterator():
            delete(spark, f"{root}/{layer}/batch_id={r[0]}")
