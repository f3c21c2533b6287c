"""Event streams: envelopes, idempotent merges, and windowed views.

The batch handlers are those of the batch operators; a stream adds only watermarks, removal of
repeated messages, and a ledger of batches that have been written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def envelopes(raw: DataFrame, data: str = "data") -> tuple[DataFrame, DataFrame]:
    """(messages with unique_id, malformed rows) of push envelopes: base64 text of a JSON object."""
    body = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    opened = raw.withColumn("unique_id", F.get_json_object(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"), "$.unique_id")).withColumn("body", body)
    good = F.col("unique_id").isNotNull() & (F.col("unique_id") != "")
    return opened.where(good), opened.where(~F.coalesce(good, F.lit(False))).drop("unique_id")


def once(messages: DataFrame, key: str = "unique_id", time: str = "event_time", late: str = "1 day") -> DataFrame:
    """Messages without repeats of a key within the watermark."""
    return messages.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def handled(handler: Callable[[DataFrame], None], dead_letters: Callable[[DataFrame, Exception], None], done: Callable[[int], bool], mark: Callable[[int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: batches that are done are skipped, failing ones go to the dead letters and are acknowledged."""

    def run(batch: DataFrame, number: int) -> None:
        if done(number):
            return
        try:
            handler(batch)
        except Exception as e:  # a poison message must not come back for ever
            dead_letters(batch, e)
        mark(number)

    return run


def start(messages: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Runs in micro-batches; without `every` all that is there, then stops."""
    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def views(events: DataFrame, time: str, *keys: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Views by window and key; a watermark drops what comes later than `late`."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("views"), F.approx_count_distinct("user_id").alias("users")).select(F.col("w.start").alias("start"), *keys, "views", "users")


def sliding_volume(events: DataFrame, time: str, key: str, width: str = "24 hours", step: str = "1 hour", late: str = "1 day") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, width, step).alias("w"), key).agg(F.count(F.lit(1)).alias("volume")).select(F.col("w.end").alias("until"), key, "volume")


def sessions(events: DataFrame, time: str, user: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), user, "n")


def read(spark: SparkSession, path: str, schema: str, files: int = 50, kind: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(path)


def append_by_day(stream: DataFrame, path: str, checkpoint: str, time: Column) -> StreamingQuery:
    return stream.withColumn("day", time.cast("date")).writeStream.format("parquet").partitionBy("day").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


# Topic -> workers that read it.
TOPICS = {"scraped": ("enrichment",), "enriched": ("features", "search", "bronze", "embeddings"), "embedded": ("search",)}


def start_topics(open_topic: Callable[[str], DataFrame], workers: dict[str, Callable[[DataFrame, int], None]], checkpoints: str, every: str | None = "10 seconds") -> dict[tuple[str, str], StreamingQuery]:
    """One query for each topic and worker, each with a checkpoint of its own: every worker reads all messages of its topics."""
    return {
        (topic, worker): start(once(envelopes(open_topic(topic))[0]), workers[worker], f"{checkpoints}/{topic}-{worker}", every)
        for topic, names in TOPICS.items() for worker in names if worker in workers
    }


def with_articles(messages: DataFrame, articles: DataFrame, key: str = "unique_id") -> DataFrame:
    """Messages with the article they name; messages of unknown articles are left out. articles is a static table."""
    return messages.join(articles, key)


def lost(sent: DataFrame, handled_: DataFrame, key: str = "unique_id") -> DataFrame:
    """Messages that no handler has written: what a daily reconciliation repeats."""
    return sent.join(handled_.select(key), key, "left_anti")
