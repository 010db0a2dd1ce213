"""The ad-click log as text lines: format, parse, and the streaming sources.

A line is ``epochMillis area city userId adsId`` separated by single spaces;
fields after the fifth are ignored; a line with fewer than five fields, or
whose time, user or ad is not an integer, is bad. Bad lines are not dropped
silently: ``parse_ads_lines`` returns them as a second frame (with the reason)
so the caller can count or store them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEP = " "
ADS_COLUMNS = ["ts", "area", "city", "user_id", "ads_id"]

# Schema of the structured click files used as the replayable stream source.
ADS_FILE_SCHEMA = ("ts_ms bigint, area string, city string, user_id bigint, ads_id bigint, "
                   "event_id bigint")


def _token(c: Column) -> Column:
    """A field cannot hold the separator: spaces inside a name become ``_``."""
    return F.regexp_replace(c, SEP, "_")


def format_ads_lines(ads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``value`` lines from click rows (ts, area, city, user_id, ads_id), beside
    the columns to ``keep``."""
    return ads.select(*(keep or []), F.concat_ws(
        SEP, F.unix_millis("ts").cast("string"), _token(F.col("area")), _token(F.col("city")),
        F.col("user_id").cast("string"), F.col("ads_id").cast("string")).alias("value"))


def judge_ads_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Every line (``_line``) with its fields ts (TIMESTAMP), area, city, user_id, ads_id
    as far as they go, and why it is bad (``_reason``, null for a good one).

    A line is split and its fields are cast once: each step is a ``transform``
    of the one-element array that holds the line, and ``inline`` keeps later
    filters from pulling the steps back in at each use."""
    cut = F.transform(F.array(col), lambda x: F.struct(x.alias("line"), F.split(x, SEP).alias("parts")))
    typed = F.transform(cut, lambda x: F.struct(
        x["line"].alias("line"), F.size(x["parts"]).alias("fields"),
        F.get(x["parts"], F.lit(0)).try_cast("bigint").alias("ms"), F.get(x["parts"], F.lit(1)).alias("area"),
        F.get(x["parts"], F.lit(2)).alias("city"), F.get(x["parts"], F.lit(3)).try_cast("bigint").alias("user_id"),
        F.get(x["parts"], F.lit(4)).try_cast("bigint").alias("ads_id")))
    judged = F.transform(typed, lambda x: F.struct(
        x["line"].alias("_line"),
        F.when(x["line"].isNull(), F.lit("null line"))
        .when(x["fields"] < 5, F.lit("fewer than 5 fields"))
        .when(x["ms"].isNull(), F.lit("time is not an integer"))
        .when(x["user_id"].isNull(), F.lit("user is not an integer"))
        .when(x["ads_id"].isNull(), F.lit("ad is not an integer")).alias("_reason"),
        F.timestamp_millis(x["ms"]).alias("ts"), *[x[c].alias(c) for c in ADS_COLUMNS[1:]]))
    return lines.select(F.inline(judged))


def parse_ads_lines(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad): good has ts (TIMESTAMP), area, city, user_id, ads_id;
    bad has the line and a reason."""
    staged = judge_ads_lines(lines, col)
    good = staged.where(F.col("_reason").isNull()).select(*ADS_COLUMNS)
    bad = staged.where(F.col("_reason").isNotNull()).select(
        F.col("_line").alias("line"), F.col("_reason").alias("reason"))
    return good, bad


def landed_ads_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Good and bad lines by ``kind`` in one reading of them (as two frames a stream reads
    them twice): the columns of both frames, null in rows of the other kind."""
    staged, good = judge_ads_lines(lines, col), F.col("_reason").isNull()
    return staged.select(*[F.when(good, F.col(c)).alias(c) for c in ADS_COLUMNS],
                         F.when(~good, F.col("_line")).alias("line"), F.col("_reason").alias("reason"),
                         F.when(good, "good").otherwise("bad").alias("kind"))


def read_ads_kafka(spark: SparkSession, brokers: str, topic: str = "ads_log",
                   starting_offsets: str = "latest") -> DataFrame:
    """The Kafka topic of ad lines as a streaming ``value`` column.

    Needs the spark-sql-kafka package on the classpath (absent here, so this
    source is not exercised by the tests; the file source is its twin).
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("value").cast("string").alias("value")))


def read_ads_text_stream(spark: SparkSession, path: str,
                         files_per_trigger: int | None = None) -> DataFrame:
    """Replayable twin of the Kafka source: a folder of text files of lines.
    ``files_per_trigger`` limits a micro-batch (for replays); by default each
    takes all that has arrived."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def read_ads_file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of parquet click files (ts_ms, area, city, user_id, ads_id,
    event_id) as a stream with ``ts`` as TIMESTAMP."""
    return (spark.readStream.schema(ADS_FILE_SCHEMA)
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path)
            .withColumn("ts", F.timestamp_millis("ts_ms")))
