"""Structured Streaming jobs over event messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

VIEW = "goodsId STRING, cookieId STRING, memberId STRING, eventDate LONG, channel STRING, actType STRING, recResult STRUCT<goodsList: ARRAY<STRUCT<sid: STRING>>>, _corrupt STRING"
LOCATION = "createDate STRING, memberId STRING, memberLantitude STRING, memberLongitude STRING, method STRING, methodType STRING"
ROUTES = {"hotsale": "view", "dpgl": "view", "pcgl": "rec", "gyl": "rec"}


def file_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table's files as a stream, whether it is one file or a folder of them."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parque[t]")  # a pattern, since a plain path has to be a folder


def kafka_source(spark: SparkSession, servers: str, topics: list[str], starting: str = "latest") -> DataFrame:
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting).load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def socket_source(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def route_events(messages: DataFrame) -> DataFrame:
    """The fields of each JSON message in `value` and its route: view, rec or error (malformed or of an unknown kind)."""
    parsed = messages.withColumn("e", F.from_json("value", VIEW, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    route = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])[F.lower("e.actType")]
    return parsed.select("value", "e.*", F.when(F.col("e._corrupt").isNotNull() | route.isNull(), "error").otherwise(route).alias("route"))


def handle_views(routed: DataFrame, cookies: DataFrame) -> DataFrame:
    """member, goods, channel, ts of views: the cookie's member on the web, the message's own one elsewhere; none without one."""
    rows = routed.where("route = 'view'").join(cookies.select(F.col("cookie").alias("cookieId"), F.col("member").alias("_known")), "cookieId", "left")
    member = F.when(F.lower("channel") == "pc", F.col("_known")).otherwise(F.col("memberId"))
    return rows.select(member.alias("member"), F.col("goodsId").alias("goods"), "channel", F.timestamp_millis("eventDate").alias("ts")).where("member IS NOT NULL AND goods IS NOT NULL")


def explode_recs(routed: DataFrame) -> DataFrame:
    return routed.where("route = 'rec'").select("memberId", F.timestamp_millis("eventDate").alias("ts"), F.explode("recResult.goodsList.sid").alias("goods"))


def running_count(stream: DataFrame, key: str) -> DataFrame:
    return stream.groupBy(key).count()


def sliding_count(stream: DataFrame, ts: str, key: str, size: str = "1 hour", slide: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", size, slide).alias("w"), key).count().select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "count")


def session_count(stream: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.session_window("_ts", gap).alias("w"), key).count().select(F.col("w.start").alias("start"), key, "count")


def word_count(lines: DataFrame, stop: DataFrame, text: str = "value") -> DataFrame:
    words = lines.select(F.explode(F.split(F.lower(text), "[^\\p{L}\\p{N}]+")).alias("word")).where("word <> ''")
    return words.join(stop, "word", "left_anti").groupBy("word").count()


def location_log(messages: DataFrame) -> DataFrame:
    """The fields of location messages in `value`; those that are malformed or lack a field are dropped."""
    parsed = messages.select("value", F.from_json("value", LOCATION).alias("e")).select("value", "e.*")
    return parsed.dropna(how="any")


def with_log_keys(batch: DataFrame) -> DataFrame:
    """A batch of location messages under createDate|memberId|methodType|n, n counting up among equal ones."""
    by = ["createDate", "memberId", "methodType"]
    n = F.row_number().over(Window.partitionBy(*by).orderBy("value")) - 1
    return batch.select(F.concat_ws("|", *by, n.cast("string")).alias("key"), *batch.columns)


def last_views(views: DataFrame, cookies: DataFrame) -> DataFrame:
    """member, goods, ts: what each member viewed last, found by the cookie of the view (cookie, goods, ts)."""
    rows = views.join(cookies.select("cookie", "member"), "cookie")
    return rows.groupBy("member").agg(F.max(F.struct("ts", "goods")).alias("last")).select("member", "last.goods", "last.ts")


def drain(stream: DataFrame, path: str, mode: str = "complete", each: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> DataFrame:
    """Runs a stream over what is there now, with its checkpoint under `path`, and returns the rows of its last batch, or
    in append mode those of all batches. A batch that is run again after a failure replaces its own rows."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{path}/rows" if mode == "complete" else f"{path}/rows/batch={batch_id}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    schema = each(spark.createDataFrame([], stream.schema)).schema
    return spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names)


def received(query: StreamingQuery) -> int:
    """Messages read so far."""
    return sum(p["numInputRows"] for p in query.recentProgress)


def top_counts(counts: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Of a batch of running counts the `k` greatest."""
    return counts.orderBy(F.col("count").desc(), key).limit(k)


def batch_count(stream: DataFrame) -> DataFrame:
    return stream.groupBy().count()


def kept_and_dropped(lines: DataFrame, stop: DataFrame, text: str = "value") -> DataFrame:
    """dropped, count: words that the stop list lets pass and those that it drops."""
    words = lines.select(F.explode(F.split(F.lower(text), "[^\\p{L}\\p{N}]+")).alias("word")).where("word <> ''")
    marked = words.join(stop.select("word", F.lit(True).alias("dropped")), "word", "left")
    return marked.groupBy(F.coalesce("dropped", F.lit(False)).alias("dropped")).count()
