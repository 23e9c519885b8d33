"""The transaction feed and its lookups as views over the test tables.

``events`` is the feed. Nulls, negative amounts, bad currencies and lookup gaps follow from
event_id, so that every rule and every missing-reference flag has rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.sources.lookups import SPECS, Lookup, check_lookups, with_heavy_keys

# Fixed values of the test model.
PLAN_ROWS = """
    values ('purchase', 299.99D, 'Low', 12), ('view', 29.99D, 'Medium', 1),
           ('click', 14.99D, 'High', 3)
    as plans(subscription_type, monthly_cost, churn_risk, plan_duration)
"""
IP_RISK_ROWS = 1024
PRODUCT_MAX_SIZE = 40
# A column of the flawed feed is null in every row whose number its value divides.
FLAWS = dict(zip(schemas.RAW.names, (31, 37, 41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83, 89, 97)))
UNLISTED_SEGMENT = "FURNITURE"

# Columns that the model reads; declared, so that opening a table needs no job.
COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
}

# Feeds come compressed: their lines repeat all keys. A file is read by one task.
FEED_CODEC = "gzip"
# Writes event_time to JSON with microseconds; the default keeps milliseconds.
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _text(value: Column) -> Column:
    return value.cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_view(events: DataFrame) -> DataFrame:
    """The 15 feed columns."""
    event_id, value = F.col("event_id"), F.col("value")
    return events.select(
        _text(event_id).alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        _text(F.col("user_id")).alias("user_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("event_type").alias("subscription_type"),
        F.when(event_id % 103 == 0, None).when(event_id % 101 == 0, -value).otherwise(value)
        .alias("amount"),
        F.concat(F.lit("City-"), _text(event_id % 5)).alias("location"),
        _ip_text(F.col("user_id") % 256, event_id % 8).alias("ip_address"),
        F.concat(F.lit("device_"), _text(event_id % 97)).alias("device_id"),
        F.when(event_id % 3 == 0, "PayPal").when(event_id % 3 == 1, "Credit Card")
        .otherwise("Apple Pay").alias("payment_method"),
        F.concat(F.lit("4"), F.lpad(_text(event_id), 15, "0")).alias("card_number"),
        F.when(event_id % 17 == 0, None).when(event_id % 19 == 0, "usd").otherwise("USD")
        .alias("currency"),
        (event_id % 2 == 0).alias("is_new_user"),
        F.when(event_id % 4 == 0, None).otherwise("REF123").alias("referral_code"),
        F.concat(F.lit("s"), _text(event_id)).alias("session_id"),
    )


def _ip_text(third: Column, fourth: Column) -> Column:
    return F.concat(F.lit("10.0."), _text(third), F.lit("."), _text(fourth))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_view(table(spark, sf_dir, "events"))


def of_many_lengths(df: DataFrame) -> DataFrame:
    """Card numbers cut or filled up to 10 to 19 digits, some with a letter, some null."""
    number = F.col("transaction_id").cast("long")
    digits = F.concat("card_number", F.lit("987")).substr(F.lit(1), (number % 10 + 10).cast("int"))
    return df.withColumn(
        "card_number",
        F.when(number % 29 == 0, None).when(number % 23 == 0, F.concat(digits, F.lit("x")))
        .otherwise(digits),
    )


def flawed(df: DataFrame) -> DataFrame:
    """The feed with bad cards and with nulls in every column."""
    number = F.col("__number")
    return of_many_lengths(df).withColumn("__number", F.col("transaction_id").cast("long")).select(*[
        F.when(number % every != 0, F.col(name)).alias(name) for name, every in FLAWS.items()
    ])


def skewed(df: DataFrame) -> DataFrame:
    """The feed with one user in a third of its rows and none in a tenth."""
    number = F.col("transaction_id").cast("long")
    return df.withColumn(
        "user_id", F.when(number % 10 == 7, None).when(number % 3 == 0, "1").otherwise(F.col("user_id"))
    )


def few_devices(df: DataFrame) -> DataFrame:
    """Devices of which a user has few, none in some rows, and times cut to two hours."""
    number = F.col("transaction_id").cast("long")
    return df.withColumns({
        "device_id": F.when(number % 11 != 0, F.concat(F.lit("device_"), _text(F.floor(number / 13) % 4))),
        "event_time": F.timestamp_seconds(F.floor(F.unix_seconds("event_time") / 7200) * 7200),
    })


def large_lookups(spark: SparkSession, sf_dir: str, feed: DataFrame) -> dict[str, Lookup]:
    """The lookups as if all were too large to broadcast, with the frequent keys of the feed."""
    return with_heavy_keys(check_lookups(lookup_frames(spark, sf_dir), broadcast_limit=0), feed)


def lookup_frames(
    spark: SparkSession, sf_dir: str, only: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    makers = {"users": _users, "products": _products, "plans": _plans, "ip_risk": _ip_risk}
    names = [spec.name for spec in SPECS] if only is None else only
    return {name: makers[name](spark, sf_dir) for name in names}


def lookups(
    spark: SparkSession, sf_dir: str, only: Sequence[str] | None = None
) -> dict[str, Lookup]:
    return check_lookups(lookup_frames(spark, sf_dir, only))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != UNLISTED_SEGMENT)
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _text(F.col("c_custkey")).alias("user_id"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("user_status"),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_size") <= PRODUCT_MAX_SIZE).select(
        _text(F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"select * from {PLAN_ROWS}")


def _ip_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, score = F.col("id"), F.col("risk_score")
    return (
        spark.range(0, IP_RISK_ROWS, numPartitions=1)
        .select(
            F.sha2(_ip_text(F.floor(n / 8), n % 8), 256).alias("ip_hash"),
            (n % 10 + 1).cast("double").alias("risk_score"),
            F.concat(F.lit("Region-"), _text(n % 5 + 1)).alias("location"),
        )
        .select(
            "ip_hash",
            F.when(score <= 3, "low").when(score <= 7, "medium").otherwise("high")
            .alias("risk_level"),
            "risk_score",
            "location",
        )
    )


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of addresses of many lengths that overlap: a wide one, some of each nation within it,
    some of customers within these and across their borders, and some given twice."""
    nation = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("10.0."), _text(F.col("n_nationkey") * 8), F.lit(".0/21")).alias("network"),
        F.col("n_name").alias("geo_country"), F.lit("nation").alias("geo_region"))
    key = F.col("c_custkey")
    customer = table(spark, sf_dir, "customer").where(key % 3 != 0).select(
        F.concat(_ip_text(key % 255, key % 4), F.lit("-"), _ip_text(key % 255 + key % 2, key % 4 + key % 5))
        .alias("network"),
        F.concat(F.lit("customer-"), _text(key)).alias("geo_country"),
        F.col("c_mktsegment").alias("geo_region"))
    wide = spark.sql("select '10.0.64.0-10.0.191.255' as network, 'wide' as geo_country, "
                     "cast(null as string) as geo_region")
    return nation.unionByName(customer).unionByName(wide)


def odd_addresses(df: DataFrame) -> DataFrame:
    """The feed with some addresses that are no IPv4 ones, and one address in a third of the rows."""
    number = F.col("transaction_id").cast("long")
    return df.withColumn(
        "ip_address", F.when(number % 31 == 0, None).when(number % 37 == 0, "10.0.0.256")
        .when(number % 41 == 0, "2001:db8::1").when(number % 43 == 0, F.concat("ip_address", F.lit("\n")))
        .when(number % 3 == 0, "10.0.65.3").otherwise(F.col("ip_address")))


def _dealt(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """The feed columns, dealt to so many tasks by session_id.

    The shuffle is of the narrow rows that the columns are made of.
    """
    session = F.concat(F.lit("s"), _text(F.col("event_id")))
    return raw_view(table(spark, sf_dir, "events").repartition(files, session))


def write_feed(
    spark: SparkSession, sf_dir: str, path: str, broken: bool = False, change=lambda rows: rows,
    codec: str = FEED_CODEC,
) -> int:
    """Write the feed as NDJSON, one file per shuffle partition, and return how many that are.

    With ``broken``, every 50th line is cut short and every 75th has a text as its amount.
    ``change`` alters the rows first. ``codec`` is that of the files, which a limit of a micro-batch
    by bytes counts as they are.
    """
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = change(_dealt(spark, sf_dir, files))
    number = F.substr("session_id", F.lit(2)).cast("long")
    line = F.to_json(F.struct(*schemas.RAW.names), {"timestampFormat": JSON_TIMESTAMP})
    if broken:
        line = (
            F.when(number % 50 == 0, line.substr(F.lit(1), F.length(line) - 10))
            .when(number % 75 == 0, F.to_json(
                F.struct("transaction_id", F.lit("n/a").alias("amount"))
            ))
            .otherwise(line)
        )
    rows.select(line.alias("value")).write.text(path, compression=codec)
    return files


def write_drifting_feed(spark: SparkSession, sf_dir: str, path: str) -> int:
    """A feed whose odd transactions have a new key (with numbers for some, texts for others), a
    number as their user, and no referral code at all."""
    number = F.col("transaction_id").cast("long")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _dealt(spark, sf_dir, files)
    old = F.to_json(F.struct(*schemas.RAW.names), {"timestampFormat": JSON_TIMESTAMP})
    kept = [F.col(n) for n in schemas.RAW.names if n not in ("user_id", "referral_code")]
    new = F.to_json(F.struct(
        *kept, F.col("user_id").cast("long").alias("user_id"),
        F.when(number % 5 != 0, F.concat(F.lit("app-"), _text(number % 7))).alias("channel"),
        F.when(number % 5 == 0, number % 3).alias("visits")), {"timestampFormat": JSON_TIMESTAMP})
    rows.select(
        F.when(number % 2 == 1, new).otherwise(old).alias("value")).write.text(path, compression=FEED_CODEC)
    return files


def move_files(spark: SparkSession, source: str, target: str, prefix: str, days_back: int) -> None:
    """Move the data files of a folder into another, dated some days back."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path(target))
    for status in files.listStatus(path(source)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            new = path(f"{target}/{prefix}-{name}")
            files.rename(status.getPath(), new)
            files.setTimes(new, status.getModificationTime() - days_back * 86_400_000, -1)


def write_lookups(spark: SparkSession, sf_dir: str, path: str) -> dict[str, str]:
    """Write the lookups as CSV folders with headers and return their paths."""
    paths = {}
    for name, frame in lookup_frames(spark, sf_dir).items():
        paths[name] = f"{path}/{name}"
        frame.write.option("header", True).option("escape", '"').csv(paths[name])
    return paths
