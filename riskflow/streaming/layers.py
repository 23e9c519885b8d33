"""The streaming jobs of each layer.

Each function starts queries and returns them; ``await_all`` waits. Every query has a checkpoint
of its own. Row-wise outputs (bronze, silver, risk, quarantine) use the file sink, so the next
layer can tail them. Reports and partial aggregates go to one folder per micro-batch.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow import schemas
from riskflow.operators import anomalies, joins, marts, quality
from riskflow.operators.bronze import pii_copy, to_bronze
from riskflow.operators.drift import ddl, drift, widest
from riskflow.operators.enrich import enrich, is_shuffled
from riskflow.operators.geo import Places, with_places
from riskflow.operators.timelines import VelocityRule
from riskflow.operators.validation import require_schema
from riskflow.sources.feed import (
    MAX_FILE_AGE, corrupt_rows, counted, good_rows, once, stream_feed, stream_lines, with_source,
)
from riskflow.sources.limits import parse_bytes
from riskflow.sources.lookups import Lookup
from riskflow.sources.tables import (
    by_date, by_date_parts, exists, read_table, require_adaptive, stream_table, table_or_empty, write_table,
)
from riskflow.streaming import lifetime
from riskflow.streaming.sinks import (
    overwrite_batch_json, overwrite_batch_table, read_state, start_batch_sink, start_table_sink,
    write_state,
)
from riskflow.streaming.timelines import (
    ready_for_state, stream_device_changes, stream_velocity,
)

# How far behind the newest event time a transaction may come and still be on its timeline.
TIMELINE_DELAY = "1 hour"


@dataclass(frozen=True)
class Store:
    """Folders of the pipeline. ``restricted`` holds clear personal data; guard it accordingly.

    Quarantine and the clear-text copy need it: they never go into the ordinary store.
    """

    root: str
    restricted: str | None = None

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def partials(self, name: str) -> str:
        return f"{self.root}/partials/{name}"

    def dq(self, layer: str) -> str:
        return f"{self.root}/dq/layer={layer}"

    def dq_root(self) -> str:
        return f"{self.root}/dq"

    def feed_counts(self) -> str:
        return f"{self.root}/feed_counts"

    def lifetime(self) -> str:
        return f"{self.root}/lifetime"

    def join_metrics(self) -> str:
        return f"{self.root}/join_metrics"

    def amounts(self) -> str:
        return f"{self.root}/amount_sketches"

    def drift(self) -> str:
        return f"{self.root}/drift"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"

    def state(self, job: str) -> str:
        return f"{self.root}/state/{job}"

    def compacted(self, name: str, run: str) -> str:
        return f"{self.root}/compacted/{name}/run={run}"

    def segments(self, run: str) -> str:
        return f"{self.root}/segments/run={run}"

    def laid_out(self, run: str) -> str:
        return f"{self.root}/laid_out/run={run}"

    def private(self, name: str) -> str:
        if not self.restricted:
            raise ValueError(f"{name} holds clear personal data: name a restricted folder")
        return f"{self.restricted}/{name}"


@dataclass(frozen=True)
class Pace:
    """Size limits of a micro-batch, and the interval of a query that is to keep running."""

    max_files: int | None = None
    max_bytes: int | str | None = None
    interval: str | None = None

    def __post_init__(self) -> None:
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("limit a micro-batch by files or by bytes, not by both")
        if self.max_bytes is not None:
            parse_bytes(self.max_bytes)

    def of_tables(self) -> Pace:
        """The pace of a query over a layer table, whose files are others than the feed's."""
        return Pace(max_bytes=self.max_bytes, interval=self.interval)


def start_bronze(
    spark: SparkSession, feed: str, store: Store, pace: Pace = Pace(),
    card_salt: str | None = None, gather_dates: bool = True,
    max_file_age: str = MAX_FILE_AGE, places: Places | None = None, audit: bool = False,
    repeats_within: str | None = None, more: T.StructType = T.StructType(),
) -> list[StreamingQuery]:
    """Feed to bronze, with the lines and corrupt lines of each batch as its metric ``feed``.

    Gathering the dates shuffles the feed; turn it off for a feed whose files hold one date each.
    ``places`` adds the place of the address, ``audit`` the file and time that a row came with.
    With ``repeats_within`` a transaction that is sent again within that time lands once, and the
    metric ``landed`` counts what did. ``more`` are further keys of the feed that are kept.
    """
    lines = stream_feed(spark, feed, pace.max_files, pace.max_bytes, max_file_age, more=more)
    source = schemas.AUDIT.names if audit or repeats_within else []
    lines = counted(with_source(lines) if source else lines)
    rows = require_schema(good_rows(lines, source + more.names), schemas.RAW, "raw")
    if repeats_within:
        ready_for_state(spark)
        rows = once(rows, repeats_within).observe("landed", F.count(F.lit(1)).alias("landed"))
    if places:
        rows = with_places(rows, places)
    keep = (schemas.GEO.names if places else []) + (source if audit else []) + more.names
    bronze = to_bronze(rows, card_salt, keep=keep)
    if gather_dates and repeats_within:
        bronze = by_date_parts(bronze, "transaction_id")
    elif gather_dates:
        require_adaptive(spark)
        bronze = by_date(bronze)
    return [start_table_sink(
        bronze, store.table("bronze"), store.checkpoint("bronze"), "bronze", interval=pace.interval,
    )]


def start_sources(
    spark: SparkSession, feed: str, store: Store, pace: Pace = Pace(),
    max_file_age: str = MAX_FILE_AGE,
) -> list[StreamingQuery]:
    """Where each good line came from, repeats too: a row per line with its transaction, file and
    time. A parse of its own."""
    lines = with_source(stream_feed(spark, feed, pace.max_files, pace.max_bytes, max_file_age))
    rows = good_rows(lines, schemas.AUDIT.names).withColumn("ingest_date", F.to_date("ingested_at"))
    return [start_table_sink(
        rows.select(*schemas.SOURCES.names), store.table("sources"), store.checkpoint("sources"),
        "sources", partition_by=("ingest_date",), interval=pace.interval,
    )]


def start_quarantine(
    spark: SparkSession, feed: str, store: Store, pace: Pace = Pace(),
    max_file_age: str = MAX_FILE_AGE, more: T.StructType = T.StructType(),
) -> list[StreamingQuery]:
    """Corrupt lines to the restricted store. A parse of its own, of all files since its last run."""
    lines = stream_feed(spark, feed, pace.max_files, pace.max_bytes, max_file_age, more=more)
    return [start_table_sink(
        corrupt_rows(lines), store.private("quarantine"), store.checkpoint("quarantine"),
        "quarantine", partition_by=(), fmt="json", interval=pace.interval,
    )]


def start_drift(
    spark: SparkSession, feed: str, store: Store, pace: Pace = Pace(),
    max_file_age: str = MAX_FILE_AGE, declared: T.StructType = schemas.RAW,
) -> list[StreamingQuery]:
    """For each batch of the feed its keys and kinds of values, and how they differ from
    ``declared``. A parse of its own."""
    def write_drift(batch: DataFrame, batch_id: int) -> None:
        overwrite_batch_json(drift(batch, declared).coalesce(1), store.drift(), batch_id)

    lines = stream_lines(spark, feed, pace.max_files, pace.max_bytes, max_file_age)
    return [start_batch_sink(lines, write_drift, store.checkpoint("drift"), "drift", pace.interval)]


def read_drift(spark: SparkSession, store: Store) -> DataFrame:
    return spark.read.schema(schemas.DRIFT).json(store.drift())


def more_columns(spark: SparkSession, store: Store) -> T.StructType:
    """The further keys that bronze has come to keep."""
    kept = read_state(spark, store.state("more-columns"), "ddl").get("ddl")
    return T.StructType.fromDDL(kept) if kept else T.StructType()


def keep_more(spark: SparkSession, store: Store, more: T.StructType) -> T.StructType:
    """Record further keys; a key that was kept before stays, with the wider of both types."""
    old = more_columns(spark, store)
    merged = widest(old, more)
    taken = [name for name in merged.names if name in schemas.RISK.names + schemas.AUDIT.names + schemas.GEO.names]
    if taken:
        raise ValueError(f"names that the tables use themselves: {taken}")
    if merged != old:
        write_state(spark, store.state("more-columns"), ddl=ddl(merged))
    return merged


def read_bronze(spark: SparkSession, store: Store) -> DataFrame:
    """The bronze table over files of all its schemas: a column that a file lacks is null, and one
    of a narrower type is read as the wider one."""
    return read_table(spark, store.table("bronze"),
                      T.StructType(schemas.BRONZE.fields + more_columns(spark, store).fields))


def start_pii(
    spark: SparkSession, feed: str, store: Store, pace: Pace = Pace(),
    max_file_age: str = MAX_FILE_AGE,
) -> list[StreamingQuery]:
    """The clear-text copy to the restricted store, a parse of its own."""
    target = store.private("pii")

    def write_pii(batch: DataFrame, batch_id: int) -> None:
        overwrite_batch_json(batch, target, batch_id)

    raw = good_rows(stream_feed(spark, feed, pace.max_files, pace.max_bytes, max_file_age))
    return [start_batch_sink(
        pii_copy(raw), write_pii, store.checkpoint("pii"), "pii", pace.interval,
    )]


def start_bronze_dq(spark: SparkSession, store: Store, pace: Pace = Pace()) -> list[StreamingQuery]:
    bronze = stream_table(
        spark, store.table("bronze"), schemas.BRONZE, pace.max_files, pace.max_bytes
    )
    return [_start_dq(bronze, quality.bronze_rules(), "bronze", store, pace)]


def start_silver(
    spark: SparkSession, store: Store, lookups: Mapping[str, Lookup], pace: Pace = Pace()
) -> list[StreamingQuery]:
    """Bronze to silver: a row-wise stream-static join.

    With broadcast lookups, or near keys, there is no shuffle, and files hold one date as those of
    bronze do. A shuffle join mixes the dates, so they are gathered again.
    """
    bronze = stream_table(
        spark, store.table("bronze"), schemas.BRONZE, pace.max_files, pace.max_bytes
    )
    silver = require_schema(enrich(bronze, lookups), schemas.SILVER, "silver")
    silver = silver.select(*schemas.SILVER.names)
    shuffled = any(is_shuffled(lookup) for lookup in lookups.values())
    if shuffled:
        require_adaptive(spark)
    return [start_table_sink(
        by_date(silver) if shuffled else silver, store.table("silver"), store.checkpoint("silver"),
        "silver", interval=pace.interval,
    )]


def start_silver_dq(
    spark: SparkSession, store: Store, pace: Pace = Pace(),
    high_risk_score: float = quality.HIGH_RISK_SCORE,
) -> list[StreamingQuery]:
    """The report on the written silver table, so that the joins do not run again."""
    return [_start_dq(
        _silver(spark, store, pace), quality.silver_rules(high_risk_score), "silver", store, pace
    )]


def start_join_metrics(
    spark: SparkSession, store: Store, pace: Pace = Pace()
) -> list[StreamingQuery]:
    """Counts and sketches of lookups' misses, a folder per batch of the written silver table."""
    def write_metrics(batch: DataFrame, batch_id: int) -> None:
        joins.join_metrics(batch).coalesce(1).write.mode("overwrite").parquet(
            f"{store.join_metrics()}/batch_id={batch_id}")

    return [start_batch_sink(
        _silver(spark, store, pace).select(*joins.INPUT), write_metrics,
        store.checkpoint("join_metrics"), "join_metrics", pace.interval,
    )]


def read_join_metrics(spark: SparkSession, store: Store) -> DataFrame:
    """Per lookup over all batches."""
    found = table_or_empty(spark, store.join_metrics(), schemas.JOIN_METRICS)
    return joins.merged_metrics(found)


def start_risk(spark: SparkSession, store: Store, pace: Pace = Pace()) -> list[StreamingQuery]:
    return [start_table_sink(
        marts.flag_high_risk(_silver(spark, store, pace)), store.table("risk"),
        store.checkpoint("risk"), "risk", interval=pace.interval,
    )]


def start_spend(spark: SparkSession, store: Store, pace: Pace = Pace()) -> list[StreamingQuery]:
    return [_start_partials(
        _silver(spark, store, pace), marts.SPEND_INPUT, marts.spend_partial, "spend", store, pace
    )]


def start_usage(spark: SparkSession, store: Store, pace: Pace = Pace()) -> list[StreamingQuery]:
    return [_start_partials(
        _silver(spark, store, pace), marts.USAGE_INPUT, marts.usage_partial, "usage", store, pace
    )]


def start_velocity(
    spark: SparkSession, store: Store, pace: Pace = Pace(), rule: VelocityRule = VelocityRule(),
    delay: str = TIMELINE_DELAY,
) -> list[StreamingQuery]:
    """Velocity of bronze transactions, written once final."""
    return [start_table_sink(
        stream_velocity(_bronze(spark, store, pace), rule, delay), store.table("velocity"),
        store.checkpoint("velocity"), "velocity", interval=pace.interval,
    )]


def start_devices(
    spark: SparkSession, store: Store, pace: Pace = Pace(), delay: str = TIMELINE_DELAY,
) -> list[StreamingQuery]:
    """Changes of device of bronze transactions, written once final."""
    return [start_table_sink(
        stream_device_changes(_bronze(spark, store, pace), delay), store.table("devices"),
        store.checkpoint("devices"), "devices", interval=pace.interval,
    )]


def start_lifetime(
    spark: SparkSession, store: Store, pace: Pace = Pace(), buckets: int = lifetime.BUCKETS
) -> list[StreamingQuery]:
    """Lifetime value per user over all bronze batches. The number of buckets stays what it was
    when the table began."""
    kept = read_state(spark, store.state("lifetime"), "buckets").get("buckets")
    if kept is None:
        write_state(spark, store.state("lifetime"), buckets=buckets)
    elif int(kept) != buckets:
        raise ValueError(f"the lifetime table has {kept} buckets")

    def write(batch: DataFrame, batch_id: int) -> None:
        lifetime.write_batch(batch, batch_id, store.lifetime(), buckets)

    return [start_batch_sink(
        _bronze(spark, store, pace).select(*lifetime.INPUT), write, store.checkpoint("lifetime"),
        "lifetime", pace.interval,
    )]


def read_lifetime(spark: SparkSession, store: Store) -> DataFrame:
    return lifetime.lifetime(spark, store.lifetime())


def start_amounts(spark: SparkSession, store: Store, pace: Pace = Pace()) -> list[StreamingQuery]:
    """A sketch of each user's amounts in a batch, a folder per bronze batch, which a replay replaces."""
    def write(batch: DataFrame, batch_id: int) -> None:
        anomalies.amount_sketches(batch).write.mode("overwrite").parquet(f"{store.amounts()}/batch_id={batch_id}")

    return [start_batch_sink(
        _bronze(spark, store, pace).select(*anomalies.INPUT), write, store.checkpoint("amounts"), "amounts",
        pace.interval,
    )]


def read_amounts(spark: SparkSession, store: Store) -> DataFrame:
    """Per user over all batches."""
    return anomalies.merged_sketches(table_or_empty(spark, store.amounts(), schemas.AMOUNT_SKETCHES))


@dataclass(frozen=True)
class Daily:
    """A daily table: its partials' columns, how they fold, what they read as, and their key."""

    schema: T.StructType
    fold: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    key: str


DAILY = {
    "spend": Daily(schemas.SPEND_PARTIAL, marts.fold_spend, marts.merge_spend, "user_id"),
    "usage": Daily(schemas.USAGE_PARTIAL, marts.fold_usage, marts.merge_usage, "product_id"),
}


def partials(
    spark: SparkSession, store: Store, name: str, until: int | None = None
) -> DataFrame:
    """What batches added to a daily table, with closed dates folded as far as they were.

    ``until`` leaves out batches after that one, whenever they come.
    """
    daily = DAILY[name]
    rows = table_or_empty(spark, store.partials(name), daily.schema)
    if until is not None:
        rows = rows.where(F.col("batch_id") <= until)
    done = _compacted(spark, store, name)
    if not done:
        return rows
    folded = (F.col("batch_id") <= int(done["batch_id"])) & (
        F.col("event_date") < F.lit(dt.date.fromisoformat(done["before"]))
    )
    old = read_table(spark, store.compacted(name, done["run"]), daily.schema)
    return rows.where(~F.coalesce(folded, F.lit(False))).unionByName(old)


def _compacted(spark: SparkSession, store: Store, name: str) -> dict[str, str]:
    return read_state(spark, store.state(f"compacted-{name}"), "run", "batch_id", "before")


def _last_batch(spark: SparkSession, store: Store, name: str) -> int | None:
    """The last batch whose partials are whole: one that is being written has no success mark."""
    rows = table_or_empty(spark, store.partials(name), DAILY[name].schema)
    last = rows.agg(F.max("batch_id")).first()[0]
    if last is None or exists(spark, f"{store.partials(name)}/batch_id={last}/_SUCCESS"):
        return last
    return rows.where(F.col("batch_id") < last).agg(F.max("batch_id")).first()[0]


def compact(spark: SparkSession, store: Store, name: str, before: dt.date) -> None:
    """Fold the partials of the dates before ``before`` into one row per key and date.

    It may run beside the query that writes them: what is folded is fixed first, all whole batches
    up to the last one, and batches that end meanwhile are added as ever when the table is read.
    The folded copy is written and becomes the one that is read with the small record of this run.
    A record never goes back behind an earlier one, neither in batches nor in dates. Folders of
    earlier runs and the folded partials may be removed when no reader uses them.
    """
    last, done = _last_batch(spark, store, name), _compacted(spark, store, name)
    if done:
        last = max(int(done["batch_id"]), -1 if last is None else last)
        before = max(before, dt.date.fromisoformat(done["before"]))
    if last is None:
        return
    closed = partials(spark, store, name, last).where(F.col("event_date") < F.lit(before))
    run = uuid.uuid4().hex
    folded = DAILY[name].fold(closed).withColumn("batch_id", F.lit(last).cast("long"))
    write_table(folded, store.compacted(name, run))
    write_state(spark, store.state(f"compacted-{name}"), run=run, batch_id=last, before=before)


def read_spend(spark: SparkSession, store: Store) -> DataFrame:
    """One row per user-day over all batches."""
    return marts.merge_spend(partials(spark, store, "spend"))


def read_usage(spark: SparkSession, store: Store) -> DataFrame:
    """One row per product-day over all batches."""
    return marts.merge_usage(partials(spark, store, "usage"))


def read_alerts(spark: SparkSession, store: Store) -> DataFrame:
    """The flagged rows of the stored table."""
    return read_table(spark, store.table("risk"), schemas.RISK).where("is_high_risk_txn")


def read_feed_counts(spark: SparkSession, store: Store) -> DataFrame:
    """Lines, corrupt lines and repeated lines of each batch of the feed."""
    return spark.read.schema(schemas.FEED_COUNTS).json(store.feed_counts())


def read_dq(spark: SparkSession, store: Store) -> DataFrame:
    return spark.read.schema(schemas.DQ_REPORT).json(store.dq_root()).select(
        *schemas.DQ_REPORT.names
    )


def _bronze(spark: SparkSession, store: Store, pace: Pace) -> DataFrame:
    return stream_table(
        spark, store.table("bronze"), schemas.BRONZE, pace.max_files, pace.max_bytes
    )


def _silver(spark: SparkSession, store: Store, pace: Pace) -> DataFrame:
    return stream_table(
        spark, store.table("silver"), schemas.SILVER, pace.max_files, pace.max_bytes
    )


def _start_dq(table, rules, layer, store, pace) -> StreamingQuery:
    def write_report(batch: DataFrame, batch_id: int) -> None:
        report = quality.dq_report(batch, rules, layer, batch_id)
        overwrite_batch_json(
            report.drop("layer", "batch_id").withColumn("written_at", F.current_timestamp()),
            store.dq(layer), batch_id,
        )

    name = f"{layer}_dq"
    return start_batch_sink(table, write_report, store.checkpoint(name), name, pace.interval)


def _start_partials(silver, columns, partial, name, store, pace) -> StreamingQuery:
    """The columns are chosen before the callback: the plan of a micro-batch ends at its border,
    and a later choice would not reach the scan."""
    def write_partials(batch: DataFrame, batch_id: int) -> None:
        overwrite_batch_table(partial(batch), store.partials(name), batch_id)

    return start_batch_sink(
        silver.select(*columns), write_partials, store.checkpoint(name), name, pace.interval
    )
