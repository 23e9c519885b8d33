"""The three layers run one after the other on all input there is, or kept running side by side."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow import schemas
from riskflow.operators import anomalies, marts
from riskflow.operators.enrich import NOT_NEAR, enrich
from riskflow.operators.geo import Places
from riskflow.operators.layout import ROWS_PER_FILE, cluster_table, file_count, write_clustered
from riskflow.operators.reconcile import compare_daily, compare_layers
from riskflow.operators.timelines import VelocityRule
from riskflow.sources.feed import MAX_FILE_AGE
from riskflow.sources.lookups import BROADCAST_LIMIT_BYTES, Lookup, with_heavy_keys, with_near_keys
from riskflow.sources.tables import exists, find_table, read_table, table_or_empty, write_table
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store
from riskflow.streaming.sinks import (
    Observed, await_all, overwrite_batch_json, read_state, write_state,
)

# Files are taken for new if they were written this long before the last run began, as clocks differ.
CLOCK_MARGIN = dt.timedelta(hours=1)
ANOMALY_COLUMNS = (
    "transaction_id", "user_id", "event_time", "amount", "velocity_score", "device_changed", "device_is_new",
    "risk_score", "usual_amount", "high_amount", "anomaly_class", "event_date",
)


def run_bronze(
    spark: SparkSession, feed: str, store: Store, pace: Pace = Pace(), dq: bool = True,
    keep_corrupt: bool = True, keep_pii: bool = False, card_salt: str | None = None,
    gather_dates: bool = True, timeout: float | None = None, max_file_age: str = MAX_FILE_AGE,
    places: Places | None = None, audit: bool = False, repeats_within: str | None = None,
    more: T.StructType = T.StructType(), watch_drift: bool = False,
) -> dict[str, int | None]:
    """Take all new files of the feed. Returns the numbers of lines and corrupt lines (None with
    an interval, or if a batch did not tell), which are also written per batch as batches end,
    whatever is kept, with the number of lines that repeat a transaction.

    ``audit`` adds the source of each row and keeps the table of all lines' sources. ``more`` are
    further keys of the feed to keep, which later runs keep as well; ``watch_drift`` writes for each
    batch how its keys and types differ from the declared ones.

    ``pace`` limits the feed; the report tails the bronze table, whose files are other ones. A
    clean feed is parsed once, also with an interval: the quarantine runs only when corrupt lines
    were met, or if an earlier run ended before it knew, and takes all files since its last run.
    """
    for name, wanted in (("quarantine", keep_corrupt), ("pii", keep_pii)):
        if wanted:
            store.private(name)  # refuses a store without a restricted folder
    # Marked before the feed is read and cleared when its corrupt lines are known to be kept.
    pending = read_state(spark, store.state("quarantine"), "open").get("open") == "yes"
    if not pending:
        write_state(spark, store.state("quarantine"), open="yes")
    beside = layers.start_pii(spark, feed, store, pace, max_file_age) if keep_pii else []
    if audit:
        beside += layers.start_sources(spark, feed, store, pace, max_file_age)
    more = layers.keep_more(spark, store, more)
    if watch_drift:
        declared = T.StructType(schemas.RAW.fields + more.fields)
        beside += layers.start_drift(spark, feed, store, pace, max_file_age, declared)
    options = {"places": places, "audit": audit, "repeats_within": repeats_within, "more": more}
    if pace.interval is not None:  # the mark stays: a stopped run may not know of its last batch
        once = Pace(pace.max_files, pace.max_bytes)
        late = _OnDemand(
            lambda: layers.start_quarantine(spark, feed, store, once, max_file_age, more), pending,
        ) if keep_corrupt else None
        _await_counted(spark, store, lambda: start_bronze_layer(
            spark, feed, store, pace, dq, False, card_salt, gather_dates, max_file_age, **options,
        ), beside, timeout, late)
        return {"lines": None, "corrupt_lines": None}
    counts = _await_counted(spark, store, lambda: layers.start_bronze(
        spark, feed, store, pace, card_salt, gather_dates, max_file_age, **options), beside, timeout)
    lines, corrupt = counts or (None, None)
    missing = corrupt != 0 or pending
    if missing and keep_corrupt:
        await_all(layers.start_quarantine(spark, feed, store, pace, max_file_age, more), timeout)
    if keep_corrupt or not missing:  # else a later run with a quarantine takes the lines up
        write_state(spark, store.state("quarantine"), open="no")
    if dq:
        await_all(layers.start_bronze_dq(spark, store, pace.of_tables()), timeout)
    return {"lines": lines, "corrupt_lines": corrupt}


def start_bronze_layer(
    spark: SparkSession, feed: str, store: Store, pace: Pace, dq: bool = True,
    keep_corrupt: bool = True, card_salt: str | None = None, gather_dates: bool = True,
    max_file_age: str = MAX_FILE_AGE, **options,
) -> list[StreamingQuery]:
    """Bronze, quarantine and report side by side."""
    queries = layers.start_bronze(
        spark, feed, store, pace, card_salt, gather_dates, max_file_age, **options)
    if keep_corrupt:
        queries += layers.start_quarantine(spark, feed, store, pace, max_file_age)
    if dq:
        queries += layers.start_bronze_dq(spark, store, pace.of_tables())
    return queries


class _OnDemand:
    """Queries that run to their end beside others whenever they are called for."""

    def __init__(self, start: Callable[[], list[StreamingQuery]], due: bool) -> None:
        self._start, self._due, self._running = start, due, []

    def call(self) -> None:
        self._due = True

    def look(self) -> None:
        """Start if due and not running yet; an error in a run is raised here."""
        for query in self._running:
            if query.isActive:
                return
            query.awaitTermination()
        self._running = []
        if self._due:
            self._due, self._running = False, self._start()

    def stop(self) -> None:
        for query in self._running:
            if query.isActive:
                query.stop()


def _await_counted(
    spark: SparkSession, store: Store, start: Callable[[], list[StreamingQuery]],
    others: list[StreamingQuery], timeout: float | None, on_corrupt: _OnDemand | None = None,
) -> tuple[int, int] | None:
    """Start queries, bronze first, and wait; each batch's counts are written after it has ended.

    ``on_corrupt`` is called for by a batch with corrupt lines. A folder per batch under the reports, layer ``feed``; a replay replaces it. Returns the sums
    of lines and corrupt lines, None if a batch's counts did not come.
    """
    told, first, last, sums = Observed("feed", "landed"), None, None, [0, 0, 0]

    def write() -> None:
        nonlocal first, last
        for c in told.take(queries[0]):
            values = c["lines"], c["corrupt_lines"]
            good = values[0] - values[1]
            row = spark.createDataFrame(
                [(*values, good - c.get("landed", good))], "lines long, corrupt_lines long, repeated_lines long")
            overwrite_batch_json(row.coalesce(1), store.feed_counts(), c["batch_id"])
            first, last = c["batch_id"] if first is None else first, c["batch_id"]
            sums[:] = sums[0] + 1, sums[1] + values[0], sums[2] + values[1]
            if on_corrupt and values[1]:
                on_corrupt.call()
        if on_corrupt:
            on_corrupt.look()

    spark.streams.addListener(told)
    try:
        queries = start()
        try:
            await_all(queries + others, timeout, write)
        finally:
            whole = told.wait(queries[0])
            write()
    finally:
        spark.streams.removeListener(told)
        if on_corrupt:
            on_corrupt.stop()
    whole = whole and (first is None or sums[0] == last - first + 1)
    return (sums[1], sums[2]) if whole else None


def run_silver(
    spark: SparkSession, store: Store, lookups: Mapping[str, Lookup], pace: Pace = Pace(),
    dq: bool = True, timeout: float | None = None, since: dt.date | None = None,
    metrics: bool = False,
) -> None:
    """``dq`` and ``metrics`` add the report and the join metrics of each batch that was written.

    Lookups beyond the broadcast bound first get the frequent keys of what is to be joined, and their
    rows for all its keys where these can be broadcast: then nothing is shuffled. A run that meets
    rows with other keys, which bronze got meanwhile, takes these by shuffle.

    That is looked for in the bronze files written since the last run began, so old rows cannot
    outweigh a key that is frequent only now. ``since`` leaves out earlier dates. A query kept
    running by an interval keeps the keys it began with, as it keeps its lookups; start it anew to
    look again. The bronze table may be without files yet, and then no key is frequent.
    """
    started = dt.datetime.now(dt.timezone.utc)
    if any(not lookup.broadcast for lookup in lookups.values()):
        last = read_state(spark, store.state("silver"), "started").get("started")
        after = dt.datetime.fromisoformat(last) - CLOCK_MARGIN if last else None
        bronze = table_or_empty(spark, store.table("bronze"), schemas.BRONZE, after)
        if since is not None:
            bronze = bronze.where(F.col("event_date") >= F.lit(since))
        if pace.interval is None and since is None:
            lookups = with_near_keys(lookups, bronze, store.state("silver-near"))
        else:  # not all keys of the rows to come are known
            lookups = with_heavy_keys(lookups, bronze)
    if pace.interval is not None:
        queries = layers.start_silver(spark, store, lookups, pace)
        write_state(spark, store.state("silver"), started=started.isoformat())
        beside = pace.of_tables()
        queries += layers.start_silver_dq(spark, store, beside) if dq else []
        queries += layers.start_join_metrics(spark, store, beside) if metrics else []
        await_all(queries, timeout)
        return
    try:
        await_all(layers.start_silver(spark, store, lookups, pace), timeout)
    except StreamingQueryException as error:
        if NOT_NEAR not in str(error):
            raise
        # Bronze has got more rows meanwhile: the batch that failed, and those after it, go by shuffle.
        lookups = {name: replace(lookup, near=None) for name, lookup in lookups.items()}
        await_all(layers.start_silver(spark, store, lookups, pace), timeout)
    write_state(spark, store.state("silver"), started=started.isoformat())
    reports = layers.start_silver_dq(spark, store, pace) if dq else []
    reports += layers.start_join_metrics(spark, store, pace) if metrics else []
    await_all(reports, timeout)


def run_gold(
    spark: SparkSession, store: Store, pace: Pace = Pace(), timeout: float | None = None,
    wanted: tuple[str, ...] = ("risk", "spend", "usage"),
) -> None:
    start = {"risk": layers.start_risk, "spend": layers.start_spend, "usage": layers.start_usage}
    await_all([q for name in wanted for q in start[name](spark, store, pace)], timeout)


def run_timelines(
    spark: SparkSession, store: Store, pace: Pace = Pace(), timeout: float | None = None,
    rule: VelocityRule = VelocityRule(), delay: str = layers.TIMELINE_DELAY,
    wanted: tuple[str, ...] = ("velocity", "devices"),
) -> None:
    """Velocity and changes of device of the bronze transactions, each written once final, and
    (if wanted) the lifetime value and the sketch of the amounts per user.

    A transaction that comes more than ``delay`` behind the newest event time is on no timeline.
    """
    queries = layers.start_velocity(spark, store, pace, rule, delay) if "velocity" in wanted else []
    queries += layers.start_devices(spark, store, pace, delay) if "devices" in wanted else []
    queries += layers.start_lifetime(spark, store, pace) if "lifetime" in wanted else []
    queries += layers.start_amounts(spark, store, pace) if "amounts" in wanted else []
    await_all(queries, timeout)


def run_dates(
    spark: SparkSession, store: Store, lookups: Mapping[str, Lookup], target: str,
    first: dt.date, last: dt.date,
) -> None:
    """Work on chosen dates again, from bronze: silver and the gold tables of these dates.

    They go to a folder of their own, where a further run replaces the dates it takes; the
    streams' tables and checkpoints stay as they are.
    """
    chosen = F.col("event_date").between(F.lit(first), F.lit(last))
    bronze = read_table(spark, store.table("bronze"), schemas.BRONZE).where(chosen)
    silver = enrich(bronze, with_heavy_keys(lookups, bronze)).select(*schemas.SILVER.names)
    write_table(silver, f"{target}/silver", replace_dates=True)
    silver = read_table(spark, f"{target}/silver", schemas.SILVER).where(chosen)
    for name, df in (
        ("risk", marts.flag_high_risk(silver)), ("spend", marts.user_spend(silver)),
        ("usage", marts.product_usage(silver)),
    ):
        write_table(df, f"{target}/{name}", replace_dates=True)


def check_layers(spark: SparkSession, store: Store) -> tuple[DataFrame, DataFrame]:
    """Whether bronze, silver and the flagged table hold the same rows, and the daily tables what
    silver sums up to, date by date. Layers that lag behind differ until they have caught up."""
    tables = {name: table_or_empty(spark, store.table(name), schema) for name, schema in (
        ("bronze", schemas.BRONZE), ("silver", schemas.SILVER), ("risk", schemas.RISK))}
    return compare_layers(tables), compare_daily(
        tables["silver"], layers.partials(spark, store, "spend"), layers.partials(spark, store, "usage"))


def run_anomalies(
    spark: SparkSession, store: Store, target: str, rule: VelocityRule = VelocityRule(),
    rules: Sequence[anomalies.AnomalyRule] = anomalies.RULES, broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> None:
    """Class each silver row, from the kept sketches of amounts: all rows with their class as
    ``classes``, the shares per date as ``shares``, both in ``target``, which a further run replaces."""
    limits = f"{target}/limits"
    anomalies.amount_limits(layers.read_amounts(spark, store)).write.mode("overwrite").parquet(limits)
    silver = table_or_empty(spark, store.table("silver"), schemas.SILVER)
    found = anomalies.signals(silver, spark.read.parquet(limits), rule, broadcast_limit=broadcast_limit)
    kept = anomalies.classify(found, rules).select(*ANOMALY_COLUMNS)
    path = f"{target}/classes"
    write_table(kept, path, "overwrite")
    anomalies.class_shares(read_table(spark, path, kept.schema)).write.mode("overwrite").parquet(f"{target}/shares")


def run_compact(spark: SparkSession, store: Store, before: dt.date) -> None:
    """Fold the partials of closed dates of both daily tables."""
    for name in layers.DAILY:
        layers.compact(spark, store, name, before)


def _files(spark: SparkSession, path: str, schema, after: dt.datetime | None) -> DataFrame:
    """The dates and paths of the files of a table, or of those written after a time."""
    rows = find_table(spark, path, schema, after)
    if rows is None:
        return spark.createDataFrame([], "event_date date, file string")
    return rows.select("event_date", F.col("_metadata.file_path").alias("file")).distinct()


def _changed_dates(files: DataFrame, seen: DataFrame | None) -> Column | None:
    """A condition on event_date for the dates with files that are not among the seen ones, None
    if none.

    The list has an entry per date at most.
    """
    new = files if seen is None else files.join(seen, "file", "left_anti")
    rows = new.select("event_date").distinct().collect()
    if not rows:
        return None
    days = [r[0] for r in rows if r[0] is not None]
    condition = F.col("event_date").isin(days) if days else F.lit(False)
    return condition | F.col("event_date").isNull() if len(days) < len(rows) else condition


def run_layout(
    spark: SparkSession, store: Store, target: str, rows_per_file: int = ROWS_PER_FILE,
    dates: Column | None = None,
) -> None:
    """Clustered copies of the gold tables, with the daily tables merged to one row per key.

    A table that does not exist yet is left out, and taken whole by the first run that finds it.
    The first run into a target takes all dates, also those that ``dates`` leaves out; a later one
    those that have new files, or those that ``dates`` (a condition on event_date) names, and
    replaces them there. A run by ``dates`` is no substitute for one by new files and leaves the
    record of the last such run as it is. The partials bound the rows of a merged table from above,
    and counting them is cheap.

    As clocks differ, files count as new from ``CLOCK_MARGIN`` before the last run; those of that
    time which it took are listed with its record, before any table is read.
    """
    started = dt.datetime.now(dt.timezone.utc)
    done = read_state(spark, store.state("layout"), "target", "started", "run")
    again = done.get("target") == target
    record = not again or dates is None
    after = dt.datetime.fromisoformat(done["started"]) - CLOCK_MARGIN if again else None
    old = done.get("run") if again else None
    seen = spark.read.schema("file string").parquet(store.laid_out(old)) if old else None
    run = uuid.uuid4().hex
    if record:
        paths = [(store.table("risk"), schemas.RISK)]
        paths += [(store.partials(name), daily.schema) for name, daily in layers.DAILY.items()]
        taken = [_files(spark, path, schema, started - CLOCK_MARGIN).select("file")
                 for path, schema in paths]
        reduce(DataFrame.unionByName, taken).write.parquet(store.laid_out(run))

    def wanted(name: str, path: str, schema) -> tuple[bool, Column | None]:
        if find_table(spark, path, schema) is None:
            return False, None
        if not again or not exists(spark, f"{target}/{name}"):
            return True, None
        found = dates
        if found is None:
            found = _changed_dates(_files(spark, path, schema, after), seen)
        return found is not None, found

    some, which = wanted("risk", store.table("risk"), schemas.RISK)
    if some:
        cluster_table(spark, store.table("risk"), f"{target}/risk", schemas.RISK, "user_id",
                      rows_per_file, which)
    for name, daily in layers.DAILY.items():
        some, which = wanted(name, store.partials(name), daily.schema)
        if some:
            rows = layers.partials(spark, store, name)
            rows = rows if which is None else rows.where(which)
            write_clustered(daily.merge(rows), f"{target}/{name}", daily.key,
                            file_count(rows, rows_per_file), replace_dates=which is not None)
    if record:
        write_state(spark, store.state("layout"), target=target, started=started.isoformat(), run=run)
