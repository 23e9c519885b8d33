"""Lookup tables: loading, checking, and the choice of how to join each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas

# A lookup is broadcast only when its measured size is within this bound.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# As many keys of a feed as there may be frequent ones are near whatever the bound.
NEAR_KEYS = 1000
KEY, LISTED = "_near_key", "_near_listed"


@dataclass(frozen=True)
class LookupSpec:
    """How a lookup joins the feed: ``feed_key = key``, ``take`` maps its columns to silver names."""

    name: str
    schema: T.StructType
    key: str
    feed_key: str
    take: Mapping[str, str]
    flag: str


# The four lookups, in join order.
SPECS = (
    LookupSpec(
        "users", schemas.USERS, "user_id", "user_id",
        {"country": "country", "user_status": "user_status"}, "missing_user",
    ),
    LookupSpec(
        "products", schemas.PRODUCTS, "product_id", "product_id",
        {"product_name": "product_name", "category": "category", "price": "price"},
        "missing_product",
    ),
    LookupSpec(
        "plans", schemas.PLANS, "subscription_type", "subscription_type",
        {"monthly_cost": "monthly_cost", "churn_risk": "churn_risk",
         "plan_duration": "plan_duration"},
        "missing_subscription",
    ),
    LookupSpec(
        "ip_risk", schemas.IP_RISK, "ip_hash", "hash_ip",
        {"risk_level": "risk_level", "risk_score": "risk_score", "location": "ip_risk_location"},
        "missing_ip",
    ),
)
SPEC_BY_NAME = {spec.name: spec for spec in SPECS}


@dataclass(frozen=True)
class Lookup:
    """A checked lookup. ``heavy_keys`` are feed keys so frequent that they get a join of their own.

    ``limit`` is the bound of what is broadcast of it. ``near`` (see ``with_near_keys``) are all keys
    of the feed with what the lookup has for them, few enough to be broadcast.
    """

    spec: LookupSpec
    frame: DataFrame
    broadcast: bool
    heavy_keys: tuple[str, ...] = ()
    row_bytes: float = 0.0
    limit: int = 0
    near: DataFrame | None = None


class BadLookup(ValueError):
    """A lookup is empty or has a key twice."""


def read_lookup(spark: SparkSession, path: str, spec: LookupSpec) -> DataFrame:
    """CSV with a header; the header is compared with the declared columns, nothing is inferred."""
    return (
        spark.read.schema(spec.schema)
        .options(header=True, enforceSchema=False, mode="FAILFAST", escape='"')
        .csv(path)
    )


def lookup_profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per lookup: rows, keys that occur more than once, and an estimate of its bytes.

    The lookups are stacked as (lookup, key, bytes), so that one grouping serves all of them. An
    empty lookup has no row.
    """
    stacked = reduce(DataFrame.union, [
        frame.select(
            F.lit(name).alias("lookup"),
            F.col(SPEC_BY_NAME[name].key).alias("key"),
            _row_bytes(frame.schema).alias("bytes"),
        )
        for name, frame in frames.items()
    ])
    per_key = stacked.groupBy("lookup", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")
    )
    return per_key.groupBy("lookup").agg(
        F.sum("n").alias("row_count"),
        F.count_if((F.col("n") > 1) & F.col("key").isNotNull()).alias("duplicate_keys"),
        F.sum("bytes").alias("bytes"),
    )


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row: 16 per column, and the length of each text."""
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return F.octet_length(F.concat_ws("", *texts)) + F.lit(16 * len(schema.fields))


def check_lookups(
    frames: Mapping[str, DataFrame], broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> dict[str, Lookup]:
    """Reject empty lookups and repeated keys, and measure which may be broadcast.

    One job over all lookups; a few rows come back to the driver.
    """
    checked = {}
    profile = {row["lookup"]: row for row in lookup_profile(frames).collect()}
    for name, frame in frames.items():
        spec, row = SPEC_BY_NAME[name], profile.get(name)
        if row is None:
            raise BadLookup(f"lookup {name} is empty")
        if row["duplicate_keys"]:
            repeated = (
                frame.where(F.col(spec.key).isNotNull()).groupBy(spec.key).count()
                .where("count > 1").orderBy(spec.key).limit(20)
            )
            keys = [r[0] for r in repeated.collect()]
            raise BadLookup(
                f"lookup {spec.name}: {row['duplicate_keys']} keys occur more than once, "
                f"among them {keys}"
            )
        checked[name] = Lookup(
            spec, frame, row["bytes"] <= broadcast_limit, row_bytes=row["bytes"] / row["row_count"],
            limit=broadcast_limit,
        )
    return checked


def load_lookups(
    spark: SparkSession, paths: Mapping[str, str], broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> dict[str, Lookup]:
    frames = {name: read_lookup(spark, path, SPEC_BY_NAME[name]) for name, path in paths.items()}
    return check_lookups(frames, broadcast_limit)


def key_profiles(
    feed: DataFrame, columns: Sequence[str], share: float = 0.001
) -> dict[str, tuple[tuple[str, ...], int]]:
    """Per column, the keys that hold at least ``share`` of the rows (at most ``1 / share`` keys), and
    about how many keys there are.

    Sketches of all columns in one pass, without a shuffle by key. They only decide the route of a
    row through the join, so their estimates cannot change a result.
    """
    most = int(1 / share)
    row = feed.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.struct(
                F.call_function("approx_top_k", F.col(c), F.lit(most), F.lit(10 * most)).alias("top"),
                F.approx_count_distinct(c).alias("keys"),
            ).alias(c)
            for c in columns
        ],
    ).first()
    return {
        c: (tuple(
            top["item"] for top in row[c]["top"] or []
            if top["item"] is not None and top["count"] >= share * row["total"]
        ), row[c]["keys"])
        for c in columns
    }


def frequent_keys(
    feed: DataFrame, columns: Sequence[str], share: float = 0.001
) -> dict[str, tuple[str, ...]]:
    """Per column, the keys that hold at least ``share`` of the rows."""
    return {c: frequent for c, (frequent, _) in key_profiles(feed, columns, share).items()}


def with_heavy_keys(lookups: Mapping[str, Lookup], feed: DataFrame) -> dict[str, Lookup]:
    """Note the frequent feed keys of each lookup that is too large to broadcast."""
    return _with_keys(lookups, feed, None)


def with_near_keys(lookups: Mapping[str, Lookup], feed: DataFrame, path: str) -> dict[str, Lookup]:
    """The same, and what these lookups have for the keys of the feed, where that can be broadcast.

    A feed mostly has few of the keys of a large lookup. Where the lookup rows of all its keys are
    within the lookup's limit (or the keys are no more than frequent ones may be), they are written
    under ``path`` once and read by every micro-batch. Keys that the lookup lacks are among them. A
    join to near keys fails on a key that is not one of them, as the feed must have been this one.
    """
    return _with_keys(lookups, feed, path)


def _with_keys(
    lookups: Mapping[str, Lookup], feed: DataFrame, path: str | None
) -> dict[str, Lookup]:
    large = {name: lookup for name, lookup in lookups.items() if not lookup.broadcast}
    if not large:
        return dict(lookups)
    profiles = key_profiles(feed, [lookup.spec.feed_key for lookup in large.values()])
    found = dict(lookups)
    for name, lookup in large.items():
        frequent, keys = profiles[lookup.spec.feed_key]
        few = keys <= NEAR_KEYS or keys * lookup.row_bytes <= lookup.limit
        found[name] = replace(
            lookup, heavy_keys=frequent,
            near=_near(lookup, feed, f"{path}/{name}") if path and keys and few else None)
    return found


def _near(lookup: Lookup, feed: DataFrame, path: str) -> DataFrame | None:
    """None if there are more keys, or longer ones, than it seemed."""
    spec = lookup.spec
    keys = feed.select(F.col(spec.feed_key).alias(KEY)).where(f"{KEY} is not null").distinct()
    side = lookup.frame.select(
        spec.key, *[F.col(source).alias(name) for source, name in spec.take.items()])
    keys.join(side, F.col(KEY) == F.col(spec.key), "left").select(
        KEY, *spec.take.values(), F.col(spec.key).isNotNull().alias(LISTED)).write.mode("overwrite").parquet(path)
    near = feed.sparkSession.read.parquet(path)
    size = near.agg(F.sum(_row_bytes(near.schema))).first()[0] or 0
    return near if size <= max(lookup.limit, 2 * NEAR_KEYS * lookup.row_bytes) else None
