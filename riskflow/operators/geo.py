"""Places of IPv4 addresses from a table of ranges of any length, which may overlap.

The narrowest range that holds an address decides; among equally long ones the one that starts
first, then the least place. The ranges are made disjoint once, bucket by bucket of the address
space, so that an address is in at most one segment and the join is by bucket, with the ends of the
segment as a condition: no row is compared with all ranges, and none is repeated. This works row by
row in batches and in streams, on the clear address, before it is hashed.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.session import ship_package
from riskflow.sources.lookups import BROADCAST_LIMIT_BYTES, BadLookup, frequent_keys

# Addresses of a bucket share so many leading bits.
BUCKET_BITS = 16
BUCKET = 1 << (32 - BUCKET_BITS)
# Rows of a frequent bucket are dealt to so many tasks, each with a copy of its segments.
SALTS = 32
RANGES = "network string, geo_country string, geo_region string"
PLACE = ("geo_country", "geo_region")
SEGMENTS = "bucket long, first long, last long, geo_country string, geo_region string"
SEGMENT_BYTES = 16 * 5


@dataclass(frozen=True)
class Places:
    """Disjoint segments, and how to join them; ``heavy`` are frequent buckets of the feed."""

    segments: DataFrame
    broadcast: bool
    heavy: tuple[int, ...] = ()


def address_number(ip: Column) -> Column:
    """Four decimal parts of at most 255 as one number; null for any other text."""
    parts = F.split(ip, r"\.")
    values = [F.get(parts, F.lit(i)).try_cast("int") for i in range(4)]
    whole = sum((v.cast("long") * (1 << (8 * (3 - i))) for i, v in enumerate(values)), F.lit(0).cast("long"))
    fine = ip.rlike(r"\A\d{1,3}(\.\d{1,3}){3}\z")
    for value in values:
        fine = fine & (value <= 255)
    return F.when(fine, whole)


def network_ends(network: Column) -> tuple[Column, Column]:
    """First and last address of ``a.b.c.d/bits`` or ``a.b.c.d-e.f.g.h``; nulls for other texts.

    Bits of the address beyond the mask are ignored.
    """
    bits = F.regexp_extract(network, r"\A[^/]+/(\d{1,2})\z", 1).try_cast("int")
    host = F.when(bits <= 32, F.pow(F.lit(2.0), F.lit(32) - bits).cast("long"))
    base = address_number(F.substring_index(network, "/", 1))
    low = F.floor(base / host).cast("long") * host
    dash = network.contains("-")
    first = F.when(dash, address_number(F.trim(F.substring_index(network, "-", 1)))).otherwise(low)
    last = F.when(dash, address_number(F.trim(F.substring_index(network, "-", -1)))).otherwise(low + host - 1)
    return first, last


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the header network,geo_country,geo_region."""
    return spark.read.schema(RANGES).options(
        header=True, enforceSchema=False, mode="FAILFAST", escape='"').csv(path)


def segments_of(ranges: DataFrame) -> DataFrame:
    """Disjoint segments (bucket, first, last, place) of ranges (network, place).

    Each range is cut at the borders of buckets; a bucket's pieces are swept once by rising address,
    with the ranges that hold the current address in a heap, narrowest first. A malformed range is
    an error.
    """
    first, last = network_ends(F.col("network"))
    ends = ranges.select("network", first.alias("first"), last.alias("last"), F.struct(*PLACE).alias("place"))
    wrong = ends.where("first is null or last is null or first > last")
    examples = [r[0] for r in wrong.select("network").limit(5).collect()]
    if examples:
        raise BadLookup(f"not a range of addresses: {examples}")
    distinct = ends.groupBy("first", "last").agg(F.min("place").alias("place"))
    pieces = distinct.select(
        F.explode(F.sequence(F.floor(F.col("first") / BUCKET), F.floor(F.col("last") / BUCKET))).alias("bucket"),
        "first", "last", "place.*",
    )
    ship_package(ranges.sparkSession)
    pieces = pieces.withColumn("n", F.count("*").over(Window.partitionBy("bucket")))
    # Most buckets lie within one wide range: its piece is the segment.
    low = F.col("bucket") * BUCKET
    alone = pieces.where("n = 1").select(
        "bucket", F.greatest("first", low).alias("first"), F.least("last", low + (BUCKET - 1)).alias("last"), *PLACE)
    return alone.unionByName(pieces.where("n > 1").drop("n").groupBy("bucket").applyInPandas(_swept, SEGMENTS))


def _swept(pieces: pd.DataFrame) -> pd.DataFrame:
    """The segments of one bucket, of which there are at most as many as it has addresses."""
    bucket = int(pieces["bucket"].iloc[0])
    low, high = bucket * BUCKET, (bucket + 1) * BUCKET  # high is beyond it
    rows = sorted(pieces[["first", "last", *PLACE]].itertuples(index=False, name=None), key=lambda r: r[:2])
    stops = sorted({min(last + 1, high) for _, last, *_ in rows})
    points = sorted({max(first, low) for first, *_ in rows} | set(stops))
    open_: list[tuple[int, int, int]] = []  # length, first, number
    out, at = [], 0
    for point, following in zip(points, points[1:]):
        while at < len(rows) and max(rows[at][0], low) <= point:
            heapq.heappush(open_, (rows[at][1] - rows[at][0], rows[at][0], at))
            at += 1
        while open_ and rows[open_[0][2]][1] < point:
            heapq.heappop(open_)
        if not open_:
            continue
        number = open_[0][2]
        if out and out[-1][0] == number and out[-1][2] == point - 1:
            out[-1][2] = following - 1
        else:
            out.append([number, point, following - 1])
    return pd.DataFrame(
        [(bucket, first, last, *rows[number][2:]) for number, first, last in out],
        columns=[c.split()[0] for c in SEGMENTS.split(", ")])


def load_places(
    ranges: DataFrame, folder: str, broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    feed: DataFrame | None = None,
) -> Places:
    """Write the segments of ``ranges`` to a new folder and measure whether they may be broadcast.

    Segments beyond the limit are joined by shuffle; the frequent buckets of ``feed`` (with its
    ip_address) are then found by a sketch, at most a thousand.
    """
    segments_of(ranges).write.parquet(folder)
    segments = ranges.sparkSession.read.schema(SEGMENTS).parquet(folder)
    texts = F.octet_length(F.concat_ws("", *PLACE)) + F.lit(SEGMENT_BYTES)
    size = segments.agg(F.sum(texts)).first()[0]
    if not size:
        raise BadLookup("no ranges of addresses")
    if size <= broadcast_limit or feed is None:
        return Places(segments, size <= broadcast_limit)
    buckets = feed.select(_bucket(address_number(F.col("ip_address"))).cast("string").alias("bucket"))
    return Places(segments, False, tuple(int(b) for b in frequent_keys(buckets, ["bucket"])["bucket"]))


def _bucket(number: Column) -> Column:
    return F.floor(number / BUCKET).cast("long")


def with_places(raw: DataFrame, places: Places) -> DataFrame:
    """``raw`` (with ip_address) and geo_country, geo_region and missing_geo.

    Nulls for an address that is null, malformed, of another kind, or in no range: missing_geo is
    true. Rows of frequent buckets, and rows without a number, are spread over the tasks.
    """
    side = places.segments.select(*[F.col(name).alias(f"_g_{name}") for name in places.segments.columns])
    number = address_number(F.col("ip_address"))
    rows = raw.withColumn("_number", number).withColumn("_bucket", _bucket(F.col("_number")))
    inside = F.col("_number").between(F.col("_g_first"), F.col("_g_last"))
    if places.broadcast:
        joined = rows.join(F.broadcast(side), (F.col("_bucket") == F.col("_g_bucket")) & inside, "left")
    else:
        heavy = list(places.heavy)
        # Drawn on rows straight from files, so a retried task draws the same numbers again.
        draw = F.rand(seed=23)
        often = F.col("_bucket").isin(heavy) if heavy else F.lit(False)
        rows = rows.withColumn("_draw", draw).withColumns({
            "_salt": F.when(often, F.floor(F.col("_draw") * SALTS)).otherwise(F.lit(0)).cast("int"),
            # Negative buckets hold nothing; they only scatter the rows without a number.
            "_bucket": F.coalesce("_bucket", -F.ceil(F.col("_draw") * (1 << 40)) - 1),
        })
        copies = F.when(F.col("_g_bucket").isin(heavy), F.sequence(F.lit(0), F.lit(SALTS - 1))) \
            .otherwise(F.array(F.lit(0))) if heavy else F.array(F.lit(0))
        side = side.withColumn("_g_salt", F.explode(copies))
        same = (F.col("_bucket") == F.col("_g_bucket")) & (F.col("_salt") == F.col("_g_salt"))
        joined = rows.join(side, same & inside, "left")
    return joined.select(
        *raw.columns, *[F.col(f"_g_{name}").alias(name) for name in PLACE],
        F.col("_g_bucket").isNull().alias("missing_geo"),
    )
