"""Bronze to silver: left joins to the lookups, missing-reference flags, usage-cost ratio."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.measures import usage_cost_ratio
from riskflow.sources.lookups import KEY, LISTED, SPECS, Lookup
from riskflow.sources.tables import HASHES, packed, unpacked

SPREAD = "_spread"
# Says that rows came whose keys were not there when the near keys of a lookup were found.
NOT_NEAR = "a key is not among the near ones"


def enrich(
    bronze: DataFrame, lookups: Mapping[str, Lookup], only: Iterable[str] | None = None
) -> DataFrame:
    """Join the lookups in ``only`` (default: all) and add the ratio when the plans are among them.

    Lookup keys are unique (checked on load), so no row is lost or repeated; a query that needs
    the columns of one lookup leaves the other joins out.
    """
    names = {spec.name for spec in SPECS} if only is None else set(only)
    chosen = [lookups[spec.name] for spec in SPECS if spec.name in names]
    far = [lookup for lookup in chosen if is_shuffled(lookup)]
    out = bronze
    if far:  # first, while rows are narrow
        hashes = [name for name in HASHES if name in bronze.columns]
        # Drawn here, before the first shuffle: on rows straight from files a retried task draws
        # the same numbers again. They only say which task joins a row.
        out = packed(bronze.withColumn(SPREAD, (F.rand(seed=17) * 2**53).cast("long")), hashes)
        out = _joined(out, far, hashes)
    out = _joined(out, [lookup for lookup in chosen if not is_shuffled(lookup)])
    out = out.select(*bronze.columns, *[
        name for lookup in chosen for name in (*lookup.spec.take.values(), lookup.spec.flag)])
    if "plans" in names:
        out = out.withColumn(
            "usage_cost_ratio", usage_cost_ratio(F.col("amount"), F.col("monthly_cost"))
        )
    return out


def is_shuffled(lookup: Lookup) -> bool:
    """Whether a join to the lookup moves the rows."""
    return not lookup.broadcast and lookup.near is None


def _joined(df: DataFrame, lookups: Sequence[Lookup], hashes: Sequence[str] = ()) -> DataFrame:
    """The lookups one after the other. ``hashes`` were packed; they come back as they were, one that
    is a key before its join."""
    left = list(hashes)
    for lookup in lookups:
        if lookup.spec.feed_key in left:
            df = unpacked(df, [lookup.spec.feed_key])
            left.remove(lookup.spec.feed_key)
        if lookup.broadcast:
            df = _attach_broadcast(df, lookup)
        else:
            df = _attach_shuffled(df, lookup) if lookup.near is None else _attach_near(df, lookup)
    return unpacked(df, left) if left else df


def _attach_near(df: DataFrame, lookup: Lookup) -> DataFrame:
    """Join to the near keys of a lookup. A key that is not one of them is no miss: it fails the query."""
    spec = lookup.spec
    side = lookup.near.select(KEY, LISTED, *[F.col(name).alias(f"_n_{name}") for name in spec.take.values()])
    joined = df.join(F.broadcast(side), F.col(spec.feed_key) == F.col(KEY), "left")
    return joined.select(
        *df.columns,
        *[F.col(f"_n_{name}").alias(name) for name in spec.take.values()],
        F.when(F.col(spec.feed_key).isNull(), True).when(F.col(LISTED).isNotNull(), ~F.col(LISTED))
        .otherwise(F.raise_error(F.lit(f"{NOT_NEAR}: {spec.name}"))).alias(spec.flag),
    )


def _side(lookup: Lookup, prefix: str) -> DataFrame:
    """The lookup's key and columns under names that cannot clash with the feed's."""
    spec = lookup.spec
    return lookup.frame.select(
        F.col(spec.key).alias(f"{prefix}key"),
        *[F.col(source).alias(f"{prefix}{name}") for source, name in spec.take.items()],
    )


def _attach_broadcast(df: DataFrame, lookup: Lookup) -> DataFrame:
    spec = lookup.spec
    joined = df.join(
        F.broadcast(_side(lookup, "_b_")), F.col(spec.feed_key) == F.col("_b_key"), "left"
    )
    return joined.select(
        *df.columns,
        *[F.col(f"_b_{name}").alias(name) for name in spec.take.values()],
        F.col("_b_key").isNull().alias(spec.flag),
    )


def _attach_shuffled(df: DataFrame, lookup: Lookup) -> DataFrame:
    """Join to a lookup too large to broadcast, with no task holding a whole frequent key.

    Lookup rows of the frequent keys (at most one per key, and a bounded number of keys) are
    broadcast. In the shuffle join those feed rows, and rows without a key, carry a null join key
    and a spread value of their own, so they scatter evenly and match nothing there; all other
    rows meet their lookup row by key. Each row takes whichever side matched.
    """
    spec, heavy = lookup.spec, list(lookup.heavy_keys)
    key = F.col(spec.feed_key)
    by_shuffle = key.isNotNull() & ~key.isin(heavy) if heavy else key.isNotNull()
    keyed = df.withColumns({
        "_key": F.when(by_shuffle, key),
        "_route": F.when(by_shuffle, F.xxhash64(key)).otherwise(F.col(SPREAD)),
    })
    side = _side(lookup, "_s_").withColumn("_s_route", F.xxhash64("_s_key"))
    joined = keyed.join(
        side, (F.col("_key") == F.col("_s_key")) & (F.col("_route") == F.col("_s_route")), "left"
    )
    if not heavy:
        return joined.select(
            *df.columns,
            *[F.col(f"_s_{name}").alias(name) for name in spec.take.values()],
            F.col("_s_key").isNull().alias(spec.flag),
        )
    frequent = _side(lookup, "_h_").where(F.col("_h_key").isin(heavy))
    joined = joined.join(F.broadcast(frequent), key == F.col("_h_key"), "left")
    return joined.select(
        *df.columns,
        *[F.coalesce(f"_h_{name}", f"_s_{name}").alias(name) for name in spec.take.values()],
        F.coalesce("_h_key", "_s_key").isNull().alias(spec.flag),
    )
