"""Documents dealt to a fixed number of shards of nearly equal bytes, equal texts together.

Groups of equal texts are indivisible. By best fit decreasing they are taken by falling size, and
each enters the shard with the least remaining capacity that still has room, which a balanced tree
of the remaining capacities finds. The capacity is the smallest with which this order needs no more
than the wanted shards; a group larger than its fair share has a shard of its own first.

Groups of one size are interchangeable, so what is packed is the table of sizes and how many groups
have each. Different sizes that add up to B bytes number less than sqrt(2 B): this table stays
small (14 million rows for 100 TB), and one task packs it. Its result is a plan: of the groups of a
size, those of certain ranks go to a shard. Groups and documents are ranked, and joined to the plan,
by Spark over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import hinted, stored, width

MAX_BROADCAST_ROWS = 1_000_000
HEAVY_SHARE = 1000  # a text in a thousandth of the rows is joined by broadcast: a thousand at most
ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition
PLAN = "size long, start long, stop long, shard int"


@dataclass
class Node:
    key: tuple[int, int]
    left: Node | None = None
    right: Node | None = None
    height: int = 1


def _height(node: Node | None) -> int:
    return node.height if node else 0


def _level(node: Node) -> Node:
    """The subtree with its sides' heights at most one apart."""
    def turn(top: Node, up: str, down: str) -> Node:
        rising = getattr(top, up)
        setattr(top, up, getattr(rising, down))
        setattr(rising, down, top)
        for n in (top, rising):
            n.height = 1 + max(_height(n.left), _height(n.right))
        return rising

    node.height = 1 + max(_height(node.left), _height(node.right))
    lean = _height(node.left) - _height(node.right)
    if abs(lean) < 2:
        return node
    up, down = ("left", "right") if lean > 0 else ("right", "left")
    side = getattr(node, up)
    if _height(getattr(side, down)) > _height(getattr(side, up)):
        setattr(node, up, turn(side, down, up))
    return turn(node, up, down)


@dataclass
class Rooms:
    """Remaining capacities in a balanced search tree: keys (room, shard)."""

    root: Node | None = None
    count: int = 0

    def add(self, key: tuple[int, int]) -> None:
        def into(node: Node | None) -> Node:
            if node is None:
                return Node(key)
            if key < node.key:
                node.left = into(node.left)
            else:
                node.right = into(node.right)
            return _level(node)

        self.root = into(self.root)
        self.count += 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least key with room for ``size``."""
        node, best = self.root, None
        while node:
            if node.key >= (size, -1):
                node, best = node.left, node.key
            else:
                node = node.right
        return best

    def remove(self, key: tuple[int, int]) -> None:
        def least(node: Node) -> Node:
            return least(node.left) if node.left else node

        def out_of(node: Node, gone: tuple[int, int]) -> Node | None:
            if gone < node.key:
                node.left = out_of(node.left, gone)
            elif gone > node.key:
                node.right = out_of(node.right, gone)
            elif node.left is None or node.right is None:
                return node.left or node.right
            else:
                node.key = least(node.right).key
                node.right = out_of(node.right, node.key)
            return _level(node)

        self.root = out_of(self.root, key)
        self.count -= 1


@dataclass
class Packing:
    """Bins and the plan rows (size, start, stop, shard) that filled them."""

    shards: int = 0
    plan: list[tuple[int, int, int, int]] = field(default_factory=list)


def best_fit(
    sizes: Sequence[int], counts: Sequence[int], capacity: int, most: int | None = None,
) -> Packing | None:
    """Best fit decreasing over falling sizes, each with its number of groups.

    A new bin is opened where no bin has room; None if that takes more than ``most``. A size over
    the capacity has no packing. A bin takes as many of a size as it has room for.
    """
    rooms, out = Rooms(), Packing()
    if len(sizes) and sizes[0] > capacity:
        return None
    for size, count in zip(sizes, counts, strict=True):
        at = 0
        while at < count:
            found = rooms.tightest(size)
            if found:
                rooms.remove(found)
                room, shard = found
            else:
                if out.shards == most:
                    return None
                room, shard = capacity, out.shards
                out.shards += 1
            took = min(count - at, room // size)
            out.plan.append((size, at, at + took, shard))
            rooms.add((room - took * size, shard))
            at += took
    return out


def nearly_equal(sizes: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """The plan for exactly so many shards with the smallest capacity that best fit can do with.

    Groups of at least the fair share of what is left go first, each alone; then the capacity is
    found by halving the range between the fair share and twice of it, where packing never fails.
    """
    sizes, counts = sizes.tolist(), counts.tolist()
    plan, used, left = [], 0, sum(s * c for s, c in zip(sizes, counts, strict=True))
    starts = [0] * len(sizes)
    first = 0
    while first < len(sizes) and used < shards - 1 and sizes[first] * (shards - used) >= left:
        plan.append((sizes[first], starts[first], starts[first] + 1, used))
        starts[first] += 1
        used, left = used + 1, left - sizes[first]
        first += starts[first] == counts[first]
    sizes, starts = sizes[first:], starts[first:]
    counts = [c - s for c, s in zip(counts[first:], starts, strict=True)]
    if not sizes:
        return plan
    low = max(sizes[0], -(-left // (shards - used)))
    high, best = low, best_fit(sizes, counts, low, shards - used)
    while best is None:
        low, high = high, high + max(1, high // 64)
        best = best_fit(sizes, counts, high, shards - used)
    while high - low > 1:
        middle = (low + high) // 2
        found = best_fit(sizes, counts, middle, shards - used)
        low, high, best = (low, middle, found) if found else (middle, high, best)
    begin = dict(zip(sizes, starts, strict=True))
    plan += [(size, begin[size] + a, begin[size] + b, used + s) for size, a, b, s in best.plan]
    return plan


def numbered(rows: DataFrame, group: str, order: Sequence[str | Column], label: str) -> DataFrame:
    """``rows`` with ``rank``: their place from 0 within their group, by the order (then any).

    Rows are ranged by group and order and written, so a large group lies in many partitions; the
    numbers of rows before each partition's share of a group make places of the partition's own.
    The order has to tell rows of a large group apart.
    """
    spark = rows.sparkSession
    by = [F.asc_nulls_first(group), *order]
    placed = stored(
        rows.repartitionByRange(width(spark), *by).sortWithinPartitions(*by)
        .withColumn("__at", F.monotonically_increasing_id()), label,
    )
    part = F.shiftright("__at", ROW_BITS)
    shares = placed.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(
        Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    shares = stored(shares.select("__group", "__part", "__first", F.coalesce(before, F.lit(0)).alias("__before")),
                    f"{label}-shares")
    same = F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__part"))
    return placed.join(hinted(shares, MAX_BROADCAST_ROWS), same).select(
        *rows.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("rank"))


def packed_sizes(groups: DataFrame, shards: int) -> DataFrame:
    """The plan for groups (size): size, start, stop, shard."""
    sizes = stored(groups.groupBy("size").agg(F.count("*").alias("groups")), "group-sizes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column("size")), np.asarray(b.column("groups"))) for b in batches if b.num_rows]
        if not held:
            return
        size, count = (np.concatenate(x) for x in zip(*held, strict=True))
        falling = np.argsort(-size)
        yield from _plan_rows(nearly_equal(size[falling], count[falling], shards))

    return stored(sizes.coalesce(1).mapInArrow(run, PLAN), "shard-plan")


def _plan_rows(plan: Iterable[tuple[int, int, int, int]]) -> Iterator[pa.RecordBatch]:
    columns = list(zip(*plan, strict=True))
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.int32())],
        names=["size", "start", "stop", "shard"],
    )


def text_key(text: Column) -> Column:
    """Equal for equal texts; two texts that share it are one group, which keeps both whole."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_shards(docs: DataFrame, shards: int = 16, *, text_col: str = "text") -> DataFrame:
    """The shard of every text: text_key, copies, shard. ``docs`` as :func:`with_shards` takes them."""
    rows = docs.select(text_key(F.col(text_col)).alias("text_key"), text_size(F.col(text_col)).alias("size"))
    return _group_shards(rows, shards)


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def _group_shards(rows: DataFrame, shards: int) -> DataFrame:
    """``rows``: text_key and size of each document."""
    groups = stored(rows.groupBy("text_key").agg(
        F.sum("size").alias("size"), F.count("*").alias("copies")), "text-groups")
    plan = packed_sizes(groups, shards)
    ranked = numbered(groups, "size", ["text_key"], "ranked-groups")
    rank = F.col("rank")
    named = plan.select(F.col("size").alias("__size"), "start", "stop", "shard")
    here = (F.col("size") == F.col("__size")) & (rank >= F.col("start")) & (rank < F.col("stop"))
    return stored(ranked.join(hinted(named, MAX_BROADCAST_ROWS), here)
                  .select("text_key", "copies", "shard"), "text-shards")


def with_shards(rows: DataFrame, shards: DataFrame, key: str = "text_key") -> DataFrame:
    """``rows`` with the shard of their key.

    A text in a thousandth of all rows or more has its shard broadcast, so its rows stay where they
    are; the others meet theirs by shuffle.
    """
    total = shards.agg(F.sum("copies")).first()[0] or 0
    often = F.col("copies") * HEAVY_SHARE >= total
    side = shards.select(F.col("text_key").alias("__key"), F.col("shard"), "copies")
    heavy = F.broadcast(side.where(often).drop("copies"))
    same = F.col(key) == F.col("__key")
    return rows.join(heavy, same).drop("__key").unionByName(
        rows.join(heavy, same, "left_anti").join(side.where(~often).drop("copies"), same).drop("__key"))


def sharded(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """A row per document: its id, size, text_crc32, text_key, shard (from 0) and slot.

    A size is the UTF-8 bytes of the text and one more; a null text has none and goes with the
    empty ones. Equal texts are in one shard, whatever their ids. Slots count the documents of a
    shard from 0 by id (null ids first), then by text and row. Repeated rows are documents of their
    own, an empty table gives no row, with fewer groups than shards some stay empty. Other columns
    are not read; :func:`write_shards` takes whole documents.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), text_size(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key(text).alias("text_key"), F.monotonically_increasing_id().alias("row"),
    ), "shard-rows")
    placed = with_shards(rows, _group_shards(rows, shards))
    order = [F.asc_nulls_first("id"), "text_key", "row"]
    found = numbered(placed, "shard", order, "shard-slots")
    return found.select(F.col("id").alias(id_col), "size", "text_crc32", "text_key", "shard",
                        F.col("rank").alias("slot"))


def write_shards(docs: DataFrame, folder: str, shards: int = 16, *, text_col: str = "text") -> None:
    """Write the documents with all their columns as Parquet, a folder ``shard=N`` for each shard."""
    key, row = "__text_key", "__row"
    keyed = docs.withColumns({key: text_key(F.col(text_col)), row: F.monotonically_increasing_id()})
    placed = with_shards(keyed, text_shards(docs, shards, text_col=text_col), key)
    placed.repartitionByRange(width(docs.sparkSession), "shard", row).drop(key, row) \
        .write.partitionBy("shard").parquet(folder)
