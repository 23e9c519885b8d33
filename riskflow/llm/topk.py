"""Exact top-k inner-product search with block-at-a-time pruning.

The rows, in ascending id order, are cut into blocks; a block keeps its rows as a matrix (its
forward index) and the largest and smallest value of each component. A query's bound on a block is
the sum over components of its value times the fitting extreme. Blocks are scored in the order of
their bounds, each for the queries whose bound reaches their k-th score so far. Parts of some blocks
meet chunks of queries in tiles, which are searched independently, from a floor that each query got
from the part with the highest bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import stored, width

BLOCK_ROWS = 256
PART_ROWS = 4096
QUERY_ROWS = 256
TILE_PARTS, TILE_CHUNKS = 16, 128  # at most, in a task at once
EXACT = 1 << 53  # whole numbers below it are exact as doubles
EXACT_SINGLE = 1 << 24  # and as single floats
LOWEST = np.iinfo(np.int64).min + 1  # its negative is a long too
SIZES = {2: np.int16, 4: np.int32, 8: np.int64}
BLOCK = "struct<size:int,width:int,ids:binary,rows:binary,high:binary,low:binary>"
FOUND = "chunk int, query_id long, vec_id long, score long"
TILE = ["rows_tile", "queries_tile"]


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null for a vector that is null or not finite throughout."""
    values = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(values, lambda x: F.floor(x * scale))
    return F.when(vector.isNotNull() & F.coalesce(fine, F.lit(False)), whole)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components; shorter vectors are filled up with zeros."""
    lists = batch.column("vector")
    offsets = lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    width = int(lengths.max()) if len(lengths) else 0
    values = lists.values.to_numpy()
    if width and lengths.min() == width:
        return batch.column("vec_id").to_numpy(), values[offsets[0]:offsets[-1]].reshape(-1, width)
    rows = np.zeros((len(lengths), width), dtype=np.int64)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        rows[i, :b - a] = values[a:b]
    return batch.column("vec_id").to_numpy(), rows


def _packed(x: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that hold them all."""
    least, most = int(x.min(initial=0)), int(x.max(initial=0))
    return x.astype(next(
        t for t in SIZES.values() if np.iinfo(t).min <= least and most <= np.iinfo(t).max)).tobytes()


def _blocks(vectors: DataFrame, ranges: int, size: int, most: int | None = None) -> DataFrame:
    """Parts of at most ``most`` rows (PART_ROWS) in ascending id order: part, and its blocks.

    The ranges cut through an id with very many rows, by its vectors and then by row. The driver
    holds some hundred sampled rows for each range, so a range has as many parts as its rows make.
    """
    most = most or PART_ROWS
    tied = vectors.withColumns({"__key": F.xxhash64("vector"), "__row": F.monotonically_increasing_id()})
    ordered = tied.repartitionByRange(ranges, "vec_id", "__key", "__row").sortWithinPartitions("vec_id") \
        .select("vec_id", "vector")

    def part(number: int, found: list[dict]) -> pa.RecordBatch:
        binary = [(name, pa.binary()) for name in ("ids", "rows", "high", "low")]
        kind = pa.list_(pa.struct([("size", pa.int32()), ("width", pa.int32()), *binary]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([found], kind)], names=["part", "blocks"]
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found, held = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            ids, rows = _matrix(batch)
            at = 0
            while at < len(ids):
                block = rows[at:at + min(size, most - held)]
                found.append({
                    "size": len(block), "width": block.shape[1],
                    "ids": ids[at:at + len(block)].tobytes(), "rows": _packed(block),
                    "high": _packed(block.max(axis=0)), "low": _packed(block.min(axis=0)),
                })
                at, held = at + len(block), held + len(block)
                if held == most:
                    yield part(number, found)
                    number, found, held = number + ranges, [], 0
        if found:
            yield part(number, found)

    return ordered.mapInArrow(cut, f"part int, blocks array<{BLOCK}>")


class _Block:
    def __init__(self, raw: dict, width: int):
        def wide(name: str, rows: int) -> np.ndarray:
            held = SIZES.get(len(raw[name]) // max(1, rows * raw["width"]), np.int64)
            x = np.frombuffer(raw[name], held).reshape(rows, raw["width"])
            return np.pad(x, ((0, 0), (0, width - raw["width"]))) if width > raw["width"] else x

        self.ids = np.frombuffer(raw["ids"], np.int64)
        self.rows, self.high, self.low = wide("rows", raw["size"]), wide("high", 1)[0], wide("low", 1)[0]


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number product a @ b.T, by floats where they are exact."""
    largest = _largest(a) * _largest(b) * max(1, a.shape[1])
    kind = np.float32 if largest < EXACT_SINGLE else np.float64 if largest < EXACT else np.int64
    return a.astype(kind) @ b.astype(kind).T


class _Rows:
    """The blocks of all parts of a tile, their extremes, and which blocks a part has."""

    def __init__(self, parts: list[tuple[int, list[_Block]]]):
        self.parts = [number for number, _ in parts]
        self.starts = np.cumsum([0] + [len(blocks) for _, blocks in parts])[:-1]
        self.blocks = [b for _, blocks in parts for b in blocks]
        self.high, self.low = np.array([b.high for b in self.blocks]), np.array([b.low for b in self.blocks])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Each query's bound on each block."""
        above, below = _product(np.maximum(queries, 0), self.high), _product(np.minimum(queries, 0), self.low)
        return above.astype(np.int64) + below.astype(np.int64)

    def part_bounds(self, queries: np.ndarray) -> np.ndarray:
        """Each query's highest bound on the blocks of each part."""
        return np.maximum.reduceat(self.bounds(queries), self.starts, axis=1)


class _Best:
    """The best k rows so far of each query of a block, best first."""

    def __init__(self, queries: _Block, floors: dict[int, int], k: int):
        self.own, self.queries = queries.ids, queries.rows
        self.floor = np.array([floors.get(q, LOWEST) for q in self.own.tolist()], dtype=np.int64)
        self.scores = np.full((len(self.own), k), LOWEST)
        self.ids = np.full((len(self.own), k), np.iinfo(np.int64).max)

    def search(self, rows: _Rows) -> None:
        """Take in the rows of the blocks that may reach a query's floor and its k-th score."""
        bounds = rows.bounds(self.queries)
        for number in np.argsort(-bounds.max(axis=0), kind="stable").tolist():
            block = rows.blocks[number]
            # A bound equal to the k-th score may hide a tie with a smaller id.
            least = np.maximum(self.scores[:, -1], self.floor)
            who = np.flatnonzero(bounds[:, number] >= least)
            if not len(who):
                continue
            new = _product(self.queries[who], block.rows)
            # As a float, a score beyond what new can hold stays beyond it.
            at, row = np.nonzero(new >= least[who, None].astype(new.dtype))
            other = block.ids[row] != self.own[who[at]]
            at, row = at[other], row[other]
            if len(at):
                self._merge(who[at], block.ids[row], new[at, row].astype(np.int64))

    def _merge(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        k = self.scores.shape[1]
        changed = np.unique(who)
        who = np.concatenate([np.repeat(changed, k), who])
        ids = np.concatenate([self.ids[changed].ravel(), ids])
        scores = np.concatenate([self.scores[changed].ravel(), scores])
        order = np.lexsort((ids, -scores, who))
        first = order[np.searchsorted(who[order], changed)[:, None] + np.arange(k)]
        self.ids[changed], self.scores[changed] = ids[first], scores[first]

    def found(self, chunk: int) -> pa.RecordBatch:
        real = (self.scores > LOWEST) & (self.scores >= self.floor[:, None])
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(real.sum(), chunk, dtype=np.int32)),
            pa.array(np.broadcast_to(self.own[:, None], real.shape)[real]),
            pa.array(self.ids[real]), pa.array(self.scores[real]),
        ], names=["chunk", "query_id", "vec_id", "score"])


def _unpack(parts: pa.Table, chunks: pa.Table) -> tuple[_Rows | None, list]:
    """The parts and the chunks (number, blocks, floors) of a tile; none where one of them is missing."""
    if not parts.num_rows or not chunks.num_rows:
        return None, []
    parts, chunks = parts.to_pylist(), chunks.to_pylist()
    held = [b["width"] for row in parts for b in row["blocks"]]
    held += [b["width"] for row in chunks for b in row["chunk_blocks"]]
    width = max(held)
    return (
        _Rows([(row["part"], [_Block(b, width) for b in row["blocks"]]) for row in parts]),
        [(row["chunk"], [_Block(b, width) for b in row["chunk_blocks"]],
          {f["query_id"]: f["score"] for f in row["floors"] or ()}) for row in chunks],
    )


def _found_in(parts: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """The best k rows of each tile's parts for each query of its chunks."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, chunks = _unpack(left, right)
        out = []
        for number, blocks, floors in chunks:
            for best in (_Best(b, floors, k) for b in blocks):
                best.search(rows)
                out.append(best.found(number))
        kinds = [("chunk", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
        return pa.Table.from_batches(out, pa.schema(kinds))

    return parts.groupBy(*TILE).cogroup(chunks.groupBy(*TILE)).applyInArrow(run, FOUND)


def _first(parts: DataFrame, chunks: DataFrame) -> DataFrame:
    """For each chunk the part with the highest sum of its queries' bounds."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, chunks = _unpack(left, right)
        out = []
        for number, blocks, _ in chunks:
            totals = sum(rows.part_bounds(b.rows).sum(axis=0, dtype=float) for b in blocks)
            out.append((number, *max(zip(totals.tolist(), rows.parts, strict=True))))
        kinds = {"chunk": pa.int32(), "total": pa.float64(), "part": pa.int32()}
        return pa.table([pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds.values())],
                        names=[*kinds])

    tiles = parts.groupBy(*TILE).cogroup(chunks.groupBy(*TILE))
    return tiles.applyInArrow(run, "chunk int, total double, part int") \
        .groupBy("chunk").agg(F.max_by("part", F.struct("total", "part")).alias("part"))


def _alive(parts: DataFrame, chunks: DataFrame) -> DataFrame:
    """The pairs (chunk, part) in which some query's bound reaches its floor; a query without a
    floor reaches any part."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, chunks = _unpack(left, right)
        out = []
        for number, blocks, floors in chunks:
            least = [np.array([floors.get(q, LOWEST) for q in b.ids.tolist()]) for b in blocks]
            reached = [(rows.part_bounds(b.rows) >= low[:, None]).any(axis=0)
                       for b, low in zip(blocks, least, strict=True)]
            out += [(number, part) for part, alive in zip(rows.parts, np.any(reached, axis=0), strict=True) if alive]
        return pa.table([pa.array([row[i] for row in out], pa.int32()) for i in (0, 1)], names=["chunk", "part"])

    return parts.groupBy(*TILE).cogroup(chunks.groupBy(*TILE)).applyInArrow(run, "chunk int, part int")


def top_k(queries: DataFrame, rows: DataFrame, k: int, *, id_col: str = "vec_id",
          vector_col: str = "vector") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k rows with the largest inner products.

    Vectors are arrays of longs whose products sum to a long; null ids or vectors take no part, and
    a shorter vector is filled up with zeros. A query's own id is no candidate; ties go to the
    smaller id. A repeated query counts once, a repeated row each time. Empty tables give no row.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")) \
            .where("vec_id is not null and vector is not null")

    spark = rows.sparkSession
    vectors, asked = clean(rows), clean(queries).dropDuplicates(["vec_id"])
    parts = max(1, -(-vectors.count() // PART_ROWS))
    chunks = max(1, -(-asked.count() // QUERY_ROWS))
    index = stored(_blocks(vectors, min(parts, width(spark)), BLOCK_ROWS), "blocks")
    asking = stored(_blocks(asked, min(chunks, width(spark)), QUERY_ROWS, QUERY_ROWS).select(
        F.col("part").alias("chunk"), F.col("blocks").alias("chunk_blocks")
    ), "queries")
    # Fewer parts in a tile while the tiles are fewer than twice the tasks.
    tile_chunks = min(chunks, TILE_CHUNKS)
    tile_parts = max(1, min(TILE_PARTS, parts * -(-chunks // tile_chunks) // (2 * width(spark))))

    def tile(name: str, size: int) -> Column:
        return F.floor(F.col(name) / size).cast("int")

    def tiles(df: DataFrame, name: str, size: int) -> Column:
        last = df.agg(F.max(tile(name, size))).first()[0]
        return F.explode(F.sequence(F.lit(0), F.lit(last or 0)))

    # The stated queries meet every part's extremes, without its rows.
    extremes = index.select(
        "part", tile("part", tile_parts).alias("rows_tile"),
        tiles(asking, "chunk", tile_chunks).alias("queries_tile"), F.transform("blocks", lambda b: F.struct(
            F.lit(0).alias("size"), b["width"].alias("width"), F.lit(b"").alias("ids"),
            F.lit(b"").alias("rows"), b["high"].alias("high"), b["low"].alias("low"),
        )).alias("blocks"))
    each = asking.select("*", tile("chunk", tile_chunks).alias("queries_tile"),
                         tiles(index, "part", tile_parts).alias("rows_tile"))
    none = F.array().cast("array<struct<query_id:long,score:long>>").alias("floors")

    def searched(pairs: DataFrame, stated: DataFrame, size: int) -> DataFrame:
        """The best rows of the tiles that hold the pairs (chunk, part)."""
        def held(name: str) -> DataFrame:
            return pairs.select(name, tile("part", size).alias("rows_tile"),
                                tile("chunk", tile_chunks).alias("queries_tile")).distinct()

        return _found_in(held("part").join(index, "part"), held("chunk").join(stated, "chunk"), k)

    first = stored(_first(extremes, each.select("*", none)), "first")
    seeds = searched(first, asking.select("*", none), 1)
    floors = (
        seeds.groupBy("chunk", "query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
        .where(F.col("n") >= k)
        .groupBy("chunk").agg(F.collect_list(F.struct("query_id", "score")).alias("floors"))
    )
    floors = stored(floors, "floors")
    # Only pairs that may hold a score as high as a floor meet with their rows.
    alive = stored(_alive(extremes, each.join(floors, "chunk", "left")), "alive")
    found = searched(alive, asking.join(floors, "chunk", "left"), tile_parts)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
