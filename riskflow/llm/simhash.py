"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits share a value within r bits of each. So every
distinct fingerprint emits all its variants within r bits, the variants are shuffled, and
fingerprints that meet at one are linked. Those that meet lie within 2r bits of one another, so a
variant's fingerprints are linked to the least of them; the links are made distinct, verified bit
by bit, and followed to connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import hinted, slices, stored
from riskflow.llm.components import components

SEED = 42
BITS = 64
COUNTED_ROWS = 1 << 15
HEAVY_SHARE = 1000
MAX_BROADCAST_ROWS = 1_000_000


def simhash(text: bytes, shingle: int) -> int:
    """Fingerprint of a text, as a signed long."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    hashes = np.array(
        [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)], dtype="<u8"
    )
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), COUNTED_ROWS):
        part = hashes[at:at + COUNTED_ROWS].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(ones.view("<i8")[0])


def text_mark(text: Column) -> Column:
    """SHA-256 of a text, 32 bytes; no bytes for a null text."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def fingerprints(docs: DataFrame, shingle: int, *, id_col: str = "doc_id",
                 text_col: str = "text", marked: bool = False) -> DataFrame:
    """doc_id and fingerprint (a long) of every row; a null text counts as empty.

    ``marked`` adds the text's mark (``text_mark``), which tells apart rows of one id.
    """
    keys = {"doc_id": F.col(id_col).cast("long")}
    if marked:
        keys["mark"] = text_mark(F.col(text_col))
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            found = pa.array([simhash(t or b"", shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), found], names=[*names, "fingerprint"]
            )

    return docs.select(
        *(key.alias(name) for name, key in keys.items()), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, " + "mark binary, " * marked + "fingerprint long")


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fingerprint) that join all linked ones."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: both sides take half of it")
    flips = [sum(1 << b for b in bits) for r in range(max_bits // 2 + 1)
             for bits in combinations(range(BITS), r)]
    masks = F.array(*[F.lit(m - (1 << BITS) if m >> 63 else m).cast("long") for m in flips])
    met = distinct.select("fingerprint", F.explode(masks).alias("mask")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant")
    )
    least = F.min("fingerprint").over(Window.partitionBy("variant"))
    return (
        met.select("fingerprint", least.alias("u")).where("u != fingerprint")
        .select("u", F.col("fingerprint").alias("v")).distinct()
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    )


def near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (long), component_id.

    The component is the smallest id reachable over links, null if no row of it has an id. Texts
    without words have fingerprint zero, linked like any other. Repeated rows are kept, each with
    its component; an empty table gives no row; other columns are not read.
    """
    prints = stored(fingerprints(docs, shingle, id_col=id_col, text_col=text_col), "fingerprints")
    return _with_least(prints, F.col("doc_id"), max_bits).withColumnRenamed("least", "component_id")


def _with_least(prints: DataFrame, key: Column, max_bits: int) -> DataFrame:
    """``prints``, a stored table, with the least ``key`` of each row's component as ``least``."""
    groups = stored(prints.groupBy("fingerprint").agg(
        F.min(key).alias("least"), F.count("*").alias("rows")
    ), "fingerprint-groups")
    # With only exact copies there is no edge, and each fingerprint is its own root.
    roots = components(links(groups.select("fingerprint"), max_bits))
    rooted = groups.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "least", "rows", F.coalesce("root", "fingerprint").alias("root"))
    rooted = stored(rooted, "fingerprint-roots")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("least"))
    named = stored(rooted.drop("least").join(lowest, "root").select("fingerprint", "rows", "least"),
                   "fingerprint-components")
    # A fingerprint with a thousandth of all rows is joined by broadcast (a thousand rows at most).
    total = named.agg(F.sum("rows")).first()[0] or 0
    heavy = F.col("rows") * HEAVY_SHARE >= total
    few = F.broadcast(named.where(heavy).select("fingerprint", "least"))
    many = named.where(~heavy).select("fingerprint", "least")
    light = prints.join(few, "fingerprint", "left_anti").join(many, "fingerprint")
    return prints.join(few, "fingerprint").unionByName(light)


def one_per_group(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component that of its smallest id.

    Rows are told apart by id and text, so null and repeated ids lose no other component's rows. If
    several texts of a component have its smallest id, or none of its rows has an id, that of the
    least SHA-256 stays; of rows that repeat id and text, one.
    """
    prints = stored(
        fingerprints(docs, shingle, id_col=id_col, text_col=text_col, marked=True), "fingerprints"
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    found = stored(_with_least(prints, order, max_bits), "near-duplicates")
    found = found.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"),
                         order.eqNullSafe(F.col("least")).alias("stays"))
    gone = stored(found.where("not stays").select("__id", "__mark").distinct(), "copies")
    again = stored(
        found.where("stays").groupBy("__id", "__mark").count().where("count > 1")
        .select("__id", "__mark"), "repeated-rows"
    )
    keyed = docs.withColumns({
        "__doc": F.col(id_col).cast("long"), "__text": text_mark(F.col(text_col)),
    })
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__mark"))
    kept = keyed.join(hinted(gone, MAX_BROADCAST_ROWS), same, "left_anti")
    if not again.isEmpty():
        again = hinted(again, MAX_BROADCAST_ROWS)
        kept = kept.join(again, same, "left_anti").unionByName(
            kept.join(again, same, "left_semi").dropDuplicates(["__doc", "__text"])
        )
    return kept.drop("__doc", "__text")
