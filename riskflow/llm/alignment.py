"""Alignment of the tokens of two tokenizers over the same bytes of a text.

Both tokenizers cut the bytes of space + text. Where a token of each ends at the same byte is a
shared cut; the tokens between two neighbouring cuts are a group. Cuts are found by dividing: in an
interval of tokens the shared cut nearest to its middle is located by bisecting the other side's
ends, and both halves go the same way; an interval without one is a group. All intervals of a batch
are divided at once, a level at a time.

A token of one side and a token of the other are linked if their bytes overlap. For every pair of
ids the documents that hold it linked are counted over the whole corpus, and each document is then
scored by these counts.

Words repeat, and neither tokenizer joins over the start of white space, so a text is cut there and
the ids of each piece are kept by the worker. Texts with characters on which libraries differ (other
separators, carriage returns) are encoded whole.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import slices, stored

# White space before which a text may be cut, separators on which libraries differ,
# and the mark that stands for a space in pieces.
WHITE = "".join(map(chr, [
    *b" \t\n\x0b\x0c", 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
SEPARATORS = "".join(map(chr, [*b"\r\x1c\x1d\x1e\x1f", 0x85, 0x180E, 0x200B, 0x2060, 0xFEFF]))
SPACE_MARK = chr(0x2581)
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
ODD = re.compile(f"[{SEPARATORS}]")
JOINS = re.compile(f"[^{WHITE}{SPACE_MARK}][{WHITE}{SPACE_MARK}]")
KEPT_PIECES = 500_000
JOINED_CHARS = 1 << 16
BATCH_BYTES = 1 << 20  # of texts
TOKEN_BYTES = 1 << 19  # of one side's ids
# Pairs with their counts that every task may hold: about 100 MB.
MAX_TABLE_PAIRS = 4_000_000
ALIGNED = "row long, doc_id long, a binary, b binary, cut_a binary, cut_b binary"


@dataclass
class Side:
    """One tokenizer: ids of space + text, and the bytes of each id (none for special ones)."""

    encode: Callable[[str], list[int]]
    pieces: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(p) for p in self.pieces], dtype=np.int64)
        self.dtype = np.dtype("<u2" if len(self.pieces) <= 1 << 16 else "<u4")

    def joined(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def of(self, text: str) -> bytes | None:
        """The ids of a text that starts with a space; None if their bytes are not those of it."""
        ids = self.encode(text[1:])
        if self.joined(ids) != text.encode("utf-8", "surrogatepass"):
            return None
        return np.array(ids, dtype=self.dtype).tobytes()


def byte_side(path: str) -> Side:
    """A byte-level vocabulary file. Its ids are ranks of merges, so it is run as a rank table.

    The strings of special tokens are ordinary text.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab, merges = model["vocab"], model["merges"]
    pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
    if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
        raise ValueError(f"{path}: ids do not follow the merges")
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in piece): i for piece, i in vocab.items()}
    ranked = tiktoken.Encoding("byte-side", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    return Side(lambda text: ranked.encode_ordinary(" " + text), pieces)


def _byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable bytes stand for themselves, the others
    for the next code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_side(path: str) -> Side:
    """A sentencepiece model, which puts the space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            pieces.append(bytes([int(name[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            pieces.append(b"")
        else:
            if JOINS.search(name):
                raise ValueError(f"{path}: piece {name!r} goes on over the start of white space")
            pieces.append(name.replace(SPACE_MARK, " ").encode())
    return Side(lambda text: model.encode(text, num_threads=1), pieces)


class TwoSides:
    """Both tokenizers and the ids of the pieces of text met so far."""

    def __init__(self, a_path: str, b_path: str):
        self.sides = byte_side(a_path), piece_side(b_path)
        self.known: dict[str, tuple[bytes | None, bytes | None]] = {}

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of all texts, and where each text's begin (one more entry).

        A text has no ids if it is null or empty, or if a side's ids do not spell its bytes.
        """
        found: list[tuple[bytes | None, bytes | None]] = []
        parts, odd, new = [], {}, set()
        for i, text in enumerate(texts):
            pieces: list[str] = []
            if text:
                if ODD.search(text):
                    odd[i] = tuple(side.of(" " + text) for side in self.sides)
                else:
                    pieces = PIECE.findall(" " + text)
                    new.update(pieces)
            parts.append(pieces)
        new.difference_update(self.known)
        if len(self.known) + len(new) > KEPT_PIECES:
            self.known = {}
            new = {piece for pieces in parts for piece in pieces}
        self._learn(sorted(new))
        known, out = self.known, ([], [])
        for i, pieces in enumerate(parts):
            found = [odd[i]] if i in odd else [known[p] for p in pieces]
            whole = all(x is not None for pair in found for x in pair)
            for s in (0, 1):
                out[s].append(b"".join([pair[s] for pair in found]) if whole else b"")
        coded = []
        for side, rows in zip(self.sides, out, strict=True):
            counts = np.array([len(r) for r in rows], dtype=np.int64) // side.dtype.itemsize
            ids = np.frombuffer(b"".join(rows), side.dtype)
            coded.append((ids, np.concatenate(([0], np.cumsum(counts)))))
        return coded

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces, many in one call, cut where each piece's bytes end.

        Pieces that are white space alone end a text, so each has a call of its own, as have the
        pieces of a call whose bytes do not come back.
        """
        lone = [p for p in pieces if not p.strip(WHITE)]
        blank = set(lone)
        batch, size, calls = [], 0, []
        for piece in pieces:
            if piece in blank:
                continue
            batch.append(piece)
            size += len(piece)
            if size >= JOINED_CHARS:
                calls.append(batch)
                batch, size = [], 0
        if batch:
            calls.append(batch)
        rows: dict[str, list[bytes | None]] = {p: [] for p in pieces}
        for s, side in enumerate(self.sides):
            start = side.of(" a")
            for call in calls:
                coded = _cut(side, start, call)
                for piece, ids in zip(call, coded, strict=True):
                    rows[piece].append(ids)
            for piece in pieces:
                if len(rows[piece]) == s:
                    rows[piece].append(_alone(side, start, piece))
        self.known.update((p, (a, b)) for p, (a, b) in rows.items())




def _alone(side: Side, start: bytes, piece: str) -> bytes | None:
    ids = side.of(" a" + piece)
    return None if ids is None else ids[len(start):]


def _cut(side: Side, start: bytes, pieces: list[str]) -> list[bytes | None]:
    """The ids of each of some pieces that follow one another after the word ``a``."""
    raw = side.of(" a" + "".join(pieces))
    if raw is not None:
        ids = np.frombuffer(raw, side.dtype)
        reached = np.cumsum(side.lengths[ids])
        stops = 2 + np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in pieces])
        at = np.searchsorted(reached, stops)
        if (reached[at] == stops).all():
            marks = [len(start), *((at + 1) * side.dtype.itemsize).tolist()]
            return [raw[i:j] for i, j in zip(marks, marks[1:])]
    return [_alone(side, start, p) for p in pieces]


@functools.lru_cache(maxsize=2)
def two_sides(a_path: str, b_path: str) -> TwoSides:
    return TwoSides(a_path, b_path)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Marks of the A tokens that end where a B token ends.

    Both sides' ends rise through all documents of the batch; document k has the A tokens from
    first[k] up to last[k], and its last end is shared.
    """
    cuts = np.zeros(len(a_ends), dtype=bool)
    some = last > first
    low, high = first[some], last[some]
    cuts[high - 1] = True
    while len(low):
        wide = high - low > 1  # an interval of one token is a group
        low, high = low[wide], high[wide]
        middle = _nearest_to_middle(a_ends, b_ends, low, high - 1)
        divided = middle >= 0
        low, high, middle = low[divided], high[divided], middle[divided]
        cuts[middle] = True
        low, high = np.concatenate([low, middle + 1]), np.concatenate([middle + 1, high])
    return cuts


def _nearest_to_middle(a_ends, b_ends, low, high) -> np.ndarray:
    """Per interval the A token of [low, high) nearest to its middle that ends a shared cut, or -1.

    Distances are tried in runs of doubling length, until all intervals are settled.
    """
    found = np.full(len(low), -1, dtype=np.int64)
    open_ = np.arange(len(low))
    middle = (low + high) // 2
    inner, outer = 0, 1
    while len(open_):
        reach = np.arange(inner, outer)
        steps = np.stack([-reach, reach], axis=1).ravel()
        at = middle[open_, None] + steps
        inside = (at >= low[open_, None]) & (at < high[open_, None])
        shared = np.zeros(at.shape, dtype=bool)
        ends = a_ends[at[inside]]
        shared[inside] = b_ends[np.searchsorted(b_ends, ends)] == ends
        any_ = shared.any(axis=1)
        hit = open_[any_]
        found[hit] = at[any_, shared[any_].argmax(axis=1)]
        left = ~any_ & inside.any(axis=1)
        open_ = open_[left]
        inner, outer = outer, 2 * outer
    return found


@dataclass
class Batch:
    """Some documents' tokens on both sides: ids, first tokens (one more entry) and cut marks."""

    ids: tuple[np.ndarray, np.ndarray]
    first: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    cuts: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def aligned(coded, lengths) -> Batch:
        """From the ids of :meth:`TwoSides.encode` and the bytes of each side's ids."""
        ends = tuple(np.cumsum(n[ids]) for (ids, _), n in zip(coded, lengths, strict=True))
        (a, a_first), (b, b_first) = coded
        cut_a = shared_cuts(*ends, a_first[:-1], a_first[1:])
        cut_b = np.zeros(len(b), dtype=bool)
        cut_b[np.searchsorted(ends[1], ends[0][cut_a])] = True
        return Batch((a, b), (a_first, b_first), ends, (cut_a, cut_b))

    @staticmethod
    def read(batch: pa.RecordBatch, sides) -> Batch:
        """From a batch of the aligned table."""
        ids, first, cuts = [], [], []
        for name, (dtype, _) in zip("ab", sides, strict=True):
            column = batch.column(name)
            raw = b"".join(column.to_pylist())
            ids.append(np.frombuffer(raw, dtype))
            sizes = np.array([len(x) for x in column.to_pylist()], dtype=np.int64) // dtype.itemsize
            first.append(np.concatenate(([0], np.cumsum(sizes))))
            cuts.append(np.frombuffer(b"".join(batch.column(f"cut_{name}").to_pylist()), bool))
        ends = tuple(np.cumsum(n[i]) for i, (_, n) in zip(ids, sides, strict=True))
        return Batch(tuple(ids), tuple(first), ends, tuple(cuts))

    def rows(self, side: int, what: np.ndarray) -> list[bytes]:
        """``what`` of each document's tokens as bytes."""
        raw, marks = what.tobytes(), (self.first[side] * what.dtype.itemsize).tolist()
        return [raw[i:j] for i, j in zip(marks, marks[1:])]

    def per_document(self, side: int) -> np.ndarray:
        return np.diff(self.first[side])

    def groups(self) -> np.ndarray:
        """Number of groups of each document."""
        return np.diff(np.concatenate(([0], np.cumsum(self.cuts[0])))[self.first[0]])

    def links(self, b_ids: int) -> tuple[np.ndarray, np.ndarray]:
        """All overlaps: the document of each, and its pair of ids as one number.

        The bytes between two neighbouring ends of either side are in one token of each side, and
        two tokens that overlap have exactly one such stretch in common.
        """
        ends = np.sort(np.concatenate([self.ends[0], self.ends[1][~self.cuts[1]]]), kind="stable")
        a, b = (np.searchsorted(e, ends) for e in self.ends)
        counts = self.per_document(0) + self.per_document(1) - self.groups()
        pair = self.ids[0][a].astype(np.int64) * b_ids + self.ids[1][b]
        return np.repeat(np.arange(len(counts)), counts), pair

    def texts(self) -> list[bytes]:
        """Each document's groups: ids of A, ``|``, ids of B, groups divided by ``;``."""
        a, b = self.ids
        before_a = np.concatenate(([0], np.cumsum(self.cuts[0])[:-1])) if len(a) else np.zeros(0, int)
        before_b = np.concatenate(([0], np.cumsum(self.cuts[1])[:-1])) if len(b) else np.zeros(0, int)
        in_a, in_b = (np.bincount(x, minlength=int(self.cuts[0].sum())) for x in (before_a, before_b))
        at_a = np.arange(len(a)) + np.concatenate(([0], np.cumsum(in_b)))[before_a]
        at_b = np.arange(len(b)) + np.cumsum(in_a)[before_b]
        code = np.zeros(len(a) + len(b), dtype=np.int64)
        # Three spellings of each id: followed by a comma, the end of a side, the end of a group.
        code[at_a] = a.astype(np.int64) * 3 + np.where(self.cuts[0], 1, 0)
        code[at_b] = b.astype(np.int64) * 3 + np.where(self.cuts[1], 2, 0)
        words = spellings()[code].tolist()
        marks = (self.first[0] + self.first[1]).tolist()
        return [b"".join(words[i:j])[:-1] for i, j in zip(marks, marks[1:])]


@functools.lru_cache(maxsize=1)
def spellings() -> np.ndarray:
    """``id,`` ``id|`` and ``id;`` of the ids below 2^17."""
    return np.array([f"{i}{end}".encode() for i in range(1 << 17) for end in ",|;"], dtype=object)


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The aligned table, a row per document: row (a number of its own), doc_id, ids and cuts.

    ``a`` and ``b`` hold little-endian ids (2 bytes each if the vocabulary fits), ``cut_a`` and
    ``cut_b`` a byte per token, 1 where a group ends. A null or empty text, or one whose ids on
    either side do not spell space + text, has none. A null id is kept; repeated rows are documents
    of their own; an empty table has no row; other columns are not read.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"),
                         F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = two_sides(a_path, b_path)
        lengths = [side.lengths for side in both.sides]
        for batch in slices(batches, "text", BATCH_BYTES):
            found = Batch.aligned(both.encode(batch.column("text").to_pylist()), lengths)
            columns = [found.rows(s, x) for x in (found.ids, found.cuts) for s, x in enumerate(x)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"),
                 *(pa.array(c, pa.binary()) for c in columns)],
                names=["row", "doc_id", "a", "b", "cut_a", "cut_b"])

    return stored(source.mapInArrow(run, ALIGNED), "aligned")


@dataclass(frozen=True)
class Vocabularies:
    """What later passes need of both sides: id types and the bytes of each id."""

    a: tuple[np.dtype, np.ndarray]
    b: tuple[np.dtype, np.ndarray]

    @staticmethod
    def of(a_path: str, b_path: str) -> Vocabularies:
        return Vocabularies(*((s.dtype, s.lengths) for s in two_sides(a_path, b_path).sides))

    @property
    def sides(self):
        return self.a, self.b

    @property
    def b_ids(self) -> int:
        return len(self.b[1])


def pair_counts(aligned: DataFrame, vocab: Vocabularies) -> DataFrame:
    """Documents that hold each pair of ids linked: pair, docs, best (its A id's highest count).

    ``pair`` is the A id times the number of B ids, plus the B id. A task adds up its own documents
    before pairs are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = pd.Series(dtype=np.int64)
        for batch in slices(batches, "a", TOKEN_BYTES):
            doc, pair = Batch.read(batch, vocab.sides).links(vocab.b_ids)
            code, pairs = pd.factorize(pair)
            once = pd.unique(doc * max(1, len(pairs)) + code) % max(1, len(pairs))
            found = pd.Series(np.bincount(once, minlength=len(pairs)), index=pairs)
            total = total.add(found, fill_value=0).astype(np.int64)
            if len(total) > MAX_TABLE_PAIRS:
                yield _counted(total)
                total = total.iloc[:0]
        if len(total):
            yield _counted(total)

    counts = aligned.select("a", "b", "cut_a", "cut_b").mapInArrow(run, "pair long, docs long")
    counts = stored(counts.groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-docs")
    a_id = F.floor(F.col("pair") / F.lit(vocab.b_ids))
    best = counts.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("most"))
    return stored(
        counts.withColumn("a_id", a_id).join(F.broadcast(best), "a_id")  # at most a row per A id
        .select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-counts",
    )


def _counted(total: pd.Series) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "pair": pa.array(total.index.to_numpy(), pa.int64()), "docs": pa.array(total.to_numpy(), pa.int64())})


def scored(aligned: DataFrame, counts: DataFrame, vocab: Vocabularies,
           max_pairs: int = MAX_TABLE_PAIRS) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``groups`` spells the document's groups, ``a1,a2|b1;a3|b2,b3``, empty without tokens. n_best
    counts the links whose pair has the highest count of its A id, count_sum adds up all counts.

    The pairs with the highest counts, at most ``max_pairs``, are sent to all tasks. Should there be
    more, the links of the rarer ones meet their counts by shuffle, where no pair is frequent.
    """
    spark = aligned.sparkSession
    least = _least_sent(counts, max_pairs)
    # Bounded: max_pairs rows of 17 bytes.
    sent = counts.where(F.col("docs") >= least).toPandas().sort_values("pair")
    table = spark.sparkContext.broadcast(tuple(sent[c].to_numpy() for c in ("pair", "docs", "best")))
    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
              "count_sum long, groups string, rest array<struct<pair:long,links:long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = table.value
        for batch in slices(batches, "a", TOKEN_BYTES):
            found = Batch.read(batch, vocab.sides)
            doc, pair = found.links(vocab.b_ids)
            code, pairs = pd.factorize(pair)
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            there = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)
            count = np.where(there, docs[at] if len(keys) else 0, 0)
            top = there & (best[at].astype(bool) if len(keys) else False)
            n, rows = batch.num_rows, found.per_document
            sums = np.bincount(doc, count[code], n) if _small(count, len(doc)) else _exact(doc, count[code], n)
            rest = [None] * n
            if not there.all():
                rest = _rest(doc, pair, ~there[code], n)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), pa.array(rows(0)), pa.array(rows(1)),
                pa.array(found.groups().astype(np.int64)), pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.bincount(doc, top[code], n).astype(np.int64)), pa.array(sums.astype(np.int64)),
                pa.array(found.texts(), pa.binary()).cast(pa.string()),
                pa.array(rest, pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int64())]))),
            ], names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      "groups", "rest"])

    out = aligned.mapInArrow(run, schema)
    if least > 1:
        out = _with_rest(stored(out, "scored"), counts.where(F.col("docs") < least))
    return out.drop("row", "rest")


def _least_sent(counts: DataFrame, max_pairs: int) -> int:
    """The least power of two such that at most ``max_pairs`` pairs have that count or more."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    rows = counts.groupBy(power).agg(F.count("*").alias("n")).collect()  # at most 64
    total, least = 0, 1
    for power, n in sorted(map(tuple, rows), reverse=True):
        total += n
        if total > max_pairs:
            return 1 << (power + 1)
    return least


def _small(count: np.ndarray, links: int) -> bool:
    return int(count.max(initial=0)) * max(1, links) < 1 << 53


def _exact(doc: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, doc, count)
    return out


def _rest(doc: np.ndarray, pair: np.ndarray, open_: np.ndarray, n: int) -> list:
    rest: list[list[dict] | None] = [None] * n
    left = pd.DataFrame({"doc": doc[open_], "pair": pair[open_]}).value_counts()
    for (d, p), links in left.items():
        rest[d] = [*(rest[d] or []), {"pair": p, "links": links}]
    return rest


def _with_rest(out: DataFrame, counts: DataFrame) -> DataFrame:
    """What the pairs that were not sent add to each document."""
    links = out.select("row", F.explode("rest").alias("link")).select("row", "link.*")
    more = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("docs")).alias("more_sum"))
    return out.join(more, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    }).drop("more_best", "more_sum")
