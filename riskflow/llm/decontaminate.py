"""Benchmark decontamination over a distributed positional inverted index, in DataFrame functions.

The index is a table of postings (term, document, position) of all words of all documents, each file
sorted by term. It is written once and answers any benchmark. Every window of ten words of a benchmark
item is a phrase. Terms are 64-bit hashes of words, as a document is told by the one of its text.
A phrase starts from the postings of its rarest term, shifted by that term's place in the phrase;
these candidates are intersected with the shifted postings of the next rarest term, and what is
left with those of all other terms. With a slop, a term may stand up to that many places off.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import ascii_lower, hinted, stored

# All that is no word character: ASCII but for digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
# Rows of two or three numbers; about 64 MB in an executor.
MAX_BROADCAST_ROWS = 1_000_000
# Phrases with a thousandth of all matches, so at most a thousand, are split over so many tasks.
HOT_SHARE = 1 / 1000
SALTS = 32
NO_ID = -(1 << 63)
DOC = ["doc", "text_key"]
PLACE = [*DOC, "position", "term"]


@dataclass(frozen=True)
class Phrases:
    """The benchmark's windows: ``table`` (phrase, words), ``items`` (phrase, item), a row for each
    item that has the phrase, and ``terms`` (word, term)."""

    table: DataFrame
    items: DataFrame
    terms: DataFrame


def phrases_of(items: DataFrame, window: int = WINDOW_WORDS, *, id_col: str = "item_id",
               text_col: str = "text") -> Phrases:
    """Windows of ``window`` consecutive words; an item of fewer words, but not none, is one.

    Equal windows are one phrase. A null text has no words; the words of an item without an id
    count as hit, but such an item is not listed.
    """
    words = F.filter(F.split(ascii_lower(F.col(text_col)), SEPARATORS), lambda w: w != "")
    split = items.select(F.col(id_col).alias("item"), words.alias("words"))
    length = F.least(F.size("words"), F.lit(window))
    windows = split.where(F.size("words") > 0).select(
        "item", length.alias("length"), "words",
        F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("start"),
    ).select("item", F.slice("words", F.col("start"), F.col("length")).alias("words"))
    held = stored(windows.select(F.xxhash64("words").alias("phrase"), "words", "item").distinct(), "windows")
    table = stored(held.select("phrase", "words").distinct(), "phrases")
    if not table.groupBy("phrase").count().where("count > 1").isEmpty():
        raise ValueError("two benchmark phrases share a 64-bit hash")
    terms = stored(
        table.select(F.explode("words").alias("word")).distinct()
        .select("word", F.xxhash64("word").alias("term")), "phrase-terms"
    )
    if not terms.groupBy("term").count().where("count > 1 or term = 0").isEmpty():
        raise ValueError("two benchmark words share a 64-bit hash, or one has that of the empty word")
    return Phrases(table, held.where("item is not null").select("phrase", "item"), terms)


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                only: DataFrame | None = None) -> DataFrame:
    """Postings of all words of all documents: doc, text_key, position, term.

    ``only`` (term) names the terms to keep, for an index that serves one benchmark and then goes.

    A document is its id and the hash of its text, so that repeated ids with other texts stay
    apart. The empty word is a term (0) of every document: its last position is the number of
    pieces that the text splits into, any other is an empty piece at either end.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    pieces = F.concat(F.split(text, SEPARATORS), F.array(F.lit("")))
    # A step of its own, or the hash of the text would be taken anew for each of its words. No row
    # is without a piece; the outer form spares the filter that would split each text a second time.
    split = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                        F.xxhash64(text).alias("text_key"), pieces.alias("pieces"))
    raw = split.select(*DOC, F.posexplode_outer("pieces").alias("position", "piece"))
    term = F.when(F.col("piece") == "", F.lit(0).cast("long")).otherwise(F.xxhash64(ascii_lower(F.col("piece"))))
    postings = raw.select(term.alias("term"), *DOC, "position")
    if only is not None:
        empty = docs.sparkSession.sql("select 0L as term")
        postings = postings.join(hinted(only.select("term").union(empty), MAX_BROADCAST_ROWS), "term", "left_semi")
    return stored(postings.sortWithinPartitions("term"), "postings")


def _steps(phrases: Phrases, index: DataFrame) -> DataFrame:
    """For each phrase whose terms all occur its slots (count, slot, term), rarest first."""
    wanted = hinted(phrases.terms.select("term"), MAX_BROADCAST_ROWS)
    counts = stored(index.join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")),
                    "term-counts")
    slots = (
        phrases.table.select("phrase", F.size("words").alias("length"),
                             F.posexplode("words").alias("slot", "word"))
        .join(hinted(phrases.terms, MAX_BROADCAST_ROWS), "word")
        .join(hinted(counts, MAX_BROADCAST_ROWS), "term")
    )
    return stored(
        slots.groupBy("phrase", "length")
        .agg(F.sort_array(F.collect_list(F.struct("n", "slot", "term"))).alias("order"))
        .where(F.size("order") == F.col("length")), "phrase-steps"
    )


def find_phrases(phrases: Phrases, index: DataFrame, slop: int = 0) -> DataFrame:
    """Where phrases occur: phrase, length, doc, text_key, start. Exact ones with ``slop`` 0.

    With a slop the terms other than the rarest stand within that many places of where they should.
    """
    steps = _steps(phrases, index)
    near = [F.lit(d) for d in range(-slop, slop + 1)]

    def expected(start: Column, slot: Column) -> Column:
        at = start + slot
        return F.explode(F.array(*[at + d for d in near])) if slop else at

    first, second = F.col("order")[0], F.col("order")[1]
    anchors = steps.select("phrase", "length", first["term"].alias("term"),
                           first["slot"].alias("slot"), second["slot"].alias("slot2"),
                           second["term"].alias("term2"))
    found = index.where("term != 0").join(hinted(anchors, MAX_BROADCAST_ROWS), "term").select(
        "phrase", "length", *DOC, (F.col("position") - F.col("slot")).alias("start"),
        "slot2", "term2",
    )
    if not slop:
        found = found.where("start >= 0")
    pairs = found.where("length > 1").select(
        "phrase", "length", *DOC, "start", F.col("term2").alias("term"),
        expected(F.col("start"), F.col("slot2")).alias("position"),
    )
    seconds = hinted(anchors.where("length > 1").select(F.col("term2").alias("term")).distinct(),
                     MAX_BROADCAST_ROWS)
    key = ["phrase", "length", *DOC, "start"]
    kept = stored(
        pairs.join(index.join(seconds, "term", "left_semi").select(*PLACE), PLACE).select(*key)
        .unionByName(found.where("length = 1").select(*key)).distinct(), "phrase-candidates"
    )
    rest = kept.where("length > 2").join(
        hinted(steps.select("phrase", F.slice("order", 3, 1 << 30).alias("order")),
               MAX_BROADCAST_ROWS // 8), "phrase",
    ).select(*key, F.explode("order").alias("step")).select(
        *key, F.col("step.slot").alias("slot"), F.col("step.term").alias("term"),
        expected(F.col("start"), F.col("step.slot")).alias("position"),
    )
    in_candidates = index.where("term != 0").join(
        hinted(kept.select(*DOC).distinct(), MAX_BROADCAST_ROWS), DOC, "left_semi"
    )
    full = (
        rest.join(in_candidates.select(*PLACE), PLACE).groupBy(*key)
        .agg(F.count_distinct("slot").alias("slots")).where("slots = length - 2").select(*key)
    )
    return full.unionByName(kept.where("length <= 2"))


def _with_items(found: DataFrame, items: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Matches with the items that have their phrase, a narrow row each.

    Items beyond a broadcast are joined by phrase; the matches of a frequent one are split over
    ``SALTS`` tasks, each of which gets its items.
    """
    if items.limit(max_rows + 1).count() <= max_rows:
        return found.join(F.broadcast(items), "phrase")
    counts = stored(found.groupBy("phrase").agg(F.count("*").alias("n")), "phrase-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("n") >= total * HOT_SHARE).select("phrase", F.lit(True).alias("hot")))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64(*DOC), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))) \
        .otherwise(F.array(F.lit(0).cast("long")))
    split = found.join(hot, "phrase", "left").withColumn("part", part)
    copies = items.join(hot, "phrase", "left").withColumn("part", F.explode(parts))
    return split.drop("hot").join(copies.drop("hot"), ["phrase", "part"])


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document: doc, text_key, n_words, n_hit, items (sorted texts), contaminated.

    A null text has no words. Repeated rows each have their row. Null ids have doc null. An empty
    benchmark hits nothing; an empty table gives no row; other columns are not read.
    """
    return report(build_index(docs, id_col=id_col, text_col=text_col),
                  phrases_of(items, window, id_col=item_id_col, text_col=item_text_col))


def report(index: DataFrame, phrases: Phrases) -> DataFrame:
    """What ``contamination`` gives, from an index that may have answered other benchmarks before."""
    found = stored(find_phrases(phrases, index), "phrase-matches")
    sizes = index.where("term = 0").groupBy(*DOC).agg(
        F.max("position").alias("pieces"), F.count_distinct("position").alias("blanks"),
        F.count("*").alias("rows"),
    ).select(*DOC, (F.col("pieces") - F.col("blanks") + 1).alias("n_words"),
             (F.col("rows") / F.col("blanks")).cast("long").alias("copies"))
    stop = F.col("start") + F.col("length")
    before = F.max(stop).over(
        Window.partitionBy(*DOC).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    )
    new = F.greatest(F.lit(0), stop - F.greatest("start", F.coalesce(before, F.col("start"))))
    hits = found.select(*DOC, "start", "length").distinct().select(*DOC, new.alias("new")) \
        .groupBy(*DOC).agg(F.sum("new").alias("n_hit"))
    listed = (
        _with_items(found.select(*DOC, "phrase").distinct(), phrases.items).groupBy(*DOC)
        .agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    no_items = F.array().cast("array<string>")
    return (
        sizes.join(hits.join(listed, DOC, "left"), DOC, "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc"), "text_key",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", no_items).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The documents of which no word is hit, with all their columns."""
    phrases = phrases_of(items)
    found = report(build_index(docs, id_col=id_col, text_col=text_col, only=phrases.terms), phrases)
    hit = stored(found.where("contaminated").select(
        F.coalesce("doc", F.lit(NO_ID)).alias("__doc"), F.col("text_key").alias("__key")
    ).distinct(), "contaminated")
    same = (
        (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col("__doc"))
        & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__key"))
    )
    return docs.join(hinted(hit, MAX_BROADCAST_ROWS), same, "left_anti")
