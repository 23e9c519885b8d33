"""Personal data in texts, in DataFrame functions only.

A regular expression per kind proposes spans, a validator confirms them (Luhn for cards, mod-97 for
account numbers, digit counts, octets), and words close by raise or leave the score. Spans of the
base kinds stay whatever their score; those of the further kinds need ``MIN_SCORE``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
MIN_SCORE = 0.5
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
# Spans are worked on in blocks of so many: an aggregate copies its state at every step, so a list of
# all spans in it would take a time that grows with their square.
BLOCK = 128


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _digit_count(low: int, high: int):
    return lambda found: F.char_length(_digits(found)).between(low, high)


def luhn(digits: Column) -> Column:
    """True if a text of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    each = F.transform(F.sequence(F.lit(1), F.char_length(digits)), value)
    return F.aggregate(each, F.lit(0), lambda total, v: total + v) % 10 == 0


def _card(found: Column) -> Column:
    digits = _digits(found)
    return F.when(F.char_length(digits).between(16, 19), luhn(digits)).otherwise(False)


def mod97(found: Column) -> Column:
    """True if an account number has the remainder 1: its first four characters go to the end."""
    plain = F.replace(found, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.char_length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    rest = F.aggregate(F.sequence(F.lit(1), F.char_length(turned)), F.lit(0), step)
    return F.char_length(plain).between(15, 34) & (rest == 1)


# Each part of an address at most 255, whatever zeros lead it.
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``confirm`` checks what was found, ``context`` are the words near by.

    The patterns take the same spans as their plain forms; possessive quantifiers and look-behinds
    only keep long runs of letters or digits from being tried at every place.
    """

    name: str
    pattern: str
    confirm: object
    score: float
    context: str
    base: bool = True
    needs: str | None = None


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda found: F.lit(True), 0.7, "mail|contact|write", needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda found: found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), 0.6, "ip|address|host|server",
         needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){15,}+", _card, 0.7, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _digit_count(8, 15), 0.6,
         "phone|tel|call|mobile|fax", needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
                 r"(?![A-Za-z0-9])", mod97, 0.7, "iban|account|bank", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda found: ~found.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "ssn|social security",
         base=False, needs="-"),
)


def _block_starts(size: Column) -> Column:
    """Where the blocks of a list begin, from 1; the list is not empty."""
    return F.sequence(F.lit(1), size, F.lit(BLOCK))


def _running(blocks: Column, step) -> Column:
    """What stands before each block, and after the last: 0, then ``step`` of that and the block."""
    return F.aggregate(blocks, F.array(F.lit(0)),
                       lambda sofar, block: F.concat(sofar, F.array(step(F.element_at(sofar, -1), block))))


def _spans(kind: Kind, found: Column, gaps: Column) -> Column:
    """Confirmed spans from the matches of a pattern and the texts between them."""
    row = "struct<found:string,start:int,end:int,near:string>"
    # Each block has the gap before each match, and one more.
    blocks = F.transform(_block_starts(F.size(found)), lambda i: F.struct(
        F.slice(found, i, F.lit(BLOCK)).alias("found"), F.slice(gaps, i, F.lit(BLOCK + 1)).alias("gaps")))

    def length(block: Column) -> Column:
        before = F.slice(block["gaps"], F.lit(1), F.size(block["found"]))
        return F.char_length(F.array_join(before, "")) + F.char_length(F.array_join(block["found"], ""))

    starts = _running(blocks, lambda at, block: at + length(block))

    def parts(block: Column) -> Column:
        before = F.slice(block["gaps"], F.lit(1), F.size(block["found"]))
        after = F.slice(block["gaps"], F.lit(2), F.size(block["found"]))
        return F.arrays_zip(
            block["found"].alias("found"),
            F.transform(before, lambda g: F.char_length(g)).alias("gap"),
            F.transform(before, lambda g: F.right(g, F.lit(CONTEXT_CHARS))).alias("left"),
            F.transform(after, lambda g: F.left(g, F.lit(CONTEXT_CHARS))).alias("right"),
        )

    def place(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.char_length(part["found"])
        near = F.concat_ws(" ", part["left"], part["right"])
        return F.struct(end.alias("at"), F.concat(state["rows"], F.array(F.struct(
            part["found"].alias("found"), start.alias("start"), end.alias("end"), near.alias("near")
        ))).alias("rows"))

    def placed_block(block: Column) -> Column:
        return F.aggregate(parts(block), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{row}>").alias("rows")),
                           place, lambda state: state["rows"])

    in_blocks = F.arrays_zip(F.transform(blocks, placed_block).alias("rows"),
                             F.slice(starts, F.lit(1), F.size(blocks)).alias("at"))
    placed = F.flatten(F.transform(in_blocks, lambda block: F.transform(block["rows"], lambda r: F.struct(
        r["found"].alias("found"), (r["start"] + block["at"]).alias("start"),
        (r["end"] + block["at"]).alias("end"), r["near"].alias("near")))))
    confirmed = F.filter(placed, lambda p: kind.confirm(p["found"]))

    def scored(p: Column) -> Column:
        near = F.lower(p["near"]).rlike(rf"\b(?:{kind.context})")
        score = F.lit(kind.score) + F.when(near, CONTEXT_GAIN).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), p["start"].alias("start"),
                        p["end"].alias("end"), score.alias("score"))

    spans = F.transform(confirmed, scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= MIN_SCORE)
    return spans


def with_spans(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``__spans``: (kind, start, end, score) by kind as listed, then start.

    Positions count code points, ends are exclusive. A null or empty text has no spans. Rows and
    all other columns stay as they are; an empty table stays empty. One projection, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    nothing = F.array().cast("array<string>")

    def found(kind: Kind) -> Column:
        matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        return F.when(F.contains(text, F.lit(kind.needs)), matches).otherwise(nothing) \
            if kind.needs else matches

    names = {k: f"__{k.name}" for k in KINDS}
    matched = docs.select("*", *[found(k).alias(names[k]) for k in KINDS])
    # The texts between matches, for rows that have any.
    split = matched.select("*", *[
        F.when(F.size(n) > 0, F.split(text, k.pattern, -1)).alias(f"{n}_gaps")
        for k, n in names.items()
    ])
    spans = F.concat(*[
        F.when(F.size(n) > 0, _spans(k, F.col(n), F.col(f"{n}_gaps")))
        .otherwise(F.array().cast(SPANS)) for k, n in names.items()
    ])
    return split.select(*docs.columns, spans.alias("__spans"))


def masked(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind, as in ``<EMAIL>``.

    Rows without spans are unchanged, a null text too. ``length_col``, if there, takes the new
    number of characters in changed rows.
    """
    text = F.col(text_col)
    ordered = F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    blocks = F.transform(_block_starts(F.size("__ordered")), lambda i: F.slice("__ordered", i, F.lit(BLOCK)))
    # How far the spans before a block reach.
    reached = _running(blocks, lambda at, block: F.greatest(at, F.array_max(F.transform(block, lambda s: s["end"]))))
    # A cut reads a text from its start, so each block cuts out its own stretch of the text first.
    stretches = F.transform(
        F.arrays_zip(blocks.alias("spans"), F.slice(reached, F.lit(1), F.size(blocks)).alias("at")),
        lambda block: F.struct(block["spans"].alias("spans"), block["at"].alias("at"), F.substring(
            text, block["at"] + 1, F.element_at(block["spans"], -1)["start"] - block["at"]).alias("near")))

    def changed(block: Column) -> Column:
        def cut(state: Column, span: Column) -> Column:
            between = F.substring(block["near"], state["at"] - block["at"] + 1, span["start"] - state["at"])
            tag = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
            whole = span["start"] >= state["at"]
            return F.struct(
                F.greatest(state["at"], span["end"]).alias("at"),
                F.when(whole, F.concat(state["out"], between, tag)).otherwise(state["out"]).alias("out"))

        start = F.struct(block["at"].alias("at"), F.lit("").alias("out"))
        return F.aggregate(block["spans"], start, cut, lambda state: state["out"])

    last = F.substring(text, F.element_at(reached, -1) + 1, F.char_length(text))
    cleared = F.concat(F.array_join(F.transform(stretches, changed), ""), last)
    found = with_spans(docs, text_col=text_col).withColumn("__ordered", ordered)
    new = F.when(F.size("__spans") > 0, cleared).otherwise(text)
    out = found.withColumn("__text", new)
    if length_col in docs.columns:
        length = F.char_length("__text").cast(docs.schema[length_col].dataType)
        length = F.when(F.size("__spans") > 0, length).otherwise(F.col(length_col))
        out = out.withColumn(length_col, length)
    return out.withColumn(text_col, F.col("__text")).select(*docs.columns)
