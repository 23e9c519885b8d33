"""Hashing and masking of personal data as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted formats, and the look of a masked card.
CARD_FORMAT = r"^\d{12,19}$"
CURRENCY_FORMAT = r"^[A-Z]{3}$"
MASK_PREFIX = "**** **** **** "
MASK_INVALID = "****"
LINE_ENDS = "\n\r\u0085\u2028\u2029"
UNANCHORED_CARD = r"\d{12}(\d{4})"


def hash_pii(value: Column, salt: str | None = None) -> Column:
    """SHA-256 hex; null stays null.

    A salt becomes a literal of the plan: set ``spark.sql.redaction.string.regex`` so that it is
    not shown in plan texts and event logs.
    """
    return F.sha2(value if salt is None else F.concat(F.lit(salt), value), 256)


def mask_card(card: Column) -> Column:
    """Keep the last four digits of a well-formed card number, nothing of any other value.

    The format lets a line end follow the number; it is cut off here without a second pattern.
    """
    last_four = F.right(F.rtrim(card, F.lit(LINE_ENDS)), F.lit(4))
    return (
        F.when(card.rlike(CARD_FORMAT), F.concat(F.lit(MASK_PREFIX), last_four))
        .when(card.isNotNull(), F.lit(MASK_INVALID))
    )


def mask_card_unanchored(card: Column) -> Column:
    """Mask each run of 16 digits and leave all else as it is.

    Shorter card numbers pass in clear and longer ones keep extra digits; kept for comparison with
    tables written that way. Use :func:`mask_card` for stored data.
    """
    return F.regexp_replace(card, UNANCHORED_CARD, MASK_PREFIX + "$1")
