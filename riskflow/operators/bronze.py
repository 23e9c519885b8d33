"""Raw feed to bronze: hash and mask personal data, add the event date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.privacy import hash_pii, mask_card
from riskflow.schemas import BRONZE


def to_bronze(
    raw: DataFrame, card_salt: str | None = None, mask=mask_card, keep: Sequence[str] = (),
) -> DataFrame:
    """The 17 bronze columns, and those of ``keep``. The raw IP address and card number do not
    pass this step."""
    return raw.withColumns({
        "hash_ip": hash_pii(F.col("ip_address")),
        "hash_card_number": hash_pii(F.col("card_number"), card_salt),
        "card_number": mask(F.col("card_number")),
        "event_date": F.to_date("event_time"),
    }).select(*BRONZE.names, *keep)


def pii_copy(raw: DataFrame) -> DataFrame:
    """Clear-text address and card of each transaction, for a restricted store."""
    return raw.select("transaction_id", "ip_address", "card_number")
