"""Size limits of a micro-batch."""

from __future__ import annotations

import re

from pyspark.sql.streaming import DataStreamReader

UNITS = "kmgtp"


def parse_bytes(text: int | str) -> int:
    """A positive number of bytes; a suffix such as ``g`` or ``gb`` counts powers of 1024."""
    found = re.fullmatch(rf"(\d+)\s*([{UNITS}]?)b?", str(text).strip().lower())
    if not found or int(found[1]) == 0:
        raise ValueError(f"not a number of bytes: {text!r} (examples: 1048576, 500g)")
    return int(found[1]) * 1024 ** (UNITS.index(found[2]) + 1 if found[2] else 0)


def limited(
    reader: DataStreamReader, max_files: int | None, max_bytes: int | str | None
) -> DataStreamReader:
    """The reader with one of the two limits, or none; Spark takes no more than one."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("limit a micro-batch by files or by bytes, not by both")
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", parse_bytes(max_bytes))
    return reader
