"""Checksums of files and rows that need no order and no single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import ref

_WORD = 8  # hex digits per 32-bit word of an MD5


def combined_md5(md5_hex: Column) -> Column:
    """Aggregate of many MD5 hex strings into one, independent of their order.

    Each 32-bit word is summed modulo 2^32, so one input gives itself back and
    equal inputs do not cancel out. No input gives NULL.
    """
    words = [
        F.sum(F.conv(F.substring(md5_hex, 1 + i * _WORD, _WORD), 16, 10).cast("long"))
        for i in range(4)
    ]
    return F.concat(*[F.lower(F.lpad(F.hex(w % F.lit(1 << 32)), _WORD, "0")) for w in words])


def row_md5(columns: Sequence[str]) -> Column:
    """MD5 of a row's CSV text; NULL and the empty string differ in it."""
    text = F.to_csv(
        F.struct(*[ref(c) for c in columns]),
        {
            "escape": '"',
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        },
    )
    return F.md5(text)
