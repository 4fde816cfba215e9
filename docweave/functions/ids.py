"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(*parts: Column) -> Column:
    """Version-5 UUID of the parts joined by ':', in the URL namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(F.concat_ws(":", *parts), "UTF-8")))
    # The variant digit keeps its low two bits and gets 10 as its high two.
    variant = F.substring(F.lit("89ab" * 4), F.instr(F.lit("0123456789abcdef"), F.substring(digest, 17, 1)), F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def document_id(domain: Column, source_type: Column, location: Column) -> Column:
    return uuid5(domain, source_type, F.lower(location))


def serial(order: Column) -> Column:
    """Order number padded to five digits; longer numbers keep all digits."""
    text = order.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(5)), F.lit("0"))
