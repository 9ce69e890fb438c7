"""Deterministic user id, UUID version 5 in the URL namespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.functions.text import clean_email, clean_string

# Fixed value: the RFC 4122 URL namespace id, as hex.
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5_url(name: Column) -> Column:
    """UUIDv5(URL namespace, name) as the canonical 36-character text.

    SHA-1 over namespace bytes + UTF-8 name; the version nibble becomes 5
    and the two top bits of the variant nibble become 10.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL_HEX)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def stable_user_id(email_text: Column, registered_text: Column) -> Column:
    """``uuid5(URL, clean_email(email) + ":" + clean registered date)``."""
    return uuid5_url(F.concat(clean_email(email_text), F.lit(":"), clean_string(registered_text, "")))
