"""Canonical JSON text of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def message_json(*cols: Column | str) -> Column:
    """``to_json(struct(cols))`` keeping null fields, as ``json.dumps`` does."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
