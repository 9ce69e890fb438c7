"""Take the user out of a response and flatten it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.functions.address import build_address
from tollgate.functions.ids import stable_user_id
from tollgate.functions.text import clean_email, clean_string, normalize_gender
from tollgate.functions.variant import get
from tollgate.operators.contracts import USER_COLUMNS, Nodes


def unwrap_response(parsed: Column) -> Column:
    """``results[0]`` of a parsed response (rest of the array ignored)."""
    return get(parsed, "results", 0)


def flatten_user(user: Column, nodes: Nodes | None = None, normalize_first: bool = False) -> list[Column]:
    """The 11 flat string fields of a raw user (VARIANT), in order.

    Defaults only for null / missing values: names ``Unknown``, gender
    ``other`` (then lower-cased), the rest ``""``.  An empty name stays
    empty (contract 2 rejects it).  The raw record is flattened, or with
    ``normalize_first`` the one that contract 1 normalises (decision R1).
    """
    n = nodes or Nodes(user)
    registered = F.coalesce(n.s(("registered", "date")), F.lit(""))
    email = n.s(("email",))
    gender = F.lower(clean_string(n.s(("gender",)), "other"))
    cols = {
        "id": stable_user_id(email, registered),
        "first_name": clean_string(n.s(("name", "first")), "Unknown"),
        "last_name": clean_string(n.s(("name", "last")), "Unknown"),
        "gender": normalize_gender(gender) if normalize_first else gender,
        "address": build_address(None, n, ("location",)),
        "email": clean_email(email),
        "username": clean_string(n.s(("login", "username")), ""),
        "dob": clean_string(n.s(("dob", "date")), ""),
        "registered_date": clean_string(registered, ""),
        "phone": clean_string(n.s(("phone",)), ""),
        "picture": clean_string(n.s(("picture", "medium")), ""),
    }
    return [cols[name].alias(name) for name in USER_COLUMNS]
