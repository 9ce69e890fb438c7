"""One address line from a location object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.functions.text import clean_string, py_strip
from tollgate.functions.variant import get, py_text, truthy, vtype


def build_address(location: Column | None, nodes=None, at: tuple = ()) -> Column:
    """``number name, city postcode, state, country`` with empty parts skipped.

    * street: raw number and name joined by a blank and stripped as one,
      used if either is truthy (number 0 alone is skipped);
    * city and postcode: postcode only when city is non-empty;
    * location missing / not an object -> every part empty.

    ``nodes`` (a contracts.Nodes) supplies already-read values below the
    key path ``at`` instead of reading them from ``location``.
    """
    if nodes is None:
        def v(*k):
            return get(location, *k)

        def t(*k):
            return vtype(v(*k))

        def s(*k):
            return py_text(v(*k))
    else:
        def v(*k):
            return nodes.v(at + k)

        def t(*k):
            return nodes.t(at + k)

        def s(*k):
            return nodes.s(at + k)

    number_t = F.coalesce(s("street", "number"), F.lit(""))
    name_t = F.coalesce(s("street", "name"), F.lit(""))
    either = truthy(v("street", "number"), t("street", "number")) | truthy(v("street", "name"), t("street", "name"))
    street = F.when(either, py_strip(F.concat(number_t, F.lit(" "), name_t)))

    city = clean_string(s("city"), "")
    postcode = clean_string(s("postcode"), "")
    state = clean_string(s("state"), "")
    country = clean_string(s("country"), "")
    city_part = F.when(city != "", F.when(postcode != "", py_strip(F.concat(city, F.lit(" "), postcode))).otherwise(city))
    return F.concat_ws(
        ", ",
        street,
        city_part,
        F.when(state != "", state),
        F.when(country != "", country),
    )
