"""JSON values as VARIANT: parse once, read paths, Python-like text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A JSON text whose first non-blank character is "{" is an object.
_OBJECT_TEXT = r"^[ \t\n\r]*\{"
NUMERIC_PREFIXES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_body(text: Column | str) -> Column:
    """Text -> VARIANT; null for text that is not one JSON value (never fails).

    Spark's parser stops after the first value and lets any text follow.  So the text is read as the first element
    of an array whose second is the text's own hash: only if exactly these two come out is the text one
    value, with nothing after it that could have ended the array or added to it.  One parse in all.
    """
    text = _col(text)
    mark = F.xxhash64(text)
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))
    # one comparison of structs, so that both reads are always made and share the parse
    found = F.struct(F.try_variant_get(both, "$[1]", "bigint").alias("m"), F.try_variant_get(both, "$[2]", "variant").isNull().alias("n"))
    whole = found == F.struct(mark.alias("m"), F.lit(True).alias("n"))
    return F.when(whole, F.try_variant_get(both, "$[0]", "variant"))


def computed_once(df: DataFrame, expr: Column, alias: str) -> DataFrame:
    """Add ``expr`` as column ``alias``, evaluated exactly once per row.

    Catalyst pushes a filter below the projection that defines a column by
    copying the column's expression into the filter, and filters do not
    share common sub-expressions: a parse used by five predicates would run
    five times, then once more for the projection.  A value produced by a
    one-element ``inline`` generator is a generator output, which filters
    cannot be pushed beneath, so it is computed once and then referenced.
    """
    return df.select("*", F.inline(F.array(F.struct(expr.alias(alias)))))


def with_parsed(df: DataFrame, text: str, alias: str = "_parsed") -> DataFrame:
    """``df`` plus the JSON text column ``text`` parsed once into VARIANT."""
    return computed_once(df, parse_body(F.col(text)), alias)


def is_json_object_text(text: Column | str, parsed: Column) -> Column:
    """The body parsed and is a JSON object (checked on the text, no walk)."""
    return parsed.isNotNull() & _col(text).rlike(_OBJECT_TEXT)


def key_path(*keys: str | int) -> str:
    out = "$"
    for k in keys:
        if isinstance(k, int):
            out += f"[{k}]"
        else:
            out += "['" + k.replace("'", "\\'") + "']"
    return out


def get(v: Column, *keys: str | int) -> Column:
    """Value at the path as VARIANT; SQL NULL when missing or when the path
    goes through a non-object; variant null for an explicit JSON null."""
    return F.try_variant_get(v, key_path(*keys), "variant")


def vtype(v: Column) -> Column:
    """JSON type name of a VARIANT (STRING, BIGINT, DECIMAL(p,s), DOUBLE,
    BOOLEAN, VOID, OBJECT<...>, ARRAY<...>); null when v is SQL NULL."""
    return F.schema_of_variant(v)


def is_present(v: Column) -> Column:
    """Neither missing nor JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def is_object(v: Column, t: Column | None = None) -> Column:
    t = vtype(v) if t is None else t
    return is_present(v) & t.startswith("OBJECT")


def numeric_type(t: Column) -> Column:
    cond = F.lit(False)
    for p in NUMERIC_PREFIXES:
        cond = cond | t.startswith(p)
    return cond


def is_number(v: Column, t: Column | None = None) -> Column:
    t = vtype(v) if t is None else t
    return is_present(v) & numeric_type(t)


def py_text(v: Column, t: Column | None = None) -> Column:
    """Python ``str()`` of a decoded JSON value; null for missing or JSON null.

    Strings as they are, booleans ``True``/``False``, numbers as text,
    objects and arrays as compact JSON (Python would print its repr).
    ``t`` is the value's type when already computed.
    """
    t = vtype(v) if t is None else t
    as_text = F.try_variant_get(v, "$", "string")
    return F.when(~is_present(v), F.lit(None).cast("string")).when(
        t == "BOOLEAN", F.initcap(as_text)
    ).when(t.startswith("OBJECT") | t.startswith("ARRAY"), F.to_json(v)).otherwise(as_text)


def nested(v: Column, *keys: str, default: str | None = None) -> Column:
    """B4 as text: the value at ``keys``; ``default`` when a step is missing,
    null, or not an object."""
    val = py_text(get(v, *keys))
    return F.coalesce(val, F.lit(default)) if default is not None else val


def truthy(v: Column, t: Column | None = None) -> Column:
    """Python truthiness of a decoded JSON value (missing/null -> false)."""
    t = vtype(v) if t is None else t
    empty = (t == "STRING") & (F.try_variant_get(v, "$", "string") == "")
    container = (t.startswith("ARRAY") | t.startswith("OBJECT")) & F.to_json(v).isin("[]", "{}")
    false_ = (t == "BOOLEAN") & ~F.try_variant_get(v, "$", "boolean")
    zero = numeric_type(t) & (F.try_variant_get(v, "$", "double") == 0)
    falsy = F.coalesce(empty | container | false_ | zero, F.lit(False))
    return is_present(v) & ~falsy


def python_type_name(v: Column) -> Column:
    """Python type name of a decoded JSON value (for pydantic root errors)."""
    t = vtype(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit("NoneType"))
        .when(t == "STRING", F.lit("str"))
        .when(t == "BOOLEAN", F.lit("bool"))
        .when(t.startswith("ARRAY"), F.lit("list"))
        .when(t.startswith("OBJECT"), F.lit("dict"))
        .when(t.startswith("DOUBLE") | t.startswith("FLOAT"), F.lit("float"))
        .when(t.startswith("DECIMAL") & ~t.endswith(",0)"), F.lit("float"))
        .otherwise(F.lit("int"))
    )
