"""Declarative record contracts compiled to one error-array column.

A contract is data: an ordered tuple of ``Field`` rules.  ``contract_errors``
compiles it into a single Spark expression that yields, per row, the list
of failures in declaration order (``Field 'a.b': message``), the way the
reference's models report them: at most one error per field, a type error
stops that field's checks, a missing / null / non-object parent gives one
error on the parent and none on its leaves.

Inputs are VARIANT values (JSON of unknown shape) or plain typed columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions import text as T
from tollgate.functions import variant as V

# The validation messages of the reference's model library.
MSG_REQUIRED = "field required"
MSG_NONE = "none is not an allowed value"
MSG_STR = "str type expected"
MSG_INT = "value is not a valid integer"
MSG_DICT = "value is not a valid dict"
MSG_MIN = "ensure this value has at least {n} characters"
MSG_MAX = "ensure this value has at most {n} characters"
MSG_EXTRA = "extra fields not permitted"
# Envelope messages, checked in this order, first hit only.
ENV_NOT_DICT = "Response is not a dictionary"
ENV_NO_RESULTS = "Missing 'results' key in response"
ENV_EMPTY = "Empty results array"
ENV_NOT_ARRAY = "'results' is not an array"

# Text accepted by Python's int(): optional sign, digits with single
# underscores between them, blanks around.
_WS_CLASS = "[" + "".join(f"\\x{{{c:x}}}" for c in T.PY_WHITESPACE_CODEPOINTS) + "]"
PY_INT_TEXT = rf"^{_WS_CLASS}*[+-]?\p{{Nd}}+(_\p{{Nd}}+)*{_WS_CLASS}*\z"


@dataclass(frozen=True)
class Field:
    """One rule.  ``kind`` is ``str``, ``int`` or ``object``."""

    name: str
    kind: str = "str"
    required: bool = True
    min_length: int | None = None
    max_length: int | None = None
    allowed: tuple[str, ...] | None = None
    allowed_message: str | None = None  # "{v}" is the value
    pattern: str | None = None
    pattern_message: str | None = None  # "{v}" is the value
    pattern_on_lower: bool = False
    none_as_empty: bool = False  # pre-step: null -> "", anything -> text
    children: tuple["Field", ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    forbid_extra: bool = False
    known_keys: tuple[str, ...] = field(default=())

    def keys(self) -> tuple[str, ...]:
        return self.known_keys or tuple(f.name for f in self.fields)


def _fmt(template: str, value: Column) -> Column:
    head, _, tail = template.partition("{v}")
    return F.concat(F.lit(head), value, F.lit(tail)) if _ else F.lit(template)


def _value_checks(f: Field, s: Column) -> list[tuple[Column, Column]]:
    """(failed?, message) for the checks after the type check, in order."""
    out: list[tuple[Column, Column]] = []
    if f.min_length is not None:
        out.append((F.length(s) < f.min_length, F.lit(MSG_MIN.format(n=f.min_length))))
    if f.max_length is not None:
        out.append((F.length(s) > f.max_length, F.lit(MSG_MAX.format(n=f.max_length))))
    if f.allowed is not None:
        out.append((~s.isin(*f.allowed), _fmt(f.allowed_message or "value not allowed: {v}", s)))
    if f.pattern is not None:
        target = F.lower(s) if f.pattern_on_lower else s
        out.append((~target.rlike(f.pattern), _fmt(f.pattern_message or "invalid value: {v}", s)))
    return out


def _chain(steps: list[tuple[Column, Column]]) -> Column | None:
    if not steps:
        return None
    expr = F.when(steps[0][0], steps[0][1])
    for cond, msg in steps[1:]:
        expr = expr.when(cond, msg)
    return expr


def _prefix(path: str, msg: Column) -> Column:
    return F.concat(F.lit(f"Field '{path}': "), msg)


class Nodes:
    """Access to the JSON values of a record by key path.

    ``Nodes(record)`` reads paths on the fly (one expression per use);
    ``with_nodes`` materialises every path of a contract as columns first,
    so each path is read, typed and turned into text once per row and the
    later projections stay small enough for whole-stage code generation.
    """

    def __init__(self, record: Column | None = None):
        self.record = record
        self.cols: dict[tuple, tuple[str, str, str | None]] = {}
        self.extra: Column | None = None

    def v(self, keys: tuple) -> Column:
        if keys in self.cols:
            return F.col(self.cols[keys][0])
        return V.get(self.record, *keys)

    def t(self, keys: tuple) -> Column:
        if keys in self.cols:
            return F.col(self.cols[keys][1])
        return V.vtype(self.v(keys))

    def s(self, keys: tuple) -> Column:
        if keys in self.cols and self.cols[keys][2]:
            return F.col(self.cols[keys][2])
        return V.py_text(self.v(keys), self.t(keys))


def contract_paths(contract: Contract) -> list[tuple[tuple, Field]]:
    """Every (key path, rule) of a contract, depth first, in order."""
    out: list[tuple[tuple, Field]] = []

    def walk(prefix: tuple, fields: tuple[Field, ...]):
        for f in fields:
            out.append((prefix + (f.name,), f))
            walk(prefix + (f.name,), f.children)

    walk((), contract.fields)
    return out


_CACHE: dict = {}


def cached(key: tuple, build: Callable[[], object]):
    """Compiled expressions, reused within one Spark application.

    Building a large expression costs one JVM round trip per operator; the
    result depends only on column names, so it is built once per key.
    """
    full = (SparkSession.active().sparkContext.applicationId, *key)
    if full not in _CACHE:
        _CACHE[full] = build()
    return _CACHE[full]


def _node_projections(record: str, contract: Contract, tag: str):
    nodes = Nodes(F.col(record))
    names = {}
    for i, (keys, f) in enumerate(contract_paths(contract)):
        names[keys] = (f"__{tag}{i}_v", f"__{tag}{i}_t", None if f.kind == "object" else f"__{tag}{i}_s")
    nodes.cols = names
    steps = [
        [V.get(F.col(record), *k).alias(n[0]) for k, n in names.items()],
        [V.vtype(F.col(n[0])).alias(n[1]) for n in names.values()],
        [V.py_text(F.col(n[0]), F.col(n[1])).alias(n[2]) for n in names.values() if n[2]],
    ]
    return steps, nodes


def with_nodes(df: DataFrame, record: str, contract: Contract, tag: str = "n") -> tuple[DataFrame, Nodes]:
    """Add one column per contract path: value, then type and text.

    Three narrow projections; helper columns are named ``__{tag}{i}_v/t/s``.
    """
    steps, nodes = cached(("nodes", record, contract, tag), lambda: _node_projections(record, contract, tag))
    for cols in steps:
        df = df.select("*", *cols)
    return df, nodes


def node_columns(nodes: Nodes) -> list[str]:
    return [c for n in nodes.cols.values() for c in n if c]


def _variant_field_errors(nodes: Nodes, keys: tuple, f: Field) -> list[Column]:
    """Errors of one field (SQL NULL value = missing key)."""
    path = ".".join(keys)
    v, t = nodes.v(keys), nodes.t(keys)
    missing = v.isNull()
    null = F.is_variant_null(v)
    steps: list[tuple[Column, Column]] = []
    if f.required:
        steps.append((missing, F.lit(MSG_REQUIRED)))
    if f.kind == "object":
        steps += [(null, F.lit(MSG_NONE)), (~t.startswith("OBJECT"), F.lit(MSG_DICT))]
        errs = [_prefix(path, _chain(steps))]
        ok = V.is_object(v, t)
        for child in f.children:
            for e in _variant_field_errors(nodes, keys + (child.name,), child):
                errs.append(F.when(ok, e))
        return errs
    s = nodes.s(keys)
    if f.kind == "int":
        numeric = V.numeric_type(t) | (t == "BOOLEAN")
        int_text = (t == "STRING") & s.rlike(PY_INT_TEXT)
        steps += [(null, F.lit(MSG_NONE)), (~(numeric | int_text), F.lit(MSG_INT))]
    elif f.none_as_empty:
        s = F.coalesce(s, F.lit(""))
    else:
        steps += [(null, F.lit(MSG_NONE)), (t.startswith("OBJECT") | t.startswith("ARRAY"), F.lit(MSG_STR))]
    steps += [(c & v.isNotNull(), m) for c, m in _value_checks(f, s)]
    head = _chain(steps)
    return [_prefix(path, head)] if head is not None else []


def _column_field_errors(c: Column, f: Field, path: str) -> list[Column]:
    """Errors of one typed (string) column; null counts as missing, which an optional field may be."""
    steps = [(c.isNull(), F.lit(MSG_REQUIRED))] if f.required else []
    steps += [(failed & c.isNotNull(), m) for failed, m in _value_checks(f, c)]
    head = _chain(steps)
    return [_prefix(path, head)] if head is not None else []


def _compact(errs: list[Column]) -> Column:
    """Array of the non-null messages, in order.

    ``array_except(.., [null])`` instead of ``filter(.., x -> x is not null)``:
    higher-order functions are evaluated without code generation, together
    with every expression below them; ``array_except`` is generated code.
    Messages carry their field path, so its de-duplication never merges two.
    """
    if not errs:
        return F.array().cast("array<string>")
    return F.array_except(F.array(*errs), F.array(F.lit(None).cast("string")))


def contract_errors(record: Column, contract: Contract, nodes: Nodes | None = None) -> Column:
    """C2/C3 on JSON: ``array<string>`` of failures for a VARIANT record.

    A record that is not an object gives the single root error
    ``Field '__root__': <Model> expected dict not <type>``.  With
    ``forbid_extra`` unknown keys add ``Field 'k': extra fields not
    permitted`` after the field errors, keys in sorted order.
    """
    nodes = nodes or Nodes(record)
    errs: list[Column] = []
    for f in contract.fields:
        errs += _variant_field_errors(nodes, (f.name,), f)
    out = _compact(errs)
    if contract.forbid_extra:
        extra = nodes.extra if getattr(nodes, "extra", None) is not None else unknown_keys(record, contract)
        msgs = F.transform(extra, lambda k: F.concat(F.lit("Field '"), k, F.lit(f"': {MSG_EXTRA}")))
        out = F.when(F.size(extra) > 0, F.concat(out, msgs)).otherwise(out)
    root = F.array(F.concat(F.lit(f"Field '__root__': {contract.name} expected dict not "), V.python_type_name(record)))
    return F.when(V.is_object(record), out).otherwise(root)


def unknown_keys(record: Column, contract: Contract) -> Column:
    """Keys of a JSON object that the contract does not know, sorted."""
    keys = F.map_keys(F.try_variant_get(record, "$", "map<string,variant>"))
    return F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in contract.keys()])))


def check_contract(df: DataFrame, record: str, contract: Contract, out: str = "errors", tag: str = "c") -> DataFrame:
    """Add ``out`` = the contract's failures for the VARIANT column ``record``.

    Paths are read once into helper columns (``with_nodes``), unknown keys
    are listed in their own column, then one projection builds the error
    array; the helper columns are dropped again.
    """
    staged, nodes = with_nodes(df, record, contract, tag=tag)
    helpers = node_columns(nodes)
    if contract.forbid_extra:
        extra = cached(("extra", record, contract, tag),
                       lambda: unknown_keys(F.col(record), contract).alias(f"__{tag}_extra"))
        staged = staged.select("*", extra)
        nodes.extra = F.col(f"__{tag}_extra")
        helpers.append(f"__{tag}_extra")
    errs = cached(("errors", record, contract, tag, out), lambda: contract_errors(F.col(record), contract, nodes).alias(out))
    return staged.select("*", errs).drop(*helpers)


def column_contract_errors(cols: dict[str, Column], contract: Contract) -> Column:
    """C3 on typed string columns (the flattened record): same messages."""
    errs: list[Column] = []
    for f in contract.fields:
        errs += _column_field_errors(cols[f.name], f, f.name)
    return _compact(errs)


def envelope_errors(body: Column, parsed: Column) -> Column:
    """First envelope failure, or null when ``results[0]`` exists.

    Falsy ``results`` (null, [], "", 0, false, {}) -> empty; any other
    non-array -> not an array (decision R17).
    """
    results = V.get(parsed, "results")
    first = V.get(parsed, "results", 0)
    return (
        F.when(~V.is_json_object_text(body, parsed), F.lit(ENV_NOT_DICT))
        .when(results.isNull(), F.lit(ENV_NO_RESULTS))
        .when(first.isNotNull(), F.lit(None).cast("string"))
        .when(~V.truthy(results), F.lit(ENV_EMPTY))
        .otherwise(F.lit(ENV_NOT_ARRAY))
    )


def missing_fields(cols: dict[str, Column]) -> Column:
    """C4: names (in the given order) whose value is null or blank text."""
    return _compact([F.when(c.isNull() | (T.py_strip(c.cast("string")) == ""), F.lit(n)) for n, c in cols.items()])


# ---------------------------------------------------------------------------
# The two contracts of the reference, as data.
# ---------------------------------------------------------------------------

API_USER = Contract(
    name="UserAPIResponse",
    fields=(
        Field("gender"),
        Field("name", "object", children=(Field("first"), Field("last"))),
        Field(
            "location",
            "object",
            children=(
                Field("street", "object", children=(Field("number", "int"), Field("name"))),
                Field("city"),
                Field("state"),
                Field("country"),
                Field("postcode", none_as_empty=True),
            ),
        ),
        Field("email", pattern=T.EMAIL_PATTERN, pattern_message="Invalid email format: {v}"),
        Field("login", "object", children=(Field("username"),)),
        Field("dob", "object", children=(Field("date"), Field("age", "int"))),
        Field("registered", "object", children=(Field("date"),)),
        Field("phone"),
        Field("picture", "object", children=(Field("medium"),)),
    ),
)

USER = Contract(
    name="TransformedUser",
    fields=(
        Field("id", min_length=36, max_length=36, pattern=T.UUID_PATTERN,
              pattern_message="Invalid UUID format: {v}", pattern_on_lower=True),
        Field("first_name", min_length=1, max_length=100),
        Field("last_name", min_length=1, max_length=100),
        Field("gender", allowed=T.GENDERS, allowed_message="Invalid gender: {v}. Must be male, female, or other"),
        Field("address", min_length=1, max_length=500),
        Field("email", pattern=T.EMAIL_PATTERN, pattern_message="Invalid email format: {v}"),
        Field("username", min_length=1, max_length=100),
        Field("dob"),
        Field("registered_date"),
        Field("phone", max_length=50),
        Field("picture"),
    ),
    forbid_extra=True,
)

# The names of the user record, in this order.
USER_COLUMNS = tuple(f.name for f in USER.fields)
