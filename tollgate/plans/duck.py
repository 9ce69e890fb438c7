"""DuckDB-dialect mirror of the column builders, for the oracle SQL.

The oracle is an independent evaluation of the same semantics on another
engine: JSON through DuckDB's ``json_*`` functions, regexes through RE2.
Rules, messages, patterns and lists are written out here once more and not
taken from the code under test, so that the two can disagree.  Only
expression text is produced here; nothing runs.
"""

from __future__ import annotations

from typing import NamedTuple

# What Python's strip() removes, the e-mail and id shapes, the genders,
# the namespace of URL ids.
SPACES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\n?\z"
GENDERS = ("male", "female", "other")
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"

WS = "(" + " || ".join(f"chr({c})" for c in SPACES) + ")"
SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in SPACES) + "]"


class Rule(NamedTuple):
    """A field: its dotted path, what it must be, and (failed?, message) checks on the text @v."""

    path: str
    kind: str  # text, int, object, or any: turned into text, null into ''
    checks: tuple[tuple[str, str], ...] = ()


def _length(least: int | None, most: int) -> tuple[tuple[str, str], ...]:
    low = ((f"length(@v) < {least}", f"'ensure this value has at least {least} characters'"),) if least else ()
    return (*low, (f"length(@v) > {most}", f"'ensure this value has at most {most} characters'"))


_EMAIL = ((f"NOT regexp_matches(@v, '{EMAIL}')", "'Invalid email format: ' || @v"),)
_UUID = ((f"NOT regexp_matches(lower(@v), '{UUID}')", "'Invalid UUID format: ' || @v"),)
_GENDER = (("@v NOT IN ('male', 'female', 'other')", "'Invalid gender: ' || @v || '. Must be male, female, or other'"),)

# Contract 1: the user inside an API response.
API_NAME = "UserAPIResponse"
API_RULES = (
    Rule("gender", "text"),
    Rule("name", "object"),
    Rule("name.first", "text"),
    Rule("name.last", "text"),
    Rule("location", "object"),
    Rule("location.street", "object"),
    Rule("location.street.number", "int"),
    Rule("location.street.name", "text"),
    Rule("location.city", "text"),
    Rule("location.state", "text"),
    Rule("location.country", "text"),
    Rule("location.postcode", "any"),
    Rule("email", "text", _EMAIL),
    Rule("login", "object"),
    Rule("login.username", "text"),
    Rule("dob", "object"),
    Rule("dob.date", "text"),
    Rule("dob.age", "int"),
    Rule("registered", "object"),
    Rule("registered.date", "text"),
    Rule("phone", "text"),
    Rule("picture", "object"),
    Rule("picture.medium", "text"),
)
# Contract 2: the flat user; other keys are errors.
USER_NAME = "TransformedUser"
USER_RULES = (
    Rule("id", "text", _length(36, 36) + _UUID),
    Rule("first_name", "text", _length(1, 100)),
    Rule("last_name", "text", _length(1, 100)),
    Rule("gender", "text", _GENDER),
    Rule("address", "text", _length(1, 500)),
    Rule("email", "text", _EMAIL),
    Rule("username", "text", _length(1, 100)),
    Rule("dob", "text"),
    Rule("registered_date", "text"),
    Rule("phone", "text", _length(None, 50)),
    Rule("picture", "text"),
)
USER_COLUMNS = tuple(r.path for r in USER_RULES)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def path(*keys) -> str:
    out = "$"
    for k in keys:
        out += f"[{k}]" if isinstance(k, int) else '."' + k + '"'
    return q(out)


def get(v: str, *keys) -> str:
    return f"json_extract({v}, {path(*keys)})"


def jtype(v: str) -> str:
    return f"json_type({v})"


def present(v: str) -> str:
    return f"({v} IS NOT NULL AND json_type({v}) <> 'NULL')"


def py_text(v: str) -> str:
    t = jtype(v)
    return (
        f"(CASE WHEN {v} IS NULL OR {t} = 'NULL' THEN NULL "
        f"WHEN {t} = 'BOOLEAN' THEN (CASE WHEN CAST({v} AS VARCHAR) = 'true' THEN 'True' ELSE 'False' END) "
        f"WHEN {t} IN ('OBJECT', 'ARRAY') THEN CAST({v} AS VARCHAR) "
        f"ELSE json_extract_string({v}, '$') END)"
    )


def truthy(v: str) -> str:
    t = jtype(v)
    falsy = (
        f"(({t} = 'VARCHAR' AND json_extract_string({v}, '$') = '') "
        f"OR ({t} IN ('ARRAY', 'OBJECT') AND CAST({v} AS VARCHAR) IN ('[]', '{{}}')) "
        f"OR ({t} = 'BOOLEAN' AND CAST({v} AS VARCHAR) = 'false') "
        f"OR ({t} IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST(CAST({v} AS VARCHAR) AS DOUBLE) = 0))"
    )
    return f"({present(v)} AND NOT coalesce({falsy}, false))"


def strip(s: str) -> str:
    return f"trim({s}, {WS})"


def clean_string(s: str, default: str | None = "", max_length: int | None = None) -> str:
    out = strip(s)
    if max_length:
        out = f"substr({out}, 1, {int(max_length)})"
    return f"coalesce({out}, {q(default)})" if default is not None else out


def clean_email(s: str) -> str:
    return f"coalesce(lower({strip(s)}), '')"


def rx(s: str, pattern: str) -> str:
    return f"regexp_matches({s}, {q(pattern)})"


def is_email(s: str) -> str:
    return rx(s, EMAIL)


def is_uuid(s: str) -> str:
    return f"(length({s}) = 36 AND {rx(f'lower({s})', UUID)})"


def normalize_gender(s: str) -> str:
    allowed = ", ".join(q(g) for g in GENDERS)
    return f"(CASE WHEN lower({s}) IN ({allowed}) THEN lower({s}) WHEN {s} IS NOT NULL THEN 'other' END)"


def uuid5_url(name: str) -> str:
    h = f"sha1(unhex('{URL_NAMESPACE}') || encode({name}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || '5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def python_type_name(v: str) -> str:
    t = jtype(v)
    return (
        f"(CASE WHEN {v} IS NULL OR {t} = 'NULL' THEN 'NoneType' WHEN {t} = 'VARCHAR' THEN 'str' "
        f"WHEN {t} = 'BOOLEAN' THEN 'bool' WHEN {t} = 'ARRAY' THEN 'list' WHEN {t} = 'OBJECT' THEN 'dict' "
        f"WHEN {t} = 'DOUBLE' THEN 'float' ELSE 'int' END)"
    )


def _chain(steps: list[tuple[str, str]]) -> str:
    return "(CASE " + " ".join(f"WHEN {c} THEN {m}" for c, m in steps) + " END)"


def _checks(r: Rule, s: str) -> list[tuple[str, str]]:
    return [(cond.replace("@v", s), f"({message.replace('@v', s)})") for cond, message in r.checks]


def _pref(p: str, msg: str) -> str:
    return f"({q('Field ' + chr(39) + p + chr(39) + ': ')} || {msg})"


def _field_error(rec: str, r: Rule) -> str:
    keys = r.path.split(".")
    v = get(rec, *keys)
    t = jtype(v)
    s = py_text(v)
    steps = [(f"{v} IS NULL", "'field required'")]
    none = (f"{t} = 'NULL'", "'none is not an allowed value'")
    if r.kind == "object":
        steps += [none, (f"{t} <> 'OBJECT'", "'value is not a valid dict'")]
    elif r.kind == "int":
        text = rf"^{SPACE}*[+-]?\p{{Nd}}+(_\p{{Nd}}+)*{SPACE}*\z"
        ok = f"({t} IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN') OR ({t} = 'VARCHAR' AND {rx(s, text)}))"
        steps += [none, (f"NOT {ok}", "'value is not a valid integer'")]
    elif r.kind == "text":
        steps += [none, (f"{t} IN ('OBJECT', 'ARRAY')", "'str type expected'")]
    else:
        s = f"coalesce({s}, '')"
    steps += [(f"({c}) AND {v} IS NOT NULL", m) for c, m in _checks(r, s)]
    error = _pref(r.path, _chain(steps))
    if len(keys) == 1:
        return error
    parent = get(rec, *keys[:-1])  # one error on a parent, none on its leaves
    return f"(CASE WHEN {present(parent)} AND {jtype(parent)} = 'OBJECT' THEN {error} END)"


def compact(errs: list[str]) -> str:
    return "list_filter([" + ", ".join(errs) + "], lambda x: x IS NOT NULL)"


def contract_errors(rec: str, name: str, rules: tuple[Rule, ...], forbid_extra: bool) -> str:
    out = compact([_field_error(rec, r) for r in rules])
    if forbid_extra:
        known = "[" + ", ".join(q(r.path) for r in rules) + "]"
        extra = f"list_sort(list_filter(json_keys({rec}), lambda k: NOT list_contains({known}, k)))"
        out = f"list_concat({out}, list_transform({extra}, lambda k: 'Field ''' || k || ''': extra fields not permitted'))"
    root = f"['Field ''__root__'': {name} expected dict not ' || {python_type_name(rec)}]"
    return f"(CASE WHEN {present(rec)} AND {jtype(rec)} = 'OBJECT' THEN {out} ELSE {root} END)"


def api_errors(rec: str) -> str:
    return contract_errors(rec, API_NAME, API_RULES, False)


def user_errors(rec: str) -> str:
    return contract_errors(rec, USER_NAME, USER_RULES, True)


def column_user_errors() -> str:
    """Contract 2 on the columns of the flat user."""
    return compact([_pref(r.path, _chain([(f"{r.path} IS NULL", "'field required'"), *_checks(r, r.path)])) for r in USER_RULES])


def envelope_errors(body: str, pj: str) -> str:
    r = get(pj, "results")
    first = get(pj, "results", 0)
    return (
        f"(CASE WHEN {pj} IS NULL OR json_type({pj}) <> 'OBJECT' THEN 'Response is not a dictionary' "
        f"WHEN {r} IS NULL THEN 'Missing ''results'' key in response' "
        f"WHEN {first} IS NOT NULL THEN NULL "
        f"WHEN NOT {truthy(r)} THEN 'Empty results array' "
        f"ELSE '''results'' is not an array' END)"
    )


def build_address(loc_rec: str, at: tuple) -> str:
    def v(*k):
        return get(loc_rec, *(at + k))

    def s(*k):
        return py_text(v(*k))

    number_t = f"coalesce({s('street', 'number')}, '')"
    name_t = f"coalesce({s('street', 'name')}, '')"
    either = f"{truthy(v('street', 'number'))} OR {truthy(v('street', 'name'))}"
    joined = strip(f"{number_t} || ' ' || {name_t}")
    street = f"(CASE WHEN {either} THEN {joined} END)"
    city = clean_string(s("city"))
    postcode = clean_string(s("postcode"))
    state = clean_string(s("state"))
    country = clean_string(s("country"))
    city_postcode = strip(f"{city} || ' ' || {postcode}")
    city_part = f"(CASE WHEN {city} <> '' THEN (CASE WHEN {postcode} <> '' THEN {city_postcode} ELSE {city} END) END)"
    return (
        f"concat_ws(', ', {street}, {city_part}, CASE WHEN {state} <> '' THEN {state} END, "
        f"CASE WHEN {country} <> '' THEN {country} END)"
    )


def flatten_user(u: str) -> dict[str, str]:
    def s(*k):
        return py_text(get(u, *k))

    registered = f"coalesce({s('registered', 'date')}, '')"
    email = s("email")
    return {
        "id": uuid5_url(f"{clean_email(email)} || ':' || {clean_string(registered)}"),
        "first_name": clean_string(s("name", "first"), "Unknown"),
        "last_name": clean_string(s("name", "last"), "Unknown"),
        "gender": f"lower({clean_string(s('gender'), 'other')})",
        "address": build_address(u, ("location",)),
        "email": clean_email(email),
        "username": clean_string(s("login", "username")),
        "dob": clean_string(s("dob", "date")),
        "registered_date": clean_string(registered),
        "phone": clean_string(s("phone")),
        "picture": clean_string(s("picture", "medium")),
    }
