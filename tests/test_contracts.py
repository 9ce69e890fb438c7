"""Contracts 1 and 2, envelope checks and routing."""

import json

from pyspark.sql import functions as F

from records import ADDRESS, DELETE, USER_RECORD, response, with_changes
from tollgate.operators import contracts as C
from tollgate.operators.route import route, route_outcomes
from tollgate.functions import variant as V


def errors_of(spark, users, contract=C.API_USER):
    df = spark.createDataFrame([(json.dumps(u),) for u in users], "t string")
    df = V.with_parsed(df, "t", "v")
    return [r[0] for r in C.check_contract(df, "v", contract, out="e").select("e").collect()]


def test_contract1_accepts_sample_and_coercions(spark):
    ok = [
        USER_RECORD,
        with_changes(gender="unknown"),                 # normalised, never an error
        with_changes(name__first=""),                   # may be empty
        with_changes(location__postcode=10115),         # number -> text
        with_changes(location__postcode=None),          # null -> ""
        with_changes(location__street__number=" 12 "),  # int text with blanks
        with_changes(location__street__number="1_000"),
        with_changes(location__street__number=12.5),    # truncated
        with_changes(phone=5551234),                    # number -> str
        with_changes(extra_key="ignored"),
    ]
    assert errors_of(spark, ok) == [[]] * len(ok)


def test_contract1_errors_in_declaration_order(spark):
    bad = [
        {"gender": "unknown", "name": {"first": "", "last": ""}, "email": "not-an-email"},
        with_changes(name=None),
        with_changes(name="Ilse"),
        with_changes(location__street__number="12.5"),
        with_changes(location__postcode=DELETE),
        with_changes(email={"a": 1}),
        with_changes(dob__age=None),
    ]
    out = errors_of(spark, bad)
    assert out[0] == [
        "Field 'location': field required",
        "Field 'email': Invalid email format: not-an-email",
        "Field 'login': field required",
        "Field 'dob': field required",
        "Field 'registered': field required",
        "Field 'phone': field required",
        "Field 'picture': field required",
    ]
    assert out[1] == ["Field 'name': none is not an allowed value"]
    assert out[2] == ["Field 'name': value is not a valid dict"]
    assert out[3] == ["Field 'location.street.number': value is not a valid integer"]
    assert out[4] == ["Field 'location.postcode': field required"]
    assert out[5] == ["Field 'email': str type expected"]
    assert out[6] == ["Field 'dob.age': none is not an allowed value"]


def test_contract1_root_not_object(spark):
    df = spark.createDataFrame([("[null]",), ('["x"]',)], "t string")
    df = V.with_parsed(df, "t", "v").select(V.get(F.col("v"), 0).alias("u"))
    out = [r[0] for r in df.select(C.contract_errors(F.col("u"), C.API_USER)).collect()]
    assert out == [["Field '__root__': UserAPIResponse expected dict not NoneType"],
                   ["Field '__root__': UserAPIResponse expected dict not str"]]


ID = "7b1c3f52-9d0e-4a86-8c55-2e90f1d4a6b3"
GOOD = {
    "id": ID,
    "username": USER_RECORD["login"]["username"],
    "first_name": USER_RECORD["name"]["first"],
    "last_name": USER_RECORD["name"]["last"],
    "gender": USER_RECORD["gender"],
    "email": USER_RECORD["email"],
    "phone": USER_RECORD["phone"],
    "address": ADDRESS,
    "picture": USER_RECORD["picture"]["medium"],
    "dob": USER_RECORD["dob"]["date"],
    "registered_date": USER_RECORD["registered"]["date"],
}


def test_contract2(spark):
    cases = [
        GOOD,
        {**GOOD, "id": "not-a-uuid"},
        {**GOOD, "id": "z" * 36},
        {**GOOD, "gender": "unknown"},
        {**GOOD, "first_name": ""},
        {**GOOD, "first_name": "x" * 101},
        {**GOOD, "phone": "1" * 51},
        {**GOOD, "nickname": "x", "alias": "y"},
    ]
    out = errors_of(spark, cases, C.USER)
    assert out[0] == []
    assert out[1] == ["Field 'id': ensure this value has at least 36 characters"]
    assert out[2] == [f"Field 'id': Invalid UUID format: {'z' * 36}"]
    assert out[3] == ["Field 'gender': Invalid gender: unknown. Must be male, female, or other"]
    assert out[4] == ["Field 'first_name': ensure this value has at least 1 characters"]
    assert out[5] == ["Field 'first_name': ensure this value has at most 100 characters"]
    assert out[6] == ["Field 'phone': ensure this value has at most 50 characters"]
    assert out[7] == ["Field 'alias': extra fields not permitted", "Field 'nickname': extra fields not permitted"]


def test_contracts_of_one_name_are_told_apart(spark):
    for key in ("a", "b"):
        mine = C.Contract("Mine", (C.Field(key),))
        assert errors_of(spark, [{"a": "x"}], mine) == [[] if key == "a" else ["Field 'b': field required"]]


def test_optional_column_fields_may_be_null(spark):
    mine = C.Contract("Mine", (C.Field("a", required=False, min_length=2), C.Field("b")))
    df = spark.createDataFrame([(None, None), ("x", "y"), ("xx", "y")], "a string, b string")
    out = [r[0] for r in df.select(C.column_contract_errors({c: F.col(c) for c in ("a", "b")}, mine)).collect()]
    assert out == [["Field 'b': field required"], ["Field 'a': ensure this value has at least 2 characters"], []]


def test_route_every_row_one_outcome(spark):
    bodies = [
        response(USER_RECORD),                                   # accepted
        "this is not json",                                      # envelope
        json.dumps({"results": []}),                             # envelope
        json.dumps({"info": {}}),                                # envelope
        json.dumps({"results": {"a": 1}}),                       # envelope (R17)
        json.dumps({"results": 0}),                              # envelope: falsy
        response(with_changes(email="bad")),                     # contract
        response(with_changes(gender="unknown")),                # transform (R1)
        response(with_changes(name__first="")),                  # transform
        response(with_changes(name=DELETE)),                     # accepted, names Unknown
        json.dumps({"results": [None]}),                         # contract, root error
        response(USER_RECORD) + " junk",                         # envelope: not one JSON value
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    rows = {r.k: r for r in route(df).collect()}
    stages = [rows[i].stage for i in range(len(bodies))]
    assert stages == ["accepted", "envelope", "envelope", "envelope", "envelope", "envelope", "contract",
                      "transform", "transform", "contract", "contract", "envelope"]
    assert rows[1].errors == ["Response is not a dictionary"]
    assert rows[2].errors == ["Empty results array"]
    assert rows[3].errors == ["Missing 'results' key in response"]
    assert rows[4].errors == ["'results' is not an array"]
    assert rows[5].errors == ["Empty results array"]
    u = rows[0].user
    assert (u.first_name, u.last_name, u.gender, u.address, u.email, u.username, u.picture) == (
        "Ilse", "Vantongeren", "female", ADDRESS, "ilse.v@mail.example", "quietotter",
        "https://img.example/p/77.png")
    import uuid
    assert u.id == str(uuid.uuid5(uuid.NAMESPACE_URL, "ilse.v@mail.example:2011-11-30T19:02:09.000Z"))
    assert rows[9].errors == ["Field 'name': field required"]
    assert rows[10].errors == ["Field '__root__': UserAPIResponse expected dict not NoneType"]
    counts = {(r.stage): r.n for r in route_outcomes(route(df)).groupBy("stage").agg(F.sum("n").alias("n")).collect()}
    assert sum(counts.values()) == len(bodies)


def test_route_unicode_and_long_values(spark):
    bodies = [
        response(with_changes(name__first="田中", name__last="太郎")),
        response(with_changes(location__street__name="A" * 200)),
        response(with_changes(phone="")),
        response(with_changes(name__first="  Ilse  ", email="  Ilse.V@Mail.EXAMPLE")),
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    rows = {r.k: r for r in route(df).collect()}
    assert rows[0].stage == "accepted" and rows[0].user.first_name == "田中"
    assert rows[1].stage == "accepted" and rows[1].user.address.startswith("86 " + "A" * 200)
    assert rows[2].stage == "accepted" and rows[2].user.phone == ""
    # email with leading blanks fails contract 1's pattern (not trimmed first)
    assert rows[3].stage == "contract"


def test_route_id_depends_only_on_email_and_registered(spark):
    a = response(with_changes(phone="1"))
    b = response(with_changes(phone="2", name__first="Other"))
    c = response(with_changes(email="someone@example.com"))
    df = spark.createDataFrame([(0, a), (1, b), (2, c)], "k int, body string")
    ids = {r.k: r.user.id for r in route(df).collect()}
    assert ids[0] == ids[1] != ids[2]


def test_flatten_defaults_missing_name(spark):
    from tollgate.operators.users import flatten_user

    df = spark.createDataFrame([(json.dumps(with_changes(name=DELETE)),), ("{}",)], "t string")
    df = V.with_parsed(df, "t", "u")
    rows = df.select(*flatten_user(F.col("u"))).collect()
    assert (rows[0].first_name, rows[0].last_name, rows[0].email) == ("Unknown", "Unknown", "ilse.v@mail.example")
    # empty record: defaults everywhere, and contract 2 then rejects it
    assert (rows[1].first_name, rows[1].gender, rows[1].address, rows[1].email) == ("Unknown", "other", "", "")
