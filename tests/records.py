"""An invented user record and ways to vary it."""

import json

SF_SMALL = "/root/testdata/sf0.001"

USER_RECORD = {
    "login": {"username": "quietotter", "uuid": "0c2d7c1e"},
    "name": {"last": "Vantongeren", "title": "Dr", "first": "Ilse"},
    "email": "ilse.v@mail.example",
    "gender": "female",
    "dob": {"age": 51, "date": "1973-08-02T05:17:41.250Z"},
    "registered": {"age": 13, "date": "2011-11-30T19:02:09.000Z"},
    "location": {
        "city": "Harlingen",
        "country": "Netherlands",
        "postcode": "8861 KL",
        "state": "Friesland",
        "street": {"name": "Zoutsloot", "number": 86},
    },
    "nat": "NL",
    "picture": {"medium": "https://img.example/p/77.png"},
    "phone": "0517-990-114",
    "cell": "06-990-2201",
}
ADDRESS = "86 Zoutsloot, Harlingen 8861 KL, Friesland, Netherlands"

DELETE = object()


def response(user) -> str:
    return json.dumps({"results": [user], "info": {"page": 3, "results": 1}})


def with_changes(**changes):
    u = json.loads(json.dumps(USER_RECORD))
    for path, value in changes.items():
        node = u
        keys = path.split("__")
        for k in keys[:-1]:
            node = node[k]
        if value is DELETE:
            node.pop(keys[-1], None)
        else:
            node[keys[-1]] = value
    return u
