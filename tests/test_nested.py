import json

from hypothesis import given, settings
from hypothesis import strategies as st

from kinograph.operators import nested

PAYLOADS = [
    (1, {"cast": [{"id": 5, "character": " A "}, None, {"id": "7", "roles": [{"character": None}, {"character": "B"}, None]}], "crew": []}),
    (2, {"credits": {"credits": {"crew": {"id": 3, "job": "Director"}, "cast": None}}}),
    (3, {"cast": [{"id": None, "person": {"id": 9}, "character": "C"}, {"id": "x1"}, {"id": True}, {"name": "no id"}, "text", [1]]}),
    (4, {"crew": [{"id": 4, "jobs": [], "job": "Editor"}, {"id": 4, "jobs": None}, {"person": {"id": "12"}, "jobs": [{"job": "X"}, {"job": "Y"}]}]}),
    (5, [{"cast": [{"id": 1}]}]),
    (6, "nothing"),
]
BROKEN = [(20, ""), (21, None), (22, '{"cast":[{"id":1}'), (23, '{"cast":[{"id":NaN}]}'), (24, '{"cast":[]} x'), (25, json.dumps(json.dumps({"cast": [{"id": 8, "character": "Z"}]})))]


def expected(value):
    out = []

    def whole(x):
        if isinstance(x, bool):
            return None
        if isinstance(x, int):
            return x
        return int(x) if isinstance(x, str) and x.isascii() and x.isdigit() else None

    def entry(kind, pos, e):
        if not isinstance(e, dict):
            return
        person = e.get("person")
        pid = whole(e.get("id"))
        if pid is None and isinstance(person, dict):
            pid = whole(person.get("id"))
        if pid is None:
            return
        key = {"cast": "character", "crew": "job"}[kind]
        lists = e.get("roles") or e.get("jobs")
        if isinstance(lists, list) and lists:
            for i, r in enumerate(lists):
                out.append((kind, pos, i, pid, ((r or {}).get(key) or "").strip()))
        else:
            out.append((kind, pos, 0, pid, (e.get(key) or "").strip()))

    def walk(v):
        if isinstance(v, dict):
            for k, x in v.items():
                if k in ("cast", "crew"):
                    for i, e in enumerate(x if isinstance(x, list) else [x]):
                        entry(k, i, e)
                walk(x)
        elif isinstance(v, list):
            for x in v:
                walk(x)

    walk(value)
    return out


def test_credit_entities(spark, rows):
    deep = {"cast": [{"id": 77, "character": "deep"}]}
    text = json.dumps(deep)
    for _ in range(6000):
        text = '{"a":[' + text + "]}"
    data = [(k, json.dumps(v)) for k, v in PAYLOADS] + BROKEN + [(30, text)]
    df = spark.createDataFrame([(k, p, "clash", -1) for k, p in data], "fetch_id bigint, payload string, label string, node int")
    nodes = nested.shred(df, "fetch_id", "payload")
    got = rows(nested.credit_entities(nodes), "record", "credit_kind", "pos", "role_pos", "tmdb_person_id", "role_name")
    want = [(k, *r) for k, v in PAYLOADS for r in expected(v)] + [(25, "cast", 0, 0, 8, "Z"), (30, "cast", 0, 0, 77, "deep")]
    assert got == sorted(want, key=repr)


def test_links_and_empty(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":[10,{"c":"x"}]}}')], "k bigint, p string")
    got = {(r.node, r.parent, r.label, r.ordinal, r.kind, r.scalar) for r in nested.shred(df, "k", "p").collect()}
    assert got == {(0, -1, None, None, "object", None), (1, 0, "a", None, "object", None), (2, 1, "b", None, "array", None), (5, 2, None, 0, "int", "10"), (3, 2, None, 1, "object", None), (4, 3, "c", None, "str", "x")}
    assert nested.credit_entities(nested.shred(df.limit(0), "k", "p")).count() == 0


json_values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=5), x, max_size=4), max_leaves=20)


@settings(max_examples=200, deadline=None)
@given(json_values, st.sampled_from([None, 1]))
def test_own_parser(value, indent):
    assert nested._parse_deep(json.dumps(value, indent=indent)) == value


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='{}[]:,"a1 \\ntruefalsenull-.e', max_size=12))
def test_own_parser_rejects_what_json_rejects(text):
    try:
        want = json.loads(text, parse_constant=nested._not_json)
    except ValueError:
        want = ValueError
    try:
        got = nested._parse_deep(text)
    except ValueError:
        got = ValueError
    assert got == want


def test_whole_numbers_of_very_many_digits(spark, rows):
    long = "9" * 5000
    deep = '{"x":' + "[" * 3000 + long + "]" * 3000 + ',"cast":[{"id":6}]}'
    payloads = [(1, f'{{"budget":{long},"cast":[{{"id":5,"character":"A"}},{{"id":{long}}}]}}'), (2, long), (3, deep), (4, f'{{"a":{long},"b":NaN}}'), (5, f'{{"a":{long}')]
    df = spark.createDataFrame(payloads, "fetch_id bigint, payload string")
    nodes = nested.shred(df, "fetch_id", "payload")
    assert rows(nested.credit_entities(nodes), "record", "pos", "tmdb_person_id", "role_name") == [(1, 0, 5, "A"), (3, 0, 6, "")]
    assert rows(nodes.where("length(scalar) = 5000"), "record", "kind", "scalar") == sorted([(1, "int", long), (1, "int", long), (2, "int", long), (3, "int", long)])
    assert not nodes.where("record in (4, 5)").count()


def test_links(spark, rows):
    nodes = nested.shred(spark.createDataFrame([(1, '{"a":[{"b":1}]}')], "fetch_id bigint, payload string"), "fetch_id", "payload")
    assert rows(nested.links(nodes), "parent_label", "parent_kind", "label", "ordinal", "kind") == sorted(
        [(None, None, None, None, "object"), (None, "object", "a", None, "array"), ("a", "array", None, 0, "object"), (None, "object", "b", None, "int")], key=repr
    )
