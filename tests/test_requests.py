"""Request planning against plain Python."""

import base64
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from restframe.functions.headers import basic_auth, headers_from_options
from restframe.functions.urls import add_parameter, form_decode, is_valid_url, query_params
from restframe.operators.keys import lookup_args, resolve_keys
from restframe.operators.request import (
    assemble_url,
    flexible_query,
    get_query,
    json_query,
    plan_requests,
    search_query,
)
from restframe.spec import LookupSpec


def spec(**changes):
    return LookupSpec(url="http://service", schema="id int").replace(**changes)


def keys(frame, *names):
    return resolve_keys(frame, list(names))


ITEM = {"sku": "bolt-7", "region": "north", "shelf": "42"}


@pytest.fixture(scope="module")
def item(spark):
    return spark.createDataFrame([tuple(ITEM.values())], ", ".join(f"{name} string" for name in ITEM))


def test_get_query(item):
    got = item.select(get_query(keys(item, *ITEM), spec()).query).first()[0]
    assert got == "&".join(f"{name}={quote_plus(value)}" for name, value in ITEM.items())


def test_get_query_decimal(spark):
    frame = spark.sql("select cast(305 as decimal(12,0)) as weight")
    assert frame.select(get_query(keys(frame, "weight"), spec()).query).first()[0] == "weight=305"


def test_get_query_nested_keys_keep_their_own_names(spark):
    frame = spark.sql("select 'bolt' as part, named_struct('city', 'oslo', 'dock', 'c9') as place")
    got = frame.select(get_query(keys(frame, "part", "place"), spec()).query).first()[0]
    assert got == "part=bolt&city=oslo&dock=c9"


def test_get_query_encodes_names_and_values(spark):
    frame = spark.sql("select 'a b&c=ü~*' as `the key~`")
    pairs = {"the key~": F.col("`the key~`")}
    got = frame.select(get_query(resolve_keys(frame, pairs), spec()).query).first()[0]
    assert got == "the+key%7E=a+b%26c%3D%C3%BC%7E*"


def test_null_keys_give_no_argument(spark):
    frame = spark.sql(
        "select 1 as a, cast(null as string) as b, cast(null as struct<c:int,d:struct<e:int>>) as r, 2 as z"
    )
    args = frame.select(lookup_args(keys(frame, "a", "b", "r", "z"))).first()[0]
    assert [tuple(a) for a in args] == [("a", "1"), ("z", "2")]


def test_json_body(spark):
    frame = spark.sql("select 308 as lot, 'q-5' as label")
    assert frame.select(json_query(keys(frame, "lot", "label"), spec()).query).first()[0] == '{"lot":308,"label":"q-5"}'


def test_search_query(item):
    got = item.select(search_query(keys(item, *ITEM), spec()).query).first()[0]
    assert got == "q=" + "%20AND%20".join(f"{name}:%22{value}%22" for name, value in ITEM.items())
    assert item.select(search_query([], spec()).query).first()[0] == ""


def test_date_keys(spark):
    frame = spark.sql("select date'2024-01-02' as d, timestamp'2024-01-02 03:04:05.6' as t")
    iso = frame.select(lookup_args(keys(frame, "d", "t"))).first()[0]
    assert [a.value for a in iso] == ["2024-01-02", "2024-01-02T03:04:05.6"]
    epoch = frame.select(lookup_args(keys(frame, "d", "t"), "epoch")).first()[0]
    assert [a.value for a in epoch] == ["19724", "1704164645600"]


@pytest.mark.parametrize("method", ["POST", "PUT"])
def test_flexible_body(spark, method):
    frame = spark.sql("select 'n5' as dock")
    flexible = spec(method=method, query_param_fields=("dock",), body_fields=("dock", "gone"), url_map={"dock": "at"})
    parts = flexible_query(keys(frame, "dock"), flexible)
    got = frame.select(parts.query, parts.url_params, parts.path_params["at"]).first()
    assert tuple(got) == ('{"dock":"n5"}', "dock=n5", "n5")


def test_flexible_null_is_null_text_in_get_and_absent_elsewhere(spark):
    frame = spark.sql("select cast(null as string) as a, 'x y' as b")
    chosen = spec(query_param_fields=("a", "b", "gone"))
    assert frame.select(flexible_query(keys(frame, "a", "b"), chosen).query).first()[0] == "a=null&b=x+y&gone=null"
    posted = chosen.replace(method="POST")
    assert frame.select(flexible_query(keys(frame, "a", "b"), posted).url_params).first()[0] == "b=x+y"


def test_flexible_rejects_ambiguous_names(spark):
    frame = spark.sql("select 1 as a, named_struct('a', 2) as r")
    with pytest.raises(ValueError, match="ambiguous"):
        flexible_query(keys(frame, "a", "r"), spec())


@pytest.mark.parametrize("names", [(), ("dock",), ("dock", "shelf")])
@pytest.mark.parametrize("own", ["", "?lang=no"])
@pytest.mark.parametrize("query", [None, "  ", "size=9", "size=9&tone=red"])
def test_assemble_url(one, names, own, query):
    """Every placeholder is filled; the query goes behind ? or, if there is one already, &."""
    path = {name: f"{name[0]}-{len(name)}" for name in names}
    base = "http://depot.example" + "".join(f"/by-{name}/{{{name}}}" for name in names) + own
    want = "http://depot.example" + "".join(f"/by-{name}/{value}" for name, value in path.items()) + own
    if query and query.strip():
        want += ("&" if own else "?") + query
    url, problem = assemble_url(
        base, None if query is None else F.lit(query), {k: F.lit(v) for k, v in path.items()}
    )
    assert problem is None
    assert one(url) == want


def test_missing_placeholder_is_an_error(spark):
    frame = spark.sql("select 'v' as a")
    lost = spec(query_creator="generic-json-url", url_map={"a": "nowhere"})
    assert "no placeholder" in plan_requests(frame, lost, ["a"]).first()["error"]
    unfilled = spec(url="http://service/{x}", query_creator="generic-json-url")
    assert "invalid URL" in plan_requests(frame, unfilled, ["a"]).first()["error"]


@pytest.mark.parametrize("raw", [False, True])
@pytest.mark.parametrize("value", ["ola:s3cret:x", "Basic b2xh", "token 77", "ü:ß"])
def test_authorization(one, raw, value):
    ready = raw or value.startswith("Basic ")
    want = value if ready else "Basic " + base64.b64encode(value.encode()).decode()
    assert one(basic_auth(F.lit(value), raw)) == want
    assert headers_from_options({"h.Authorization": value}, "h.", raw) == {"Authorization": want}


def test_header_name_is_the_last_segment():
    assert headers_from_options({"p.x.Origin": "*", "q.Other": "1"}, "p.") == {"Origin": "*"}


@pytest.mark.parametrize(
    ("query", "want"),
    [
        ("a=1&b=2;c=3", [("a", "1"), ("b", "2"), ("c", "3")]),
        ("a&b=&=x&&c==d", [("a", None), ("b", ""), ("c", "=d")]),
        ("a=%41%zz+%4", [("a", "A%zz %4")]),
        ("a=%%41", [("a", "%%41")]),
        ("a=%+1", [("a", "%+1")]),
        ("n%20m= x  y \t z ", [("n m", "x y z")]),
        ("k=%C3%BC", [("k", "ü")]),
        ("", []),
    ],
)
def test_query_params(one, query, want):
    assert [tuple(p) for p in one(query_params(F.lit(query)))] == want


def test_form_decode_leaves_null(one):
    assert one(form_decode(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://u:p@h:8080/p/a?x=1&x=2#f", "http://u:p@h:8080/p/a?x=1&x=2&n=a+b#f"),
        ("http://h", "http://h?n=a+b"),
        ("http://h/p?q", "http://h/p?q&n=a+b"),
        ("http://h/p?q=%7E%20*", "http://h/p?q=%7E+*&n=a+b"),
        ("/relative?x", "/relative?x&n=a+b"),
        ("http://a b", None),
    ],
)
def test_add_parameter(one, url, want):
    assert one(add_parameter(F.lit(url), F.lit("n"), F.lit("a b"))) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [("http://h/p", True), ("mailto:a@b", True), ("/p", True), ("http://h/{x}", False), ("http://h/%zz", False)],
)
def test_valid_url(one, url, want):
    assert one(is_valid_url(F.lit(url))) is want
