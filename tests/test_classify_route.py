import pytest
from pyspark.sql import functions as F

from helpers import as_rows, values
from tidegauge.operators import classify as cl
from tidegauge.operators import route, stamp

# An invented line: a page code within another code, a group digit, and text behind the codes.
SAMPLE = (
    "2020-02-03 04:05:06\t10.1.2.3\t2000020015\t14000116\t7\t1\t1\t42\t2000000027\t"
    "object=>42,auto=>0,from=>here:77;luicode:10000002;uicode:10000002;ext:insert_type:5|oriuicode:10000001_10000002;lang:xx"
)


def line(uid="1300024510", code="14000003", mode="1", extend="luicode:10000408;ext:insert_type:5"):
    fields = ["2021-03-14 07:21:45", "1.2.3.4", uid, code, "4", mode, "1", "8", "9", extend]
    return "\t".join(fields)


CASES = {
    SAMPLE: "lk_5_2",
    line(): "fwd_5_2",
    line(code="14000005"): "cmt_5_2",
    line(uid="12345"): "fwd_5_null",
    line(uid="123456"): "fwd_5_2",
    line(uid=""): "fwd_5_null",
    line(extend="luicode:10000408"): "other",
    line(extend="luicode:10000408;insert_type:55"): "other",
    line(extend="luicode:1;insert_type:5"): "other",
    # The page code is found inside the source page code when that comes first.
    line(code="14000116", extend="luicode:10000001;uicode:10000408;insert_type:5"): "other",
    line(code="14000116", extend="uicode:10000408;luicode:10000001;insert_type:5"): "lk_5_2",
    line(code="14000116", mode="0", extend="uicode:10000408;insert_type:5"): "other",
    line(code="14000098"): "other",
    line(extend=""): "bad_record",
    "2021-03-14 07:21:45\ttoo\tshort": "bad_record",
    line().replace("2021-03-14", "someday"): "bad_record",
}


def test_types(spark):
    got = dict(as_rows(cl.classify(values(spark, list(CASES)), 5), "value", "type"))
    assert got == CASES


def test_digit_only_guards_unless_fixed(spark):
    lines = values(spark, [line(uid="98765"), line(uid="1234"), line(uid="1300024510")])
    assert as_rows(cl.classify(lines, 3), "type") == [("fwd_3_2",), ("fwd_3_9",), ("fwd_3_null",)]
    assert as_rows(cl.classify(lines, 3, fixed=True), "type") == [("fwd_3_2",), ("fwd_3_5",), ("fwd_3_7",)]


def test_events_and_bad_records_share_the_lines(spark):
    lines = values(spark, list(CASES))
    bad = as_rows(cl.bad_records(lines, 5), "value")
    assert bad == sorted((text,) for text, kind in CASES.items() if kind == "bad_record")
    events = cl.interaction_events(lines, 5)
    assert events.count() == len(CASES) - len(bad)
    assert as_rows(events.select("ms").distinct(), "ms") == [(1580702706000,), (1615706505000,)]


ROUTES = {
    '{"idc":"al","pid":"1"}': "al",
    '{"idc":"gz"}': "gz",
    '{"idc":""}': "other",
    '{"idc":"sh"}': "other",
    '{"idc":5}': "other",
    '{"idc":null}': "other",
    '{"idc":["al"]}': "other",
    '{"pid":"1"}': "json_error",
    "[1]": "json_error",
    '"idc"': "json_error",
    "{broken": "json_error",
    "": "json_error",
}


def test_routes(spark):
    routed = route.with_route(values(spark, list(ROUTES)))
    assert dict(as_rows(routed, "value", "route")) == ROUTES
    assert as_rows(route.select_route(routed, "al"), "value") == [('{"idc":"al","pid":"1"}',)]
    counts = dict(as_rows(route.route_counts(routed), "route", "n"))
    assert counts == {"al": 1, "gz": 1, "other": 5, "json_error": 5}


def test_stamps_and_tags(spark):
    records = values(spark, ["x", None])
    tagged = stamp.tag_lines(records, 4, 16, F.lit(1526738522807))
    assert as_rows(tagged, "value")[1] == ("1526738522807,throughput_testing,4,16,x",)
    assert as_rows(stamp.copy_lines(records), "value") == [("null",), ("x",)]
    both = stamp.stamp_both(records.where("value = 'x'"), F.lit(5)).collect()
    assert [tuple(r) for r in both] == [(5, 5, "x", 1)]
    stamped = stamp.stamp_departure(stamp.stamp_arrival(records)).select("in_time", "out_time").first()
    assert stamped["in_time"] == stamped["out_time"] > 1_600_000_000_000


@pytest.mark.parametrize("digit", [0, 5, 9])
def test_other_never_has_a_group(spark, digit):
    got = as_rows(cl.classify(values(spark, [line(extend="none")]), digit), "type")
    assert got == [("other",)]
