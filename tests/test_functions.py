import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import column_of
from tidegauge.functions import codec, hashing, text, timeconv


def expected_split(value, separator):
    if value == "":
        return [""]
    parts = value.split(separator)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize("separator", [",", "\t", " ", "|", "."])
def test_split_drops_trailing_empties_only(spark, separator):
    rng = random.Random(7)
    cases = ["", separator, separator * 3, "a", f"{separator}a", f"a{separator}{separator}b{separator}"]
    cases += ["".join(rng.choice(["a", "é", separator]) for _ in range(rng.randrange(9))) for _ in range(60)]
    got = column_of(spark, cases, text.split_fields("v", separator))
    assert got == [expected_split(case, separator) for case in cases]


def test_split_blanks_takes_each_blank_as_separator(spark):
    cases = ["a b", "a  b", "a\t\nb ", " a", "   ", "", "a\x0bb"]
    expected = [["a", "b"], ["a", "", "b"], ["a", "", "b"], ["", "a"], [], [""], ["a", "b"]]
    assert column_of(spark, cases, text.split_blanks("v")) == expected


def test_words_and_lines(spark):
    cases = ["  the  cow\tjumped\n", "", "   ", "one"]
    assert column_of(spark, cases, text.words("v")) == [["the", "cow", "jumped"], [], [], ["one"]]
    cases = ["a b\n\nc\n", "\n", "", "x"]
    assert column_of(spark, cases, text.lines("v")) == [["a b", "c"], [], [], ["x"]]


def test_field_access_and_numbers(spark):
    parts = text.split_fields("v", ",")
    assert column_of(spark, ["a,b", "a", ",b"], text.field(parts, 1)) == ["b", None, "b"]
    cases = ["12", "-3", "+4", "12.5", "n/a", "", " 1", "9223372036854775808"]
    assert column_of(spark, cases, text.to_long("v")) == [12, -3, 4, None, None, None, None, None]


def test_second_key_and_character_from_end(spark):
    assert column_of(spark, ["1526700293637", "123"], text.second_key("v")) == ["1526700293", None]
    assert column_of(spark, ["1300024510", "1234"], text.char_from_end("v", 5)) == ["2", None]


def test_reverse_words(spark):
    cases = ["I am a student.", "one", "a  b ", "  ", ""]
    assert column_of(spark, cases, text.reverse_words("v")) == ["student. a am I", "one", "b  a", "", ""]


def test_log_time_both_ways(spark):
    cases = ["2021-03-14 07:21:45", "2021-03-14 07:21:45\trest", "2021-03-14", "nope", ""]
    stamp = 1615706505000
    assert column_of(spark, cases, timeconv.parse_ms("v")) == [stamp, stamp, None, None, None]
    assert column_of(spark, [stamp, stamp + 999], timeconv.format_ms("v"), "BIGINT") == [cases[0]] * 2


def test_whole_number_times(spark):
    assert column_of(spark, [1528411199000], timeconv.ms_to_seconds("v"), "BIGINT") == [1528411199]
    assert column_of(spark, [1528411199], timeconv.block_floor("v"), "BIGINT") == [1528410600]
    cases = [0, 9_599, 9_600, 9_999, 10_000, 10_599, 10_600]
    expected = [0, 9_000, 9_600, 9_600, 10_000, 10_000, 10_600]
    assert column_of(spark, cases, timeconv.block_floor("v"), "BIGINT") == expected
    assert column_of(spark, [0, 599, 600, -1], timeconv.window_floor("v", 600), "BIGINT") == [0, 0, 600, -600]


def unit_sum(value):
    raw = value.encode("utf-16-le")
    return sum(int.from_bytes(raw[i : i + 2], "little") for i in range(0, len(raw), 2))


def test_char_sum_counts_utf16_units(spark):
    rng = random.Random(3)
    alphabet = ["a", "Z", "é", "中", "😀", "𐍈", "\n", " ", "￿", "\U0010ffff"]
    cases = ["", "aé😀"] + ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(50)]
    cases.append("long text 😀 " * 20_000)
    got = column_of(spark, cases, hashing.char_sum("v"))
    assert got == [unit_sum(case) for case in cases]
    assert got[1] == 112519
    parts = column_of(spark, cases, hashing.text_partition("v", 7))
    assert parts == [unit_sum(case) % 7 for case in cases]


def test_big_char_sums_stay_in_range(spark):
    # 40,000 x 65,535 is above 2^31.
    assert column_of(spark, ["￿" * 40_000], hashing.text_partition("v", 16)) == [40_000 * 65_535 % 16]


def test_field_partition_falls_back_to_round_robin(spark):
    cases = ['{"pid":"ab"}', '{"other":1}', "broken", "broken", '{"pid":12}']
    got = column_of(spark, cases, hashing.field_partition("v", "pid", 4, "i"))
    assert got == [(97 + 98) % 4, 1, 2, 3, (49 + 50) % 4]


def test_delay_lines(spark):
    line = column_of(spark, [5], codec.csv_line("v", F.lit(None), F.lit("a,b")), "INT")
    assert line == ["5,null,a,b"]
    got = column_of(spark, ["1,2,click,3", "x,2,click,3", "1,2"], codec.parse_delay("v"))
    assert [tuple(r) for r in got] == [(1, 2, "click", 3), (None, 2, "click", 3), (1, 2, None, None)]
    assert bytes(column_of(spark, ["é"], codec.csv_bytes("v", F.lit(1)))[0]) == "é,1".encode()
    assert column_of(spark, [7], codec.key_value_line(F.lit("k"), "v"), "INT") == ["k\t7"]


def test_result_json(spark):
    start, end = F.lit(1615706400000), F.lit(1615706999999)
    got = column_of(spark, [3], codec.count_json(start, end, F.lit("lk_5_2"), "v"), "BIGINT")
    assert got == [
        '{"start_time":"2021-03-14 07:20:00","end_time":"2021-03-14 07:29:59",'
        '"type":"lk_5_2","count":"3"}'
    ]
    maps = [{"cmt": 14, "fwd": 12}, {}]
    got = column_of(spark, maps, codec.indicator_json(start, end, "v"), "MAP<STRING,BIGINT>")
    assert json.loads(got[0])["indexs"] == {"cmt": "14", "fwd": "12"}
    assert got[1].endswith('"indexs":{}}')
