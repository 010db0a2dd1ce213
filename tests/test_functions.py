
from shoplens.functions import action_kind, comma_list, pairs_json, pct1, time_ms, whole_pct


def test_comma_list_drops_trailing_empties(spark):
    df = spark.createDataFrame([("1,2,,",), ("3,3",), (",",), ("",), (None,), (",1",)], "s string")
    got = [r[0] for r in df.select(comma_list("s")).collect()]
    # JVM String.split(",") semantics
    assert got == [["1", "2"], ["3", "3"], [], [""], None, ["", "1"]]


def test_pct1_golden_ratios(spark):
    # one recorded run: 1464 / 4132 by length, 3344 / 2252 by steps, of 5596
    df = spark.createDataFrame([(1464, 5596), (4132, 5596), (3344, 5596), (2252, 5596), (0, 5),
                                (1, 0)], "n long, t long")
    got = [r[0] for r in df.select(pct1("n", "t")).collect()]
    assert got == [26.2, 73.8, 59.8, 40.2, 0.0, None]


def test_pct1_golden_conversions(spark):
    pairs = [(25, 1171), (29, 1118), (26, 1103), (22, 1145), (14, 1094), (24, 1189)]
    df = spark.createDataFrame(pairs, "n long, t long")
    assert [r[0] for r in df.select(pct1("n", "t")).collect()] == [2.1, 2.6, 2.4, 1.9, 1.3, 2.0]


def test_whole_pct_truncates(spark):
    df = spark.createDataFrame([(4567, 10000), (3333, 10000), (2, 3), (1, 3)], "n long, t long")
    assert [r[0] for r in df.select(whole_pct("n", "t")).collect()] == [45.0, 33.0, 66.0, 33.0]


def test_action_kind_first_match_wins(spark):
    rows = [("kw", 5, "1,2", None), (None, 5, "1,2", None), (None, -1, "", None),
            (None, -1, None, "3"), (None, -1, None, None)]
    df = spark.createDataFrame(rows, "kw string, cp long, op string, pp string")
    got = [r[0] for r in df.select(action_kind("kw", "cp", "op", "pp")).collect()]
    # an empty order list still counts as an order in the summary
    assert got == ["search", "click", "order", "pay", None]


def test_pairs_json(spark):
    df = spark.createDataFrame([([(1, 10), (2, 8)],)], "l array<struct<k:int,v:bigint>>")
    assert df.select(pairs_json("l")).first()[0] == '[{"1":10},{"2":8}]'


def test_time_ms(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:10",), ("bad",)], "t string")
    assert [r[0] for r in df.select(time_ms("t")).collect()] == [1704067210000, None]
