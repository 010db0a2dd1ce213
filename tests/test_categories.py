from pyspark.sql import functions as F

from rows import action
from shoplens.plans import categories


def _counts(df):
    return {(r.category_id, r.action): r.n for r in categories.category_action_counts(df).collect()}


def test_exclusive_priority_and_lists(actions_df):
    rows = [
        action(ccat=3, ocats="1,2", eid=1),          # click wins, order list ignored
        action(ocats="1,2,,", eid=2),                # trailing empties dropped
        action(ocats="3,3", eid=3),                  # duplicates count twice
        action(ocats="", pcats="4", eid=4),          # empty order list: falls to pay
        action(pcats="5,", eid=5),
    ]
    c = _counts(actions_df(rows))
    assert c == {("3", "click"): 1, ("1", "order"): 1, ("2", "order"): 1, ("3", "order"): 2,
                 ("4", "pay"): 1, ("5", "pay"): 1}


def test_order_only_category_is_ranked_with_zero_clicks(actions_df):
    rows = [action(ccat=1, eid=1), action(ocats="2", eid=2), action(pcats="3", eid=3)]
    top = categories.category_top(actions_df(rows), 10).collect()
    assert [(r.category_id, r.click_count, r.order_count, r.pay_count) for r in top] == \
        [("1", 1, 0, 0), ("2", 0, 1, 0), ("3", 0, 0, 1)]


def test_top10_ties_by_id(actions_df):
    rows = [action(ccat=c, eid=c) for c in range(1, 13)]  # 12 categories, 1 click each
    top = categories.category_top(actions_df(rows), 10, task_id="t").collect()
    assert [r.category_id for r in top] == sorted(str(c) for c in range(1, 13))[:10]
    assert top[0].task_id == "t"


def test_session_top_exact_n_with_ties(actions_df, spark):
    rows = [action(f"s{i:02d}", ccat=1, eid=i) for i in range(12)]
    rows += [action("s99", ccat=1, eid=100 + i) for i in range(3)]
    rows += [action("x", ccat=2, eid=200)]
    df = actions_df(rows)
    top = spark.createDataFrame([("1",)], "category_id string")
    out = categories.category_session_top(df, top, 10).orderBy(F.desc("click_count"), "session_id")
    got = [(r.category_id, r.session_id, r.click_count) for r in out.collect()]
    assert got[0] == ("1", "s99", 3)
    assert len(got) == 10 and [g[1] for g in got[1:]] == [f"s{i:02d}" for i in range(9)]
