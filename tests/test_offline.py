import tempfile

from shoplens.plans import registry as R
from shoplens.plans.offline import run_offline


def _rows(df):
    cols = sorted(c for c in df.columns if c != "task_id")
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_offline_job_equals_registered_queries(spark):
    sf = "/root/testdata/sf0.001"
    out = tempfile.mkdtemp(prefix="run-")
    res = run_offline(spark, sf, R.CONDITION, task_id="t1", out_dir=out)
    assert _rows(res["session_stat_info"]) == _rows(R.q_session_stat(spark, sf))
    assert _rows(res["random_session_info"]) == _rows(R.q_session_sample(spark, sf))
    assert _rows(res["category_top10"]) == _rows(R.q_category_top10(spark, sf))
    assert _rows(res["category_top10_session_count"]) == \
        _rows(R.q_category_session_top10(spark, sf))
    assert _rows(res["page_convert_rate"]) == _rows(R.q_page_convert_rate(spark, sf))
    back = spark.read.parquet(f"{out}/page_convert_rate")
    assert back.count() == res["page_convert_rate"].count()


def test_ads_batch_job_equals_registered_queries(spark):
    from shoplens.plans.offline import run_ads_batch
    sf = "/root/testdata/sf0.001"
    res = run_ads_batch(spark, sf, tempfile.mkdtemp(prefix="run-"))
    assert _rows(res["area_city_ads_day_clickcount"]) == _rows(R.q_ads_daily_totals(spark, sf))
    assert _rows(res["top3_ads_per_day"]) == _rows(R.q_ads_area_top3_json(spark, sf))
    assert _rows(res["last_hour_ads_click"]) == _rows(R.q_ads_last_hour_json(spark, sf))


def test_result_tables_match_declared_schemas(spark):
    from shoplens import schemas as SC
    sf = "/root/testdata/sf0.001"
    res = run_offline(spark, sf, R.CONDITION, task_id="t2")
    declared = {"session_stat_info": SC.SESSION_STAT_INFO,
                "random_session_info": SC.RANDOM_SESSION_INFO,
                "category_top10": SC.CATEGORY_TOP10,
                "category_top10_session_count": SC.CATEGORY_TOP10_SESSION_COUNT,
                "page_convert_rate": SC.PAGE_CONVERT_RATE}
    for name, schema in declared.items():
        got = [(f.name, f.dataType.simpleString()) for f in res[name].schema.fields]
        want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        assert got == want, name
    q6 = R.q_area_top3_product(spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in q6.schema.fields] == \
        [(f.name, f.dataType.simpleString()) for f in SC.AREA_TOP3_PRODUCT.fields]
    acts = R._filtered(spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in acts.schema.fields] == \
        [(f.name, f.dataType.simpleString()) for f in SC.USER_VISIT_ACTION.fields]
