"""The command-line jobs, run in-process on the test session."""

import json
import os
import tempfile

from shoplens import jobs
from shoplens.streaming import ads_stream as S

SF = "/root/testdata/sf0.001"


def test_offline_job_writes_the_five_tables(spark):
    out = tempfile.mkdtemp(prefix="run-")
    cond = {"startDate": "2024-01-05", "endDate": "2024-01-25", "startAge": 20, "endAge": 50,
            "targetPageFlow": "1,2,3,4,5,6,7"}
    jobs.main(["offline", "--data", SF, "--condition", json.dumps(cond), "--out", out,
               "--task-id", "cli"])
    assert sorted(os.listdir(out)) == ["category_top10", "category_top10_session_count",
                                       "page_convert_rate", "random_session_info",
                                       "session_stat_info"]
    r = spark.read.parquet(os.path.join(out, "session_stat_info")).first()
    assert r.task_id == "cli" and r.session_count > 0


def test_area_job_prints(capsys, spark):
    jobs.main(["area", "--data", SF])
    assert "cityremark" in capsys.readouterr().out


def test_stream_job_available_now(spark):
    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(os.path.join(d, "lines"))
    with open(os.path.join(d, "lines", "a.txt"), "w") as f:
        f.write("1704067200000 A c 1 5\n1704067200000 A c 1\n1704067260000 A c 2 5\n")
    jobs.main(["stream", "--lines", os.path.join(d, "lines"), "--out", os.path.join(d, "out"),
               "--available-now"])
    tot = S.read_daily_totals(spark, os.path.join(d, "out")).collect()
    assert [(r.day, r.ads_id, r.clicks) for r in tot] == [("2024-01-01", 5, 2)]
    bad = spark.read.parquet(os.path.join(d, "out", "bad_lines")).collect()
    assert [r.reason for r in bad] == ["fewer than 5 fields"]


def test_native_stream_job_available_now(spark):
    from shoplens.streaming import blacklist, sliding, totals
    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(os.path.join(d, "lines"))
    hour, base = 3_600_000, 1704067200000
    for name, rows in (("a", [(0, 5), (10, 5), (20, 6)]), ("b", [(3 * hour, 6)])):
        with open(os.path.join(d, "lines", name), "w") as f:
            f.write("".join(f"{base + ms} A c 1 {ad}\n" for ms, ad in rows) + "1704067200000 A c 1\n")
    out = os.path.join(d, "out")
    args = ["stream-native", "--lines", os.path.join(d, "lines"), "--out", out, "--starting", "earliest",
            "--lateness", "1 hour", "--slide", "30 minutes", "--available-now"]
    jobs.main(args)
    jobs.main(args)  # nothing new: the same results
    assert sorted((r.day, r.ads_id, r.clicks) for r in totals.read_totals(spark, out + "/totals").collect()) == [
        ("2024-01-01", 5, 2), ("2024-01-01", 6, 2)]
    assert blacklist.read_kept(spark, out + "/blacklist").count() == 4
    slides = {((r.slide_ms - base) // 60_000, r.ads_id, r.clicks) for r in sliding.read_slides(spark, out + "/sliding").collect()}
    assert slides == {(30, 5, 2), (60, 5, 2), (30, 6, 1), (60, 6, 1)}
    bad = spark.read.parquet(out + "/bad_lines").collect()
    assert [r.reason for r in bad] == ["fewer than 5 fields"] * 2
