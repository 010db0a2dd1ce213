"""The offset-addressed line source: ranges, admission, restart, growth."""

import os
import tempfile
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.sources.ads import landed_ads_lines
from shoplens.sources.line_log import Folder, LineStream, Range, read_line_stream, register
from shoplens.streaming import runner


def run_dir():
    return tempfile.mkdtemp(prefix="run-")


def put(folder, name, data, mode="wb"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), mode) as f:
        f.write(data)


def lines_of(folder, ranges):
    return [(v, p) for r in ranges for b in Folder(folder).lines(r)
            for v, p in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\r", max_size=12), max_size=12), st.integers(1, 30), st.booleans())
def test_ranges_of_any_size_give_every_whole_line_once(lines, step, tail):
    d = run_dir()
    data = "".join(x + "\n" for x in lines).encode()
    put(d, "a", data + (b"half" if tail else b""))
    folder = Folder(d)
    end = folder.plan({}, None)
    assert end == {"a": len(data)}
    got = lines_of(d, folder.ranges({}, end, step))
    assert [v for v, _ in got] == [x.removesuffix("\r") for x in lines]
    assert [p for _, p in got] == [len("".join(y + "\n" for y in lines[:i]).encode()) for i in range(len(lines))]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=6), min_size=1, max_size=3), st.integers(1, 60))
def test_admission_ends_at_lines_and_loses_nothing(files, budget):
    d = run_dir()
    for i, sizes in enumerate(files):
        put(d, f"f{i}", b"".join(b"x" * n + b"\n" for n in sizes))
    folder, at, got = Folder(d), {}, []
    for _ in range(100):
        end = folder.plan(at, budget)
        if end == at:
            break
        took = sum(end[f] - at.get(f, 0) for f in end)
        assert 0 <= took <= budget + 41
        got += lines_of(d, folder.ranges(at, end, 16))
        at = end
    assert sorted(len(v) for v, _ in got) == sorted(n for s in files for n in s)


def test_a_line_longer_than_the_budget_and_a_block_is_one_line(monkeypatch):
    d = run_dir()
    put(d, "a", b"y" * 5_000_000 + b"\nz\n")
    folder = Folder(d)
    assert folder.plan({}, 10) == {"a": 5_000_001}
    assert [len(v) for v, _ in lines_of(d, folder.ranges({}, folder.plan({}, None), 1_000_000))] == [5_000_000, 1]
    assert lines_of(d, [Range("a", 5_000_001, 5_000_003)]) == [("z", 5_000_001)]


def test_growth_retention_and_truncation():
    d = run_dir()
    put(d, "a", b"1\n2\n")
    put(d, "_hidden", b"no\n")
    s = LineStream({"path": d, "startingOffsets": "latest"})
    first = s.initialOffset()
    assert first == {"a": 4}
    put(d, "a", b"3\n4", "ab")
    put(d, "b", b"5\n")
    second = s.latestOffset()
    assert second == {"a": 6, "b": 2}
    assert sorted(lines_of(d, s.partitions(first, second))) == [("3", 4), ("5", 0)]
    os.unlink(os.path.join(d, "b"))
    assert s.latestOffset() == {"a": 6}
    put(d, "a", b"1\n")
    with pytest.raises(RuntimeError, match="shorter"):
        s.folder.plan({"a": 6}, None)


def test_the_first_end_is_not_before_the_beginning():
    """Spark asks a new query for its end first, a resumed one only for its end."""
    d = run_dir()
    put(d, "a", b"1\n2\n3\n4\n")
    options = {"path": d, "maxBytesPerTrigger": "2", "positions": d + "/_positions"}
    s = LineStream(options)
    assert s.latestOffset() == {"a": 8} == s.initialOffset()  # latest: nothing yet
    put(d, "a", b"5\n6\n7\n", "ab")
    assert s.latestOffset() == {"a": 10}
    again = LineStream(options)
    assert again.latestOffset() == {"a": 12} and again.latestOffset() == {"a": 14} == again.latestOffset()
    assert again.initialOffset() == {"a": 8}
    early = LineStream({**options, "startingOffsets": "earliest", "positions": d + "/_other"})
    assert early.latestOffset() == {"a": 2} and early.initialOffset() == {}


@pytest.mark.parametrize("options", [{"startingOffsets": "middle"}, {"maxBytesPerTrigger": "10"}])
def test_bad_options_are_refused(options):
    with pytest.raises(ValueError):
        LineStream({"path": "/tmp", **options})


def test_stream_restarts_from_its_offsets(spark):
    d = run_dir()
    put(d + "/in", "a", b"".join(b"line %d\n" % i for i in range(50)))

    def run(rows):
        stream = read_line_stream(spark, d + "/in", "earliest", 100, d + "/positions.json", 64)
        q = (stream.writeStream.format("parquet").option("path", d + "/out")
             .option("checkpointLocation", d + "/ck").trigger(processingTime="0 seconds").start())
        try:
            end = time.time() + 90
            while time.time() < end and q.isActive:
                taken = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
                if sum(taken) >= rows:
                    break
                time.sleep(0.2)
            q.processAllAvailable()  # nothing more comes
            return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
        finally:
            q.stop()

    taken = run(50)
    assert sum(taken) == 50 and max(taken) <= 13 and len(taken) >= 4  # about 100 bytes each
    put(d + "/in", "a", b"".join(b"line %d\n" % i for i in range(50, 60)), "ab")
    put(d + "/in", "b", b"line 60\nunfinished")
    assert sum(run(11)) == 11
    got = spark.read.parquet(d + "/out")
    assert sorted(r.value for r in got.collect()) == sorted(f"line {i}" for i in range(61))
    assert got.select("file", "position").distinct().count() == 61


def test_parts_are_taken_by_one_query(spark, monkeypatch):
    """A start a part costs more than the part; the micro-batches stay as small."""
    reads = []
    monkeypatch.setattr(runner, "read_line_stream", lambda *a: reads.append(a) or read_line_stream(*a))
    d = run_dir()
    lines = [f"{i} A c {i} 1" for i in range(40)] + ["bad"]
    out = runner.run_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), d, 100)
    got = spark.read.parquet(out)
    assert sorted(r.user_id for r in got.where("kind = 'good'").collect()) == list(range(40))
    assert [r.line for r in got.where("kind = 'bad'").collect()] == ["bad"]
    batches = [x for x in os.listdir(d + "/checkpoints/lines/commits") if x.isdigit()]
    assert len(reads) == 1 and len(batches) >= 4


def test_files_are_dealt_to_queries_side_by_side_and_read_once(spark, monkeypatch):
    """A micro-batch is one small task: by a single query the job takes as long on any cluster."""
    reads, inputs = [], []

    def read(*a):
        reads.append(a)
        return read_line_stream(*a)

    monkeypatch.setattr(runner, "read_line_stream", read)
    monkeypatch.setattr(runner, "LINE_FILE_ROWS", 10)
    real = runner.landed_ads_lines
    monkeypatch.setattr(runner, "landed_ads_lines", lambda v: inputs.append(1) or real(v))
    d = run_dir()
    lines = [f"{i} A c {i} 1" for i in range(60)] + ["bad", "6 A c x 1"]
    out = runner.run_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), d, 50)
    files = [f for f in os.listdir(d + "/lines") if f[0] not in "._"]
    assert len(files) == 7 and len(reads) == len(inputs) == runner.LINE_QUERIES
    assert sorted(f for a in reads for f in a[-1]) == sorted(files)
    got = runner.read_lines(spark, out)
    assert sorted(r.user_id for r in got.where("kind = 'good'").collect()) == list(range(60))
    assert sorted((r.line, r.reason, r.ts, r.user_id) for r in got.where("kind = 'bad'").collect()) == [
        ("6 A c x 1", "user is not an integer", None, None), ("bad", "fewer than 5 fields", None, None)]
    for i in range(len(reads)):
        assert len([x for x in os.listdir(d + f"/checkpoints/lines-{i}/commits") if x.isdigit()]) >= 3


def test_a_line_is_read_once_by_the_landing_stream(spark):
    d = run_dir()
    put(d + "/in", "a", b"1 A c 1 1\n2 A c 2 1\nbad\n")
    q = (landed_ads_lines(read_line_stream(spark, d + "/in", "earliest").select("value")).writeStream.format("parquet")
         .partitionBy("kind").option("path", d + "/out").option("checkpointLocation", d + "/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(90)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3  # twice as many by two frames
    assert {(r.kind, r.user_id, r.line) for r in spark.read.parquet(d + "/out").collect()} == {
        ("good", 1, None), ("good", 2, None), ("bad", None, "bad")}


def test_files_are_dealt_by_size():
    sizes = {"a": 5, "b": 4, "c": 3, "d": 0, "e": 2}
    assert runner.dealt(sizes, 2) == [["a", "e"], ["b", "c"]]
    assert runner.dealt(sizes, 9) == [["a"], ["b"], ["c"], ["e"]] and runner.dealt({"d": 0}, 4) == [[]]


def test_a_range_is_read_to_little_more_than_its_end(monkeypatch):
    import pyarrow as pa
    d, taken = run_dir(), []
    put(d, "a", b"0123456789\n" * 100_000)
    opened = Folder._open

    class File:
        def __init__(self, name):
            self.file = pa.OSFile(name)

        def __enter__(self):
            return self

        def __exit__(self, *e):
            self.file.close()

        def read_at(self, n, at):
            block = self.file.read_at(n, at)
            taken.append(len(block))
            return block

    class System:
        def open_input_file(self, name):
            return File(name)

    monkeypatch.setattr(Folder, "_open", lambda self: (System(), opened(self)[1]))
    assert len(lines_of(d, [Range("a", 0, 11_000)])) == 1000
    assert sum(taken) <= 11_000 + 8192  # a block of 1 MiB before


def test_batch_read(spark):
    d = run_dir()
    put(d, "a", "ä\nb\n".encode())
    register(spark)
    assert [tuple(r) for r in spark.read.format("adlines").option("path", "file://" + d).load().collect()] == [
        ("ä", "a", 0), ("b", "a", 3)]
