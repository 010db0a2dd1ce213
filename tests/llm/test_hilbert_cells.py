"""op4: cells of whole strings by brute force, clashing columns, file bounds."""

import random
from collections import Counter

from shoplens.llm import hilbert


def cells_by_hand(values, bits):
    """Value -> number of cut points at or below it, from the sorted list of all rows."""
    known = sorted((v for v in values if v is not None), key=lambda v: v.encode())
    counts, cell, smaller = Counter(known), {}, 0
    for v in sorted(counts, key=lambda v: v.encode()):
        cell[v] = smaller * 2**bits // len(known)
        smaller += counts[v]
    order = sorted(set(cell.values()))
    return {v: order.index(c) for v, c in cell.items()} | {None: 0}


def test_strings_alike_at_their_beginning_lie_in_different_cells(spark):
    names = [f"https://example.org/corpus/{x}" for x in "abcdefgh"]
    df = spark.createDataFrame([(i, names[i % 8]) for i in range(800)], "k long, s string")
    cuts = hilbert.string_cuts(df, "s", 4)
    assert cuts == names[1:]
    got = hilbert.hilbert_shards(df, ["s"], 8, ["k"]).groupBy("shard", "s").count().collect()
    assert len(got) == 8  # a shard a source


def test_string_cells_equal_brute_force(spark):
    rng = random.Random(4)
    pool = ["".join(rng.choices("aé漢\U0001f600b", k=rng.randint(0, 30))) for _ in range(300)]
    values = [rng.choice(pool) for _ in range(2000)] + ["hot" * 50] * 1000 + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame(list(enumerate(values)), "k long, s string").repartition(7)
    cuts = hilbert.string_cuts(df, "s", 3)
    got = {r.s: r.c for r in df.select("s", hilbert.cell(df["s"], cuts).alias("c")).distinct().collect()}
    want = cells_by_hand(values, 3)
    assert {v: want[v] for v in got} == got and max(got.values()) <= 7


def test_columns_with_the_names_of_the_result(spark):
    df = spark.createDataFrame([(i, f"s{i % 5}", -1, i % 3, "old") for i in range(60)],
                               "k long, shard string, slot int, n int, hilbert string")
    got = hilbert.hilbert_shards(df, ["shard", "n"], 4, ["k"])
    assert got.columns == ["k", "n", "hilbert", "shard", "slot"]
    rows = got.collect()
    assert Counter(r["shard"] for r in rows) == {i: 15 for i in range(4)}
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, i) for s in range(4) for i in range(15)]


def test_run_bounds_are_those_of_the_files(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, rng.choice("abcdef"), rng.randint(0, 99)) for i in range(2000)], "k long, a string, b int")
    got = hilbert.with_run_bounds(hilbert.hilbert_shards(df, ["a", "b"], 4, ["k"]), ["a", "b"], 100).collect()
    files = {}
    for r in got:
        files.setdefault((r["shard"], r["run"]), []).append(r)
    assert len(files) == 20 and all(len(f) == 100 for f in files.values())
    for f in files.values():
        for d in "ab":
            assert {(r[f"run_min_{d}"], r[f"run_max_{d}"]) for r in f} == {(min(r[d] for r in f), max(r[d] for r in f))}
    hit = sum(min(r["a"] for r in f) <= "c" <= max(r["a"] for r in f) and min(r["b"] for r in f) <= 10 for f in files.values())
    assert hit <= 8  # of 20 files, for one value of a and a tenth of b


def test_no_rows(spark):
    df = spark.createDataFrame([], "k long, a string")
    assert hilbert.hilbert_shards(df, ["a"], 4, ["k"]).collect() == []
