"""Property tests of the small operators against plain Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.functions import comma_list
from shoplens.operators.sequence import successor_pairs

SETTINGS = settings(max_examples=20, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def jvm_split(s: str) -> list[str]:
    """The JVM's String.split(","): trailing empty items removed; no match -> [s]."""
    if "," not in s:
        return [s]
    parts = s.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(texts=st.lists(st.text(alphabet="12,", max_size=6), min_size=1, max_size=15))
def test_comma_list_is_jvm_split(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.l for r in df.select("i", comma_list("s").alias("l")).collect()}
    assert got == {i: jvm_split(t) for i, t in enumerate(texts)}


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3),                     # group
                               st.integers(0, 40),                    # order key
                               st.one_of(st.none(), st.integers(0, 9))),  # value
                     min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1])),
       width=st.integers(1, 15))
def test_successor_pairs_equal_lead(spark, rows, width):
    df = spark.createDataFrame(rows, "g int, o int, v int").withColumn(
        "b", F.floor(F.col("o") / width))
    got = successor_pairs(df, ["g"], "b", ["o"], "v", "nxt")
    want = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("g").orderBy("o")))
    key = ["g", "o", "nxt"]
    assert sorted(map(tuple, got.select(key).collect()), key=str) == \
        sorted(map(tuple, want.select(key).collect()), key=str)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40),
                               st.one_of(st.none(), st.text(alphabet="ab", max_size=2))),
                     min_size=1, max_size=50, unique_by=lambda r: (r[0], r[1])),
       width=st.integers(1, 12))
def test_ordered_concat_equals_python_join(spark, rows, width):
    from shoplens.operators.sequence import ordered_concat
    df = spark.createDataFrame(rows, "g int, o int, v string").withColumn(
        "b", F.floor(F.col("o") / width))
    got = {r.g: r.vals for r in ordered_concat(df, ["g"], "b", ["o"],
                                               {"vals": F.col("v")}).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        vals = [v for _, _, v in sorted(r for r in rows if r[0] == g) if v is not None]
        want[g] = ",".join(vals)
    assert got == want
