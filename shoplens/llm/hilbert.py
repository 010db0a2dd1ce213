"""Hilbert-curve sharding: metadata quantised, rows ordered along the curve, cut into equal runs.

DataFrame functions only. Each dimension is quantised into at most 2**bits cells
of about equal depth; the driver reads their cut points, fewer than 2**bits values
a dimension. Numbers are cut by approximate percentiles; strings, whole ones, by
the running share of their distinct values, which are counted first and put in
order by range parts. The curve index is computed per cell, of which there are at most
2**(bits * dimensions); rows find their place as the sum of the earlier cells'
sizes plus a distributed rank inside their cell, so no task sorts a hot cell.
Law: ``rows`` - shard sizes differ by at most one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from shoplens.llm.common import distributed_rank, read, staged

BITS = 4
RUN_ROWS = 500
SHARDS = 16
FILE_ROWS = 4_000


def ordinal(df: DataFrame, name: str) -> Column:
    """The values of a dimension as they are cut: strings as they are, others as numbers."""
    return F.col(name) if isinstance(df.schema[name].dataType, StringType) else F.col(name).cast("double")


def string_cuts(df: DataFrame, name: str, bits: int) -> list[str]:
    """At most 2**bits - 1 values that begin a cell: a value's cell is the share of
    rows with smaller values, in steps of 1 / 2**bits."""
    spark = df.sparkSession
    values = (df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))
    dealt = staged(spark, values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "values")
    parts = dealt.groupBy("part").agg(F.sum("n").alias("rows"))  # at most as many as shuffle partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                         F.sum("rows").over(Window.partitionBy()).alias("rows"))
    inside = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    cells = (dealt.join(parts, "part").select("value", F.floor(smaller * 2**bits / F.col("rows")).alias("cell"))
             .groupBy("cell").agg(F.min("value").alias("value")))
    return [r["value"] for r in cells.orderBy("cell").collect()[1:]]


def cut_points(df: DataFrame, dims: list[str], bits: int = BITS) -> list[list]:
    """For each dimension, at most 2**bits - 1 increasing cut points."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    text = [d for d in dims if isinstance(df.schema[d].dataType, StringType)]
    numbers = [d for d in dims if d not in text]
    cuts = {d: string_cuts(df, d, bits) for d in text}
    if numbers:
        row = df.agg(*[F.percentile_approx(ordinal(df, d), shares, 10_000).alias(f"c{i}")
                       for i, d in enumerate(numbers)]).first()
        cuts |= {d: sorted(set(c or [])) for d, c in zip(numbers, row)}
    return [cuts[d] for d in dims]


def cell(value: Column, cuts: list) -> Column:
    """How many cut points lie at or below the value; a null lies in cell 0."""
    return reduce(lambda a, c: a + F.when(value >= F.lit(c), 1).otherwise(0), cuts, F.lit(0))


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Index of a cell along the Hilbert curve (Skilling's transform of the
    coordinates, then their bits interleaved from the highest)."""
    d = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << q).alias("q"), F.lit(i).alias("i"))
                      for q in range(bits - 1, 0, -1) for i in range(d)])

    def undo(x: Column, step: Column) -> Column:
        low = step["q"] - 1
        own, head = F.get(x, step["i"]), F.get(x, F.lit(0))
        hit = own.bitwiseAND(step["q"]) != 0
        t = F.when(hit, low).otherwise(head.bitwiseXOR(own).bitwiseAND(low))
        return F.transform(x, lambda v, j: F.when(
            (j == 0) | ((j == step["i"]) & ~hit), v.bitwiseXOR(t)).otherwise(v))

    x = F.aggregate(steps, F.array(*[a.cast("int") for a in axes]), undo) if bits > 1 else F.array(*axes)
    gray = [reduce(Column.bitwiseXOR, [F.get(x, F.lit(k)) for k in range(i + 1)]) for i in range(d)]
    turn = reduce(Column.bitwiseXOR, [F.when(gray[-1].bitwiseAND(F.lit(1 << q)) != 0, (1 << q) - 1)
                                      .otherwise(0) for q in range(1, bits)], F.lit(0))
    out = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for g in gray:
            out = out * 2 + F.shiftright(g.bitwiseXOR(turn), bit).bitwiseAND(F.lit(1))
    return out


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, order: list[str],
                   bits: int = BITS) -> DataFrame:
    """``df`` with ``hilbert`` (index of the row's cell), ``shard`` and ``slot``
    (gapless from 0 in each shard, along the curve). Rows of one cell are put
    in an order that ``order`` decides; equal rows are interchangeable. Null
    dimension values lie in the lowest cell; an empty table stays empty. Columns of
    ``df`` with these three names are replaced."""
    cuts = cut_points(df, dims, bits)
    cells = [cell(ordinal(df, d), c) for d, c in zip(dims, cuts)]
    code = reduce(lambda a, c: a * 2**bits + c, cells, F.lit(0))
    located = df.withColumn("__cell", code.cast("long"))
    # at most 2**(bits * len(dims)) rows from here to the broadcast
    sizes = located.groupBy("__cell").agg(F.count(F.lit(1)).alias("__rows"))
    mask = F.lit(2**bits - 1)
    axes = [F.shiftright("__cell", bits * (len(dims) - 1 - i)).bitwiseAND(mask) for i in range(len(dims))]
    sizes = sizes.withColumn("__hilbert", hilbert_index(axes, bits))
    along = Window.orderBy("__hilbert")
    sizes = sizes.select(
        "__cell", "__hilbert",
        (F.sum("__rows").over(along) - F.col("__rows")).alias("__before"),
        F.sum("__rows").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__all"))
    ranked = distributed_rank(located, "__cell", order, RUN_ROWS, "__rank")
    at = F.col("__before") + F.col("__rank")
    shard = F.expr(f"int((__before + __rank) * {shards} div __all)")
    first = F.expr(f"(__shard * __all + {shards - 1}) div {shards}")
    return (ranked.join(F.broadcast(sizes), "__cell")
            .withColumn("__shard", shard).withColumn("__slot", at - first)
            .select(*[c for c in df.columns if c not in ("hilbert", "shard", "slot")],
                    F.col("__hilbert").alias("hilbert"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot")))


def with_run_bounds(sharded: DataFrame, dims: list[str], rows_per_file: int) -> DataFrame:
    """``run`` (the file a row goes to in its shard) and run_min_<d>, run_max_<d>:
    what a reader of the file's statistics prunes by. A run has ``rows_per_file`` rows."""
    run = Window.partitionBy("shard", "run")
    out = sharded.withColumn("run", F.floor(F.col("slot") / rows_per_file))
    return out.select("*", *[fn(d).over(run).alias(f"run_{end}_{d}") for d in dims
                             for end, fn in (("min", F.min), ("max", F.max))])


def write_shards(sharded: DataFrame, path: str, rows_per_file: int) -> None:
    """Files of consecutive slots, one folder per shard: each file covers a
    short run of the curve, so its min/max statistics are narrow in every dimension."""
    (sharded.withColumn("__file", F.floor(F.col("slot") / rows_per_file))
     .repartition("shard", "__file").sortWithinPartitions("shard", "__file", "slot").drop("__file")
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards along a curve over language, source and length."""
    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    dims = ["lang", "source", "n_chars"]
    sharded = with_run_bounds(hilbert_shards(docs, dims, SHARDS, ["doc_id", "text_crc32"]), dims, FILE_ROWS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert", "run",
        *[f"run_{end}_{d}" for d in dims for end in ("min", "max")])
