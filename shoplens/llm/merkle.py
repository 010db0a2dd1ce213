"""Merkle manifest of a dataset: a slot pivot turns each parent's children into fanout columns.

Leaves are digests of whole rows. Inside a group they stand in key order; every
``FANOUT`` consecutive nodes of a level become one parent, level by level, until
one node, the group's subroot, is left. The subroots, in the order of their
groups, become the root in the same way. A parent is one grouped row: one
conditional aggregate per slot spreads its children into the columns c0, c1, ...
Their concatenation hashes to the parent; the columns beside a child's own are
its siblings. Proofs go down the pivoted levels from the root, so a leaf row is
written once, by its parent, with all its siblings.

DataFrame functions only. A level has an eighth of the nodes below it; each is
written to the shared folder. Ranks come from range partitions with a running
sum over the partitions' sizes, so neither a hot group nor a repeated row passes
through one task. The driver reads the size of the largest group, level by
level, and the root.

Nulls: a null field has its own mark and differs from the empty text; a null
group is one of its own, the first. A null key is the lowest. Rows equal in
group, key and leaf are leaves of their own in any order (their digests are
equal, so the tree is the same). A single leaf is its group's subroot; a single
subroot is the root. Empty table: no rows. Fields are taken by name, other
columns do not enter.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import read, staged

FANOUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def marked(value: Column) -> Column:
    """A field as it enters a digest: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def ordered_rank(spark: SparkSession, df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx``, the gapless rank from 0 of each row within ``group``
    by ``order``, and ``n``, the group's rows. ``order`` must tell all rows apart;
    ``group`` is not null. The window over a group's range partitions has at most
    as many rows as there are shuffle partitions."""
    dealt = staged(spark, df.repartitionByRange(group, *order)
                   .withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__rows"))
    parts = Window.partitionBy(group)
    earlier = parts.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, "__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
                         F.sum("__rows").over(parts).alias("n"))
    inside = Window.partitionBy(group, "__part").orderBy(*order)
    return (dealt.join(sizes, [group, "__part"])
            .withColumn("idx", F.col("__before") + F.row_number().over(inside) - 1)
            .drop("__part", "__before"))


def slots(fanout: int) -> list[str]:
    return [f"c{j}" for j in range(fanout)]


def pivot(nodes: DataFrame, fanout: int, carried: list[str] = ()) -> DataFrame:
    """One row (g, idx, n) per parent with its children's digests in c0, c1, ...
    and, for each column carried, the children's values in <column>0, ...; n is
    still the number of children of the whole group."""
    slot = F.col("idx") % fanout
    spread = [F.max(F.when(slot == j, F.col(name))).alias(f"{out}{j}")
              for name, out in [("digest", "c"), *((c, c) for c in carried)] for j in range(fanout)]
    return (nodes.groupBy("g", F.expr(f"idx div {fanout}").alias("idx"), "n").agg(*spread))


def parents(pivoted: DataFrame, fanout: int) -> DataFrame:
    """The level above: (g, idx, digest, n)."""
    return pivoted.select("g", "idx", digest(*[F.coalesce(c, F.lit("")) for c in slots(fanout)]).alias("digest"),
                          F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"))


def climb(spark: SparkSession, nodes: DataFrame, fanout: int, carried: list[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The pivoted levels over ``nodes`` (g, idx, digest, n, carried columns),
    lowest first, and the tops (g, digest, height): the one node left of each g."""
    levels: list[DataFrame] = []
    tops = nodes.where("n = 1").select("g", "digest", F.lit(0).alias("height"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = staged(spark, pivot(nodes.where("n > 1"), fanout, carried if not levels else ()), "level")
        levels.append(level)
        nodes = parents(level, fanout)
        tops = tops.union(nodes.where("n = 1").select("g", "digest", F.lit(len(levels))))
        most = -(-most // fanout)
    return levels, tops


def children(level: DataFrame, fanout: int, carried: list[str] = ()) -> DataFrame:
    """The child rows of pivoted parents that have a ``path``: (g, idx, digest,
    carried columns, subroot, path), the path one step (the siblings left and right) longer."""
    names = slots(fanout)

    def beside(part: list[str]) -> Column:
        return F.concat(F.lit(""), *[F.coalesce(c, F.lit("")) for c in part])

    each = F.array(*[F.struct(F.lit(j).alias("slot"), F.col(names[j]).alias("digest"),
                              F.struct(beside(names[:j]).alias("left"), beside(names[j + 1:]).alias("right")).alias("step"),
                              *[F.col(f"{c}{j}").alias(c) for c in carried]) for j in range(fanout)])
    rows = level.select("g", "idx", "subroot", "path", F.explode(each).alias("x")).where("x.digest is not null")
    return rows.select("g", (F.col("idx") * fanout + F.col("x.slot")).alias("idx"), F.col("x.digest").alias("digest"),
                       *[F.col(f"x.{c}").alias(c) for c in carried], "subroot",
                       F.concat(F.array("x.step"), "path").alias("path"))


def descend(spark: SparkSession, levels: list[DataFrame], tops: DataFrame, fanout: int,
            carried: list[str] = ()) -> DataFrame:
    """The lowest nodes with their ``path`` up to the root. ``tops``: (g, height,
    subroot, path) of the one node left of each g."""
    below = None
    for height in range(len(levels), 0, -1):
        known = tops.where(F.col("height") == height).select("g", F.lit(0).cast("long").alias("idx"), "subroot", "path")
        if below is not None:
            known = known.union(below.select("g", "idx", "subroot", "path"))
        located = levels[height - 1].join(known, ["g", "idx"])
        below = children(located, fanout, carried if height == 1 else ())
        if height > 1:
            below = staged(spark, below, "paths")
    return below


def proof_text(path: Column) -> Column:
    """The siblings level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(spark: SparkSession, leaves: DataFrame, group: str, key: str, leaf: str,
             carried: list[str] = (), fanout: int = FANOUT) -> DataFrame:
    """(key, leaf, carried columns, subroot, root, path) per row of ``leaves``.

    ``path`` is an array of (left, right): the siblings beside the row's node at
    each level, from its leaf run to the root. ``proof_text`` and ``fold`` work on it.
    """
    kept = [key, *carried]
    shape = "array<struct<left:string,right:string>>"
    # the group as a text that is never null and keeps the order: null first, then bytewise
    g = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    narrow = staged(spark, leaves.select(g.alias("g"), F.col(leaf).alias("digest"), F.struct(*kept).alias("kept"),
                                         F.monotonically_increasing_id().alias("__row")), "leaves")
    # the row number parts equal rows into different ranges
    nodes = ordered_rank(spark, narrow.withColumn("__key", F.col(f"kept.{key}")), "g",
                         ["__key", "digest", "__row"]).drop("__key", "__row")
    nodes = staged(spark, nodes, "nodes")
    levels, tops = climb(spark, nodes, fanout, ["kept"])
    tops = staged(spark, tops, "subroots")
    seats = ordered_rank(spark, tops.select(F.lit("").alias("all"), "g", "digest"), "all", ["g"])
    seats = staged(spark, seats.select(F.col("all").alias("g"), "idx", "digest", "n", F.col("g").alias("name")), "seats")
    upper, top = climb(spark, seats, fanout, ["name"])
    first = top.first()
    root = F.lit(first["digest"] if first else None).cast("string")
    none = F.array().cast(shape)
    if upper:
        paths = descend(spark, upper, top.select("g", "height", F.lit("").alias("subroot"), none.alias("path")),
                        fanout, ["name"]).select(F.col("name").alias("g"), "path")
    else:
        paths = seats.select(F.col("name").alias("g"), none.alias("path"))
    tops = staged(spark, tops.join(paths, "g").select("g", "height", F.col("digest").alias("subroot"), "path"), "tops")
    out = ["kept", "digest", "subroot", "path"]
    rows = nodes.where("n = 1").join(tops, "g").select(*out)
    if levels:
        rows = rows.union(descend(spark, levels, tops, fanout, ["kept"]).select(*out))
    return rows.select("kept.*", F.col("digest").alias(leaf), "subroot", root.alias("root"), "path")


def leaf_of(text: Column) -> Column:
    """A document's leaf with ``text`` as its text."""
    return digest(*[marked(text if name == "text" else F.col(name)) for name in FIELDS])


def op13_slot_pivot_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as leaves by language, their proofs, and which survive tampering."""
    docs = read(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = leaf_of(F.col("text"))
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(hit, leaf_of(lower)).alias("told"))
    tree = manifest(spark, leaves, "lang", "doc_id", "leaf", ["told"])
    found = tree.withColumn("folded_root", fold(F.coalesce("told", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
