"""Topics by density: groups of crowded vectors, and outliers that are near none of them.

A vector is a core when at least ``min_points`` vectors, itself included, are within ``eps``; cores
within ``eps`` of each other share a topic, other vectors within ``eps`` of a core join the nearest
one's topic, the rest are outliers.

Vectors are put on a grid whose cells are no wider than ``eps`` from corner to corner. In a cell of
``min_points`` or more all are cores of one topic, however many there are, and none is compared with
another. Only vectors of thinner cells are compared with those of the cells around them.
"""

from __future__ import annotations

from itertools import product
from math import floor, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.components import components
from parley.operators.minibatch import usable
from parley.sources.tables import stored

OUTLIER = -1
SALTS = 16


def _squares(size: int, term: str) -> Column:
    """The sum over the dimensions of the square of ``term``, in which ``{i}`` is the dimension."""
    return F.expr(" + ".join(f"pow({term.format(i=i)}, 2)" for i in range(size)))


def _gap(size: int, a: str, b: str) -> Column:
    """Squared distance between the boxes of two cells."""
    return _squares(size, f"greatest(0D, {b}.lo[{{i}}] - {a}.hi[{{i}}], {a}.lo[{{i}}] - {b}.hi[{{i}}])")


def _span(size: int, a: str, b: str) -> Column:
    """The greatest squared distance that vectors in two boxes can have."""
    return _squares(size, f"greatest({b}.hi[{{i}}] - {a}.lo[{{i}}], {a}.hi[{{i}}] - {b}.lo[{{i}}])")


def _grid(points: DataFrame, size: int, eps: float, min_points: int) -> DataFrame:
    """Cells with their number of vectors, least id and bounding box."""
    box = [F.array(*[f(F.get("x", F.lit(i))) for i in range(size)]).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    cells = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least_id"), *box)
    return stored(cells.withColumn("dense", F.col("n") >= min_points), "cells")


def _neighbours(cells: DataFrame, size: int, eps: float) -> DataFrame:
    """Ordered pairs of cells whose boxes are within ``eps``; of thin cells also with themselves.

    Cells meet through blocks of cells that are wider than ``eps``: each looks at its own block and
    those around it, so what it meets is bounded by geometry, not by the number of vectors."""
    wide = floor(sqrt(size)) + 1
    steps = F.array(*[F.array(*[F.lit(z).cast("long") for z in o]) for o in product((-1, 0, 1), repeat=size)])
    own = cells.withColumn("block", F.transform("cell", lambda c: F.floor(c / wide)))
    around = own.withColumn("step", F.explode(steps)).withColumn("block", F.zip_with("block", "step", lambda b, s: b + s))
    names = ["cell", "n", "lo", "hi", "dense"]
    a = around.select("block", F.struct(*names).alias("a"))
    b = own.select("block", F.struct(*names).alias("b"))
    met = a.join(b, "block").filter((F.col("a.cell") != F.col("b.cell")) | ~F.col("a.dense"))
    return met.filter(_gap(size, "a", "b") <= eps * eps).select("a", "b")


def _apart(size: int, a: str = "x", b: str = "y") -> Column:
    return _squares(size, f"{a}[{{i}}] - {b}[{{i}}]")


def _dense_edges(points: DataFrame, pairs: DataFrame, size: int, eps: float) -> DataFrame:
    """Pairs of dense cells that hold two vectors within ``eps``.

    Boxes that lie within ``eps`` as a whole decide at once. For the others the vector of one cell
    nearest to the other's box, the nearest to that one in the other cell, and the nearest to this
    one again are tried; what then is still open is compared vector by vector, but only those within
    ``eps`` of the other box, and equal ones once."""
    both = pairs.filter("a.dense and b.dense and a.cell < b.cell").withColumn("near", _span(size, "a", "b") <= eps * eps)
    both = stored(both, "dense-pairs")
    def shaped(df: DataFrame) -> DataFrame:
        return df.select(F.col("a.cell").alias("ca"), F.col("b.cell").alias("cb"))

    done = shaped(both.filter("near"))
    open_ = both.filter("not near")
    rows = points.filter("dense").select("cell", "x")

    def closest(df: DataFrame, side: str, order: Column, *kept: str) -> DataFrame:
        """The vector of one side that comes first, for each pair."""
        met = df.join(rows, F.col(f"{side}.cell") == rows.cell)
        return met.groupBy("a", "b", *kept).agg(F.min(F.struct(order.alias("d"), "x")).alias("best"))

    to_box = _squares(size, "greatest(0D, b.lo[{i}] - x[{i}], x[{i}] - b.hi[{i}])")
    tried = closest(open_, "a", to_box).select("a", "b", F.col("best.x").alias("y"))
    for side in ("b", "a"):
        tried = stored(closest(tried, side, _apart(size), "y").select("a", "b", "best"), "tried")
        done = done.union(shaped(tried.filter(F.col("best.d") <= eps * eps)))
        tried = tried.filter(F.col("best.d") > eps * eps).select("a", "b", F.col("best.x").alias("y"))
    left = tried.select("a", "b")
    near_b = left.join(rows, F.col("a.cell") == rows.cell).filter(to_box <= eps * eps)
    near_a = left.join(rows, F.col("b.cell") == rows.cell).filter(
        _squares(size, "greatest(0D, a.lo[{i}] - x[{i}], x[{i}] - a.hi[{i}])") <= eps * eps
    )
    ends = [F.col("a.cell").alias("ca"), F.col("b.cell").alias("cb")]
    xs = near_b.select(*ends, "x").distinct()
    ys = near_a.select(*ends, F.col("x").alias("y")).distinct()
    return done.union(xs.join(ys, ["ca", "cb"]).filter(_apart(size) <= eps * eps).select("ca", "cb").distinct())


def density_clusters(
    df: DataFrame, eps: float, min_points: int, column: str = "reduced", id: str = "id"
) -> DataFrame:
    """``id``, ``cluster`` (the smallest id of its cores; NULL for outliers) and ``core``, one row
    per row of ``df``. Vectors have the same number of components, a few (cells look at 3 to the
    power of it). Rows without a vector, or with one that holds a NULL or no number, are outliers.
    A vector with several nearest cores joins the one with the smallest id. Rows that share an id
    are vectors of their own; ids are not NULL."""
    fine = df.filter(usable(column)).select(F.col(id).alias("id"), F.transform(column, lambda v: v.cast("double")).alias("x"))
    first = fine.select(F.size("x")).first()
    rest = df.filter(~usable(column)).select(F.col(id).alias("id"), F.lit(None).cast(df.schema[id].dataType).alias("cluster"), F.lit(False).alias("core"))
    if first is None:
        return rest
    size = first[0]
    side = eps / sqrt(size) * (1 - 1e-9)
    fine = fine.withColumn("uid", F.monotonically_increasing_id())
    fine = stored(fine.withColumn("cell", F.transform("x", lambda v: F.floor(v / side))), "vectors")
    cells = _grid(fine, size, eps, min_points)
    points = stored(fine.join(cells.select("cell", "dense"), "cell"), "points")
    pairs = stored(_neighbours(cells, size, eps), "neighbours")

    # Vectors of thin cells with those around them. Dense cells are dealt to salted keys.
    salt = F.explode(F.when(F.col("to_dense"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    around = pairs.filter("not a.dense").select(F.col("a.cell").alias("cell"), F.col("b.cell").alias("to"), F.col("b.dense").alias("to_dense"))
    thin = points.filter("not dense").select("uid", "id", "cell", "x").join(around, "cell").withColumn("salt", salt)
    others = points.select(
        F.col("cell").alias("to"), F.when(F.col("dense"), F.pmod("uid", F.lit(SALTS))).otherwise(0).cast("int").alias("salt"),
        F.col("x").alias("y"), F.col("id").alias("other_id"), F.col("uid").alias("other"),
    )
    met = thin.join(others, ["to", "salt"]).withColumn("d", _apart(size)).filter(F.col("d") <= eps * eps)
    found = F.struct("d", "other_id", "other")
    # Of a dense cell all vectors are cores: the nearest is enough. Thin ones have few.
    near = met.groupBy("uid", "id", "cell", "to", "to_dense").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("to_dense"), found)).alias("best"),
        F.collect_list(F.when(~F.col("to_dense"), found)).alias("few"),
    )
    near = stored(near, "near")
    counted = near.groupBy("uid", "id", "cell").agg((F.sum("n") >= min_points).alias("core"))
    counted = stored(counted, "counted")
    cores = counted.filter("core").select("uid", "id", "cell")

    listed = near.select("uid", "id", "cell", "to", F.explode("few").alias("q"))
    to_core = listed.join(cores.select(F.col("uid").alias("other")), F.col("q.other") == F.col("other"), "left_semi")
    core_near = near.filter("to_dense").select("uid", "id", "cell", "to", F.col("best").alias("q")).union(to_core)
    core_near = stored(core_near, "near-cores")
    edges = core_near.join(cores.select("uid"), "uid", "left_semi").filter("cell <> to").select(F.col("cell").alias("a"), F.col("to").alias("b"))
    linked = components(edges.union(_dense_edges(points, pairs, size, eps).toDF("a", "b")))

    core_cells = cells.filter("dense").select("cell", F.col("least_id").alias("low"))
    core_cells = core_cells.union(cores.groupBy("cell").agg(F.min("id").alias("low")))
    core_cells = core_cells.join(linked.withColumnRenamed("node", "cell"), "cell", "left")
    core_cells = core_cells.withColumn("component", F.coalesce("component", "cell"))
    names = core_cells.groupBy("component").agg(F.min("low").alias("cluster"))
    labels = stored(core_cells.join(names, "component").select("cell", "cluster"), "labels")

    # A vector in its own thin cell's company: itself, if it is a core.
    crowd = points.filter("dense").select("id", "cell").join(labels, "cell").select("id", "cluster", F.lit(True).alias("core"))
    own = cores.join(labels, "cell").select("id", "cluster", F.lit(True).alias("core"))
    border = core_near.join(cores.select("uid"), "uid", "left_anti").groupBy("uid").agg(
        F.min(F.struct("q.d", "q.other_id", "to")).alias("q")
    )
    border = border.select("uid", F.col("q.to").alias("cell")).join(labels, "cell").select("uid", "cluster")
    edge = counted.filter("not core").join(border, "uid", "left").select("id", "cluster", F.lit(False).alias("core"))
    return crowd.union(own).union(edge).union(rest).withColumnRenamed("id", id)


def density_topics(
    df: DataFrame, eps: float, min_points: int, column: str = "reduced", id: str = "id"
) -> DataFrame:
    """``id`` and ``topic_id``: clusters numbered from 0 by size, the larger first, ties by smallest
    core id; -1 for outliers."""
    found = stored(density_clusters(df, eps, min_points, column, id), "density")
    sizes = found.filter(F.col("cluster").isNotNull()).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    by_size = Window.orderBy(F.desc("n"), "cluster")  # one row per cluster
    numbers = sizes.select("cluster", (F.row_number().over(by_size) - 1).alias("topic_id"))
    return found.join(numbers, "cluster", "left").select(id, F.coalesce("topic_id", F.lit(OUTLIER)).alias("topic_id"))
