"""Overlays on a grid: observations by cell, rolled up to the labels that overlap their cells.

Overlays are many-to-many: a cell may have several labels, a label many cells. Observations are counted by cell before anything is
joined, so a crowded cell is one row in the join, and each cell's count is dealt to its labels in whole numbers by their weights (largest
remainder), so every observation is counted once and totals add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dealt(counts: DataFrame, overlay: DataFrame) -> DataFrame:
    """cell_id, label, n: each cell's count (cell_id, n) dealt to the labels of overlay (cell_id, label, weight: a whole number; rows of a cell and label are added up) in proportion to their weights.

    Each label gets the whole part of its share; what is left goes to the largest remainders, ties to the smaller label. A cell without a label of weight above 0 keeps its
    count under a null label.
    """
    weights = overlay.where("weight > 0").groupBy("cell_id", "label").agg(F.sum("weight").alias("weight"))
    cell = Window.partitionBy("cell_id")
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    rows = counts.join(weights, "cell_id", "left").withColumn("all", F.sum("weight").over(cell))
    product = (exact("n").cast("decimal(19,0)") * exact("weight").cast("decimal(19,0)")).alias("product")
    rows = rows.withColumn("product", product).withColumn("part", F.call_function("div", F.col("product"), exact("all"))).withColumn("rest", F.col("product") % exact("all"))
    place = F.row_number().over(cell.orderBy(F.desc("rest"), "label"))
    left = F.col("n") - F.sum("part").over(cell)
    got = F.when(F.col("weight").isNull(), F.col("n")).otherwise(F.col("part") + (place <= left).cast("long"))
    return rows.select("cell_id", "label", got.alias("n"))


def rollup(observations: DataFrame, overlay: DataFrame, cells: DataFrame | None = None, use: Column | None = None) -> DataFrame:
    """label, n (observations), n_cells (with any): observations (cell_id) rolled up to the overlay's labels (cell_id, label, weight). What lies in no labelled cell, or has no cell, has a null label.

    With cells (the grid: cell_id and what `use` asks for, such as its share of land or its class) only observations in cells that `use` holds for are counted; what it asks for never weighs.
    """
    counts = observations.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
    if cells is not None:
        counts = counts.join(cells.where(F.lit(True) if use is None else use).select("cell_id"), "cell_id", "left_semi")
    return dealt(counts, overlay).where("n > 0").groupBy("label").agg(F.sum("n").alias("n"), F.count_distinct("cell_id").alias("n_cells"))
