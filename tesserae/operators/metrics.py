"""Pixel, instance and boundary metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tesserae.functions.storage import cut
from tesserae.operators.focal import boundary
from tesserae.operators.objects import label

TILE = "tile_id"


def pixel_counts(df: DataFrame, target: str, predicted: Column, by: Sequence[str] = (), ignore: int = 2) -> DataFrame:
    """``tp, fp, fn, tn`` of a boolean prediction; cells whose target is ``ignore`` do not count."""
    t, p = F.col(target) == 1, predicted
    add = lambda c: F.sum(c.cast("long"))
    return df.where(F.col(target) != ignore).groupBy(*by).agg(add(t & p).alias("tp"), add(~t & p).alias("fp"), add(t & ~p).alias("fn"), add(~t & ~p).alias("tn"))


def pixel_metrics(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    accuracy = (tp + tn) / n
    return counts.withColumns(
        {
            "accuracy": accuracy,
            "precision": div(tp, tp + fp),
            "recall": div(tp, tp + fn),
            "specificity": div(tn, tn + fp),
            "f1": div(tp * 2, tp * 2 + fp + fn),
            "jaccard": div(tp, tp + fp + fn),
            "kappa": div(accuracy - chance, F.lit(1.0) - chance),
            "hamming": F.lit(1.0) - accuracy,
        }
    )


def curve_counts(df: DataFrame, target: str, score: str, thresholds: Sequence[float], ignore: int = 2) -> DataFrame:
    """``threshold, tp, fp, fn, tn`` for ``score >= threshold``: one pass, a count for each threshold."""
    t, kept = F.col(target) == 1, df.where(F.col(target) != ignore)
    aggs = []
    for k, v in enumerate(thresholds):
        p = F.col(score) >= v
        aggs += [F.sum((t & p).cast("long")).alias(f"tp{k}"), F.sum((~t & p).cast("long")).alias(f"fp{k}")]
    row = kept.agg(F.sum(t.cast("long")).alias("pos"), F.count("*").alias("n"), *aggs)
    points = F.array(*(F.struct(F.lit(float(v)).alias("threshold"), F.col(f"tp{k}").alias("tp"), F.col(f"fp{k}").alias("fp")) for k, v in enumerate(thresholds)))
    long = row.select("pos", "n", F.explode(points).alias("c")).select("pos", "n", "c.*")
    return long.select("threshold", "tp", "fp", (F.col("pos") - F.col("tp")).alias("fn"), (F.col("n") - F.col("pos") - F.col("fp")).alias("tn"))


def areas(curve: DataFrame) -> DataFrame:
    """Area under the ROC curve (trapezoids) and average precision of ``curve_counts``."""
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    points = curve.withColumns({"tpr": div(F.col("tp"), F.col("tp") + F.col("fn")), "fpr": div(F.col("fp"), F.col("fp") + F.col("tn")), "precision": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(1.0))})
    down = Window.orderBy(F.col("threshold").desc())  # as many rows as thresholds
    at = lambda c: F.coalesce(F.lag(c).over(down), F.lit(0.0))
    steps = points.withColumns({"_roc": (F.col("fpr") - at("fpr")) * (F.col("tpr") + at("tpr")) / 2, "_ap": (F.col("tpr") - at("tpr")) * F.col("precision")})
    return steps.agg(F.sum("_roc").alias("auroc"), F.sum("_ap").alias("average_precision"))


def confusion(df: DataFrame, target: str, predicted: Column, ignore: int = 2) -> DataFrame:
    """Share of each prediction within the true class."""
    counts = df.where(F.col(target) != ignore).groupBy(F.col(target).alias("target"), predicted.cast("int").alias("predicted")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("target")))


def overlaps(targets: DataFrame, predictions: DataFrame) -> DataFrame:
    """Target x prediction instances that share cells: ``t, p, inter, iou``. Inputs are labels of ``objects.label``."""
    t = targets.select(TILE, "y", "x", F.col("region_id").alias("t"))
    p = predictions.select(TILE, "y", "x", F.col("region_id").alias("p"))
    inter = t.join(p, [TILE, "y", "x"]).groupBy(TILE, "t", "p").agg(F.count("*").alias("inter"))
    nt = t.groupBy(TILE, "t").agg(F.count("*").alias("nt"))
    np_ = p.groupBy(TILE, "p").agg(F.count("*").alias("np"))
    return inter.join(nt, [TILE, "t"]).join(np_, [TILE, "p"]).withColumn("iou", F.col("inter") / (F.col("nt") + F.col("np") - F.col("inter")))


def one_to_one(pairs: DataFrame) -> DataFrame:
    """Pairs in which every target and every prediction stands once: greatest IoU first, ties by target, then prediction.

    Each round takes the pairs that are the best of both their sides; there are as many rounds as the longest chain
    of ever better pairs.
    """
    taken, left = None, cut(pairs)
    rank = F.struct((-F.col("iou")).alias("a"), "t", "p")
    while True:
        best = lambda side: left.groupBy(TILE, side).agg(F.min(rank).alias(f"best_{side}"))  # noqa: E731,B023
        ranked = left.join(best("t"), [TILE, "t"]).join(best("p"), [TILE, "p"])
        now = cut(ranked.where((rank == F.col("best_t")) & (rank == F.col("best_p"))).select(pairs.columns))
        taken = now if taken is None else taken.unionByName(now)
        left = cut(left.join(now.select(TILE, "t"), [TILE, "t"], "left_anti").join(now.select(TILE, "p"), [TILE, "p"], "left_anti").select(pairs.columns))
        if left.isEmpty():
            return taken


def instance_counts(images: DataFrame, targets: DataFrame, predictions: DataFrame, threshold: float = 0.5, pairs: DataFrame | None = None, single: bool = False) -> DataFrame:
    """``tp, fp, fn`` of each image (column ``tile_id`` of ``images``); a pair matches at IoU >= ``threshold``.

    Below 0.5 an object may match several and counts go wrong; ``single`` lets each match once.
    """
    pairs = overlaps(targets, predictions) if pairs is None else pairs
    pairs = pairs.where(F.col("iou") >= threshold)
    tp = (one_to_one(pairs) if single else pairs).groupBy(TILE).agg(F.count("*").alias("tp"))
    n = lambda df, name: df.groupBy(TILE).agg(F.count_distinct("region_id").alias(name))
    joined = images.select(TILE).distinct().join(tp, TILE, "left").join(n(targets, "nt"), TILE, "left").join(n(predictions, "np"), TILE, "left").na.fill(0)
    return joined.select(TILE, "tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("nt") - F.col("tp")).alias("fn"))


def instance_metrics(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    b2 = beta * beta
    return counts.withColumns({"precision": div(tp, tp + fp), "recall": div(tp, tp + fn), "accuracy": div(tp, tp + fp + fn), "fbeta": div(tp * (1 + b2), tp * (1 + b2) + fn * b2 + fp)})


def instance_confusion(counts: DataFrame, normalise: bool = True) -> DataFrame:
    """Totals of tp, fp, fn (tn is 0), as shares of their sum if asked for."""
    total = counts.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") if normalise else F.lit(1)
    return total.select(*(F.coalesce(F.try_divide(F.col(c), n), F.lit(0.0)).alias(c) for c in ("tp", "fp", "fn")), F.lit(0.0).alias("tn"))


def instance_curve(pixels: DataFrame, target: str, score: str, thresholds: Sequence[float], matching: float = 0.5, ignore: int = 2) -> DataFrame:
    """``threshold, precision, recall`` of instances; ignored cells are taken out of both first.

    Predictions of all thresholds are labelled at once: a tile and a threshold together are a tile.
    """
    valid = pixels.where(F.col(target) != ignore)
    targets = label(valid.withColumn("_m", F.col(target) == 1), "_m")
    levels = F.array(*(F.lit(float(v)) for v in thresholds))
    reached = valid.select(TILE, "y", "x", F.explode(F.filter(levels, lambda v: F.coalesce(F.col(score), F.lit(0.0)) >= v)).alias("threshold"))
    both = F.struct(F.col(TILE).alias("tile"), "threshold")
    found = label(reached.select(both.alias(TILE), "y", "x", F.lit(True).alias("_m")), "_m")
    found = found.select(F.col(f"{TILE}.tile").alias(TILE), F.col(f"{TILE}.threshold").alias("threshold"), "y", "x", F.col("region_id").alias("p"))
    t = targets.select(TILE, "y", "x", F.col("region_id").alias("t"))
    inter = t.join(found, [TILE, "y", "x"]).groupBy("threshold", TILE, "t", "p").agg(F.count("*").alias("inter"))
    nt = t.groupBy(TILE, "t").agg(F.count("*").alias("nt"))
    np_ = found.groupBy("threshold", TILE, "p").agg(F.count("*").alias("np"))
    iou = F.col("inter") / (F.col("nt") + F.col("np") - F.col("inter"))
    tp = inter.join(nt, [TILE, "t"]).join(np_, ["threshold", TILE, "p"]).where(iou >= matching).groupBy("threshold").agg(F.count("*").alias("tp"))
    n = np_.groupBy("threshold").agg(F.count("*").alias("n_p"))
    every = pixels.sparkSession.createDataFrame([(float(v),) for v in thresholds], "threshold double")
    total = nt.agg(F.count("*").alias("n_t"))  # one row
    joined = every.join(tp, "threshold", "left").join(n, "threshold", "left").na.fill(0).join(F.broadcast(total))
    counts = joined.select("threshold", "tp", (F.col("n_p") - F.col("tp")).alias("fp"), (F.col("n_t") - F.col("tp")).alias("fn"))
    return instance_metrics(counts).select("threshold", "precision", "recall")


def instance_average_precision(curve: DataFrame) -> DataFrame:
    """``average_precision`` of an instance curve: precision times the gain of recall, from the highest threshold down."""
    down = Window.orderBy(F.col("threshold").desc())  # as many rows as thresholds
    gain = F.col("recall") - F.coalesce(F.lag("recall").over(down), F.lit(0.0))
    return curve.withColumn("_g", gain * F.col("precision")).agg(F.sum("_g").alias("average_precision"))


def boundary_iou(pixels: DataFrame, target: Column, predicted: Column, keep: Column, width: int, height: int, ratio: float | int = 0.02, by: Sequence[str] = (TILE,)) -> DataFrame:
    """IoU of the outlines of both masks; cells that are not kept are outside of both."""
    both = pixels.withColumns({"_t": target & keep, "_p": predicted & keep, "_keep": keep})
    t = boundary(both, "_t", width, height, ratio).withColumnRenamed("boundary", "_bt")
    p = boundary(t, "_p", width, height, ratio).where("_keep")
    inter, union = F.sum((F.col("_bt") & F.col("boundary")).cast("long")), F.sum((F.col("_bt") | F.col("boundary")).cast("long"))
    return p.groupBy(*by).agg(F.coalesce(F.try_divide(inter, union), F.lit(0.0)).alias("boundary_iou"))


def eroded_instances(labels: DataFrame, steps: int) -> DataFrame:
    """Cells of instances all of whose neighbours within ``steps`` rows and columns are of the same instance.

    Runs of a row are shortened by ``steps`` at both ends, then runs of what is left in a column: two windows over the
    cells, whatever the width.
    """

    def shortened(cells: DataFrame, along: str, across: str) -> DataFrame:
        line = [TILE, "region_id", across]
        grouped = cells.withColumn("_g", F.col(along) - F.row_number().over(Window.partitionBy(*line).orderBy(along)))
        run = Window.partitionBy(*line, "_g")
        near = (F.col(along) - F.min(along).over(run) >= steps) & (F.max(along).over(run) - F.col(along) >= steps)
        return grouped.withColumn("_near", near).where("_near").drop("_g", "_near")

    return shortened(shortened(labels.select(TILE, "region_id", "y", "x"), "x", "y"), "y", "x")


def instance_boundary_iou(targets: DataFrame, predictions: DataFrame, steps: int = 1, ratio: float | None = None, width: int = 0, height: int = 0) -> DataFrame:
    """``t, p, iou`` of the outlines of single instances: cells of an instance with a cell outside it within ``steps``.

    With a ``ratio`` the steps are that share of the diagonal of ``width`` x ``height`` cells (half-even, at least 1).
    """
    if ratio is not None:
        steps = max(1, round(ratio * (width * width + height * height) ** 0.5))
    outline = lambda labels: labels.join(eroded_instances(labels, steps), [TILE, "region_id", "y", "x"], "left_anti")
    return overlaps(outline(targets), outline(predictions)).select(TILE, "t", "p", "iou")
