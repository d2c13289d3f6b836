"""Peaks of coverage over a local background: Poisson tails and false discovery rates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..sources.scratch import written
from .intervals import SEGMENT, coverage_steps, union_components

#: Scores are rounded to so many digits and cut at this value, so there are at most 100,001 different ones.
DIGITS, MOST = 2, 1000.0


def local_background(steps: DataFrame, keys: list[str], widths: tuple[int, ...], least: float, segment_width: int = SEGMENT) -> DataFrame:
    """Steps of coverage (keys, start, end, depth) with ``background``: the greatest of ``least`` and, for each width, the bases of the steps that begin within half of it of this step's begin, a base.

    Steps, whose begins differ, are dealt by segments of a chromosome, which bounds a segment's rows; steps near a segment's border are also in the next one, where they only count.
    Sums are differences of running sums, so a step costs the same whatever the widths are.
    """
    halo = max(widths) // 2
    width = max(segment_width, 8 * halo + 1)
    at = lambda shift: F.floor((F.col("start") + shift) / width)
    d = steps.withColumn("_home", at(0)).withColumn("_segment", F.explode(F.sequence(at(-halo), at(halo))))

    def around(t: pa.Table) -> pa.Table:
        t = t.sort_by("start")
        start = t.column("start").to_numpy()
        mass = t.column("depth").to_numpy() * (t.column("end").to_numpy() - start)
        before = np.concatenate([np.zeros(1, mass.dtype), np.cumsum(mass)])
        near = [(before[np.searchsorted(start, start + w // 2, "right")] - before[np.searchsorted(start, start - w // 2)]) / float(w) for w in widths]
        t = t.append_column("background", pa.array(np.maximum.reduce([np.full(len(start), float(least)), *near])))
        return t.filter(pc.equal(t.column("_home"), t.column("_segment"))).drop_columns(["_home", "_segment"])

    return d.groupBy(*keys, "_segment").applyInArrow(around, StructType([*steps.schema.fields, StructField("background", DoubleType())]))


def tail_scores(depth: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """-log10 of the Poisson probability of ``depth`` or more at ``rate`` > 0."""
    k, rate = np.asarray(depth, np.float64), np.asarray(rate, np.float64)

    def term(n: np.ndarray) -> np.ndarray:
        depths, which = np.unique(n, return_inverse=True)
        return -rate + n * np.log(rate) - np.array([math.lgamma(x + 1) for x in depths.tolist()])[which]

    above = k + 1 > rate
    # Far terms grow or shrink by a factor each: sums from the largest term on, upwards above the rate, downwards below it.
    total, factor, step = np.ones(len(k)), np.ones(len(k)), 0
    down = np.maximum(k - 1, 0)
    open_ = np.arange(len(k))
    while len(open_):
        step += 1
        factor = factor * np.where(above[open_], rate[open_] / (k[open_] + step), np.maximum(down[open_] - step + 1, 0) / rate[open_])
        total[open_] += factor
        still = factor > 1e-17 * total[open_]
        open_, factor = open_[still], factor[still]
    upper = (term(k) + np.log(total)) / math.log(10)
    below = np.where(k > 0, np.exp(np.minimum(term(down) + np.log(total), 0)), 0.0)
    lower = np.log10(np.maximum(1 - below, 1e-300))
    return np.maximum(-np.where(above, upper, lower), 0.0)


def scored_steps(steps: DataFrame) -> DataFrame:
    """Steps with ``score``, -log10 of the chance of their depth over their background, and ``q_score``, -log10 of the least false discovery rate at which they are found.

    Every base is a test.  Ranks come from bases summed per score, a table of bounded size (see ``DIGITS``).
    """

    @F.pandas_udf("double")
    def score(depth: pd.Series, rate: pd.Series) -> pd.Series:
        return pd.Series(np.round(np.minimum(tail_scores(depth.to_numpy(), rate.to_numpy()), MOST), DIGITS) + 0.0)  # no negative zero

    t = written(steps.withColumn("score", score(F.col("depth"), F.col("background"))), "scores")
    each = t.groupBy("score").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))
    ranked = each.withColumn("rank", F.sum("bases").over(W.orderBy(F.desc("score")))).withColumn("all", F.sum("bases").over(W.partitionBy()))
    log_q = F.col("score") + F.log10("rank") - F.log10("all")
    ranked = ranked.withColumn("q_score", F.greatest(F.max(log_q).over(W.orderBy("score").rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0.0)))
    return t.join(F.broadcast(ranked.select("score", "q_score")), "score")  # at most 100,001 rows


def call_peaks(fragments: DataFrame, keys: list[str], genome_size: int, widths: tuple[int, ...] = (1000, 5000, 10_000), cutoff: float = 1.3, gap: int = 30, least_length: int = 50, segment_width: int = SEGMENT) -> DataFrame:
    """Peaks: keys, start, end, depth and summit (the first place of the greatest depth), score and q_score of the best step.

    Steps of coverage with a ``q_score`` of ``cutoff`` or more are joined over gaps of up to ``gap`` bases; peaks shorter than ``least_length`` go.
    """
    steps = written(coverage_steps(fragments, keys, segment_width=segment_width), "steps")
    mass = steps.agg(F.sum(F.col("depth") * (F.col("end") - F.col("start")))).first()[0] or 0
    scored = scored_steps(local_background(steps, keys, widths, max(mass / genome_size, 1e-9), segment_width))
    good = written(scored.where(F.col("q_score") >= cutoff), "good")  # components read their rows several times
    good = union_components(good, keys, ["end"], gap, segment_width=segment_width)
    peaks = good.groupBy(*keys, "component").agg(F.min("start").alias("first"), F.max("end").alias("last"), F.max("depth").alias("depth"), F.min_by("start", F.struct(-F.col("depth"), "start")).alias("summit"), F.max("score").alias("score"), F.max("q_score").alias("q_score"))
    return peaks.where(F.col("last") - F.col("first") >= least_length).select(*keys, F.col("first").alias("start"), F.col("last").alias("end"), "depth", "summit", "score", "q_score")
