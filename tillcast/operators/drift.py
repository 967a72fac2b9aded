"""Drift statistics (M1-M4, M6, M7): PSI, two-sample KS, CUSUM.

All features are handled in one plan: the reference and current frames
become one frame labelled by side, and every statistic is a grouped
aggregate keyed by feature. Breakpoints and empirical CDFs come from
``ranks`` (exact, with no feature's distinct values held in one task). CUSUM folds over per-entity batch summaries, whose count is bounded
by the number of batches, never by rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.ranks import VALUES_PER_BRACKET, cumulative_counts, select_quantiles
from tillcast.session import cut_lineage
from tillcast.sizing import broadcast_checked

STATES = [T.StructField("mean_residual", T.DoubleType()), T.StructField("std_residual", T.DoubleType()),
          T.StructField("n_samples", T.LongType()), T.StructField("cusum_pos", T.DoubleType()),
          T.StructField("cusum_neg", T.DoubleType()), T.StructField("alert", T.StringType()),
          T.StructField("alert_value", T.DoubleType())]
SKIPPED = "SKIPPED"
PSI_CRITICAL = 0.25
PSI_WARNING = 0.10


def labelled(df: DataFrame, is_reference, features) -> DataFrame:
    """(side, features ...) from ONE frame whose rows are labelled by a
    predicate (e.g. a date split): a single scan instead of two."""
    return df.select(F.when(is_reference, F.lit("ref")).otherwise(F.lit("cur")).alias("side"), *[F.col(c).cast("double").alias(c) for c in features])


def both_sides(reference: DataFrame, current: DataFrame | None, features) -> DataFrame:
    """The same from two frames; ``current=None``: the first one is labelled already."""
    if current is None:
        return reference
    return labelled(reference, F.lit(True), features).unionByName(labelled(current, F.lit(False), features))


def long_sides(wide: DataFrame, features) -> DataFrame:
    """(side, feature, value); nulls and NaN dropped per column."""
    return wide.unpivot(["side"], list(features), "feature", "value").where(F.col("value").isNotNull() & ~F.isnan("value"))


def side_value_counts(reference: DataFrame, current: DataFrame | None, features) -> DataFrame:
    """(feature, value, c_ref, c_cur): one row per distinct value of each feature.

    This single aggregate (partial-aggregated map-side) is the only pass
    over the input rows; KS works from it (``current=None``: the first
    argument is already a ``labelled`` frame). Two branches read it, so it is
    written once to the checkpoint folder.
    """
    long = long_sides(both_sides(reference, current, features), features)
    vc = long.groupBy("feature", "value").agg(F.count_if(F.col("side") == "ref").alias("c_ref"),
                                              F.count_if(F.col("side") == "cur").alias("c_cur"))
    return cut_lineage(vc)


def _sizes(vc: DataFrame, features) -> DataFrame:
    """(feature, n_ref, n_cur) of every named feature, those without any value included."""
    named = vc.sparkSession.createDataFrame([(f,) for f in features], "feature string")  # the caller's list
    s = vc.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    return named.join(s, "feature", "left").fillna(0, ["n_ref", "n_cur"])


def _enough(min_rows: int) -> F.Column:
    return (F.col("n_ref") >= min_rows) & (F.col("n_cur") >= min_rows)


def psi_status(psi) -> F.Column:
    return (F.when(psi > PSI_CRITICAL, F.lit("CRITICAL")).when(psi > PSI_WARNING, F.lit("WARNING"))
            .otherwise(F.lit("OK")))


def psi_report(reference: DataFrame, current: DataFrame | None, features, n_bins: int = 10, epsilon: float = 1e-6,
               min_rows: int = 10, open_ended: bool = False, most: int = VALUES_PER_BRACKET) -> DataFrame:
    """M1/M2: PSI per feature with its status.

    Breakpoints are the distinct exact deciles of the reference. Bins are
    half-open, the last closed; current values outside the reference range
    are dropped (``open_ended=True`` folds them into the end bins instead).
    Counts get ``epsilon`` added, are normalised per side, and
    PSI = sum((cur - ref) * ln(cur / ref)). The breakpoints come from a
    selection in passes (``select_quantiles``; ``most`` values of a bracket are
    sorted at once) and the bins are counted in one scan: no distinct values are
    shuffled or written. The input is read three times, so pass a table or a
    cheap plan. A single distinct breakpoint gives PSI 0. Features with fewer than ``min_rows`` non-null values on
    either side are reported with status ``SKIPPED`` and no PSI.
    """
    wide = both_sides(reference, current, features)
    long = long_sides(wide, features)
    nf = len(features)  # tables keyed by feature hold at most this many rows
    is_ref = F.col("side") == "ref"
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = cut_lineage(select_quantiles(wide.where(is_ref), features, probs, most).withColumnRenamed("column", "feature"))
    bp = q.groupBy("feature").agg(F.array_distinct(F.array_sort(F.collect_list("q"))).alias("bp"))  # <= n_bins+1 each
    nb = F.size("bp")
    v = F.col("value")
    first, last = F.col("bp")[0], F.element_at("bp", -1)
    # number of breakpoints <= v, minus one; unrolled over the at most
    # n_bins + 1 breakpoints so it stays inside whole-stage codegen
    inner = sum((F.when(nb > i, (F.col("bp")[i] <= v).cast("int")).otherwise(F.lit(0)) for i in range(n_bins + 1)),
                F.lit(0)) - 1
    if open_ended:
        bin_ = F.when(nb < 2, None).when(v < first, 0).when(v >= last, nb - 2).otherwise(inner)
    else:
        bin_ = (F.when(nb < 2, None).when((v < first) | (v > last), None)
                .when(v == last, nb - 2).otherwise(inner))
    # one scan: rows per feature and bin, those outside all bins (null) for the sizes only
    binned = cut_lineage(long.join(broadcast_checked(bp, known_rows=nf), "feature", "left").select("feature", bin_.alias("bin"), "side")
                         .groupBy("feature", "bin").agg(F.count_if(is_ref).alias("n_r"), F.count_if(~is_ref).alias("n_u")))
    sizes = _sizes(binned.select("feature", F.col("n_r").alias("c_ref"), F.col("n_u").alias("c_cur")), features)
    grid = bp.where(nb >= 2).select("feature", F.explode(F.sequence(F.lit(0), nb - 2)).alias("bin"))
    c = (grid.join(binned, ["feature", "bin"], "left")
         .select("feature", "bin",
                 (F.coalesce(F.col("n_r"), F.lit(0)).cast("double") + F.lit(epsilon)).alias("r"),
                 (F.coalesce(F.col("n_u"), F.lit(0)).cast("double") + F.lit(epsilon)).alias("u")))
    per = Window.partitionBy("feature")  # bins of one feature: at most n_bins rows
    pct = c.select("feature", (F.col("r") / F.sum("r").over(per)).alias("r"), (F.col("u") / F.sum("u").over(per)).alias("u"))
    psi = pct.groupBy("feature").agg(F.sum((F.col("u") - F.col("r")) * F.log(F.col("u") / F.col("r"))).alias("psi"))
    out = sizes.join(psi, "feature", "left").select("feature", F.when(_enough(min_rows), F.coalesce("psi", F.lit(0.0))).alias("PSI"))
    status = F.when(F.col("PSI").isNull(), F.lit(SKIPPED)).otherwise(psi_status(F.col("PSI")))
    return out.withColumn("status", status).orderBy(F.desc("PSI"), "feature")  # one row per feature


def _kolmogorov_sf(lam) -> F.Column:
    """Q(l) = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 l^2), 100 terms; 1 for l < 0.2."""
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, k: acc + F.lit(2.0) * F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
                         * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


EXACT_PAIRS = 10_000  # n * m up to which the p-value is exact


def exact_ks_p(d, n, m) -> F.Column:
    """P(D >= d) of two samples of ``n`` and ``m`` values without ties: one minus the share of the lattice paths
    from (0, 0) to (n, m) that stay inside |i/n - j/m| < d, row by row (an array aggregate of n * m steps)."""
    n, m = n.cast("long"), m.cast("long")
    reach = F.round(d * n * m).cast("long")
    empty, zero = F.array().cast("array<double>"), F.lit(0).cast("long")

    def row(before, i):
        def cell(done, j):
            below = F.when(i > 0, F.get(before, j.cast("int")) * i / (i + j)).otherwise(F.lit(0.0))
            left = F.when(j > 0, F.get(done, (j - 1).cast("int")) * j / (i + j)).otherwise(F.lit(0.0))
            share = F.when((i == 0) & (j == 0), F.lit(1.0)).when(F.abs(i * m - j * n) < reach, below + left).otherwise(F.lit(0.0))
            return F.concat(done, F.array(share))
        return F.aggregate(F.sequence(zero, m), empty, cell)

    return F.greatest(F.lit(0.0), F.lit(1.0) - F.element_at(F.aggregate(F.sequence(zero, n), empty, row), -1))


def ks_report(reference: DataFrame, current: DataFrame | None, features, alpha: float = 0.05, min_rows: int = 10,
              buckets: int | None = None) -> DataFrame:
    """M3: two-sample KS statistic D = max |F_ref - F_cur| over the pooled values.

    Counts per (feature, value) first; the empirical CDFs come from exact
    distributed cumulative counts. The p-value is exact (no ties assumed) up
    to n * m = ``EXACT_PAIRS`` and beyond it that of the asymptotic
    Kolmogorov distribution at sqrt(n m / (n + m)) * D. Features with fewer than ``min_rows`` non-null values on either side are reported
    with their sizes and no statistic.
    """
    vc = side_value_counts(reference, current, features)
    sizes = _sizes(vc, features)
    nf = len(features)
    cum = cumulative_counts(vc, "feature", "value", ["c_ref", "c_cur"], buckets, n_groups=nf)
    d = (cum.join(broadcast_checked(sizes.where(_enough(min_rows)), known_rows=nf), "feature").groupBy("feature")
         .agg(F.max(F.abs(F.col("cum_c_ref") / F.col("n_ref") - F.col("cum_c_cur") / F.col("n_cur"))).alias("KS_stat")))
    d = sizes.join(d, "feature", "left")
    n_r, n_c = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    en = F.sqrt(n_r * n_c / (n_r + n_c))
    few = F.col("n_ref") * F.col("n_cur") <= EXACT_PAIRS
    p = F.when(few, exact_ks_p(F.col("KS_stat"), F.col("n_ref"), F.col("n_cur"))).otherwise(_kolmogorov_sf(en * F.col("KS_stat")))
    d = d.withColumn("p_value", F.when(F.col("KS_stat").isNotNull(), p))
    return d.withColumn("drift", F.col("p_value") < alpha).orderBy(F.desc("KS_stat"), "feature")


# ---------------------------------------------------------------- CUSUM
def residual_batches(df: DataFrame, entity: str, batch, residual) -> DataFrame:
    """Batch summaries: mean, population std and size of the residual per (entity, batch)."""
    return df.groupBy(F.col(entity).alias("entity"), batch.alias("batch")).agg(
        F.avg(residual).alias("mean_residual"), F.stddev_pop(residual).alias("std_residual"),
        F.count(residual).alias("n_samples"))


def last_states(states: DataFrame) -> DataFrame:
    """(entity, cusum_pos, cusum_neg) after each entity's last batch: where a later fold, in batch or as a stream, goes on."""
    return states.groupBy("entity").agg(F.max_by(F.struct("cusum_pos", "cusum_neg"), "batch").alias("s")).select(
        "entity", F.col("s.cusum_pos").alias("cusum_pos"), F.col("s.cusum_neg").alias("cusum_neg"))


def cusum(batches: DataFrame, threshold: float = 5.0, k_factor: float = 0.5, initial: DataFrame | None = None) -> DataFrame:
    """M4: sequential two-sided CUSUM per entity over its batches in order.

    k = k_factor * std of the batch. pos = max(0, pos + mean - k),
    neg = max(0, neg - mean - k); the positive side is checked first and
    only the side that fired resets. Output per batch: the sums after the
    update (after reset), the alert type and the sum that fired.

    The sums depend on every earlier batch of the entity, so an entity's
    batch summaries (one row per batch, never per input row) are folded in
    order by one loop over numpy arrays. ``initial`` (``last_states``) gives the
    sums to start from; entities that are not in it start at zero.
    """
    batch_type = batches.schema["batch"].dataType
    schema = T.StructType([T.StructField("entity", batches.schema["entity"].dataType), T.StructField("batch", batch_type), *STATES])

    def fold(pdf):
        pdf = pdf.sort_values("batch", kind="stable")
        mean, std = pdf["mean_residual"].to_numpy(dtype=float), pdf["std_residual"].to_numpy(dtype=float)
        up, down = np.zeros(len(pdf)), np.zeros(len(pdf))
        alert, value = [None] * len(pdf), np.full(len(pdf), np.nan)
        pos, neg = float(pdf["start_pos"].iloc[0]), float(pdf["start_neg"].iloc[0])
        for i in range(len(pdf)):
            k = k_factor * std[i]
            pos, neg = max(0.0, pos + mean[i] - k), max(0.0, neg - mean[i] - k)
            if pos > threshold:
                alert[i], value[i], pos = "POSITIVE_DRIFT", pos, 0.0
            elif neg > threshold:
                alert[i], value[i], neg = "NEGATIVE_DRIFT", neg, 0.0
            up[i], down[i] = pos, neg
        return pdf.assign(cusum_pos=up, cusum_neg=down, alert=alert, alert_value=value)[[f.name for f in schema.fields]]

    out = batches.select("entity", "batch", "mean_residual", "std_residual", F.col("n_samples").cast("long").alias("n_samples"))
    if initial is None:
        out = out.withColumns({"start_pos": F.lit(0.0), "start_neg": F.lit(0.0)})
    else:
        start = initial.select("entity", F.col("cusum_pos").alias("start_pos"), F.col("cusum_neg").alias("start_neg"))
        out = out.join(start, "entity", "left").fillna(0.0, ["start_pos", "start_neg"])
    out = out.groupBy("entity").applyInPandas(fold, schema)
    return out.withColumn("alert_value", F.when(F.col("alert").isNotNull(), F.col("alert_value")))


def monitor_summary(states: DataFrame, drift_window: int = 7) -> DataFrame:
    """M6: per entity, batch count, mean of batch means, mean of the last
    ``drift_window`` batch means, alert count and the last alert."""
    w = Window.partitionBy("entity").orderBy(F.col("batch").desc())
    ranked = states.withColumn("__rk", F.row_number().over(w))
    return ranked.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.avg("mean_residual").alias("overall_mean_residual"),
        F.avg(F.when(F.col("__rk") <= drift_window, F.col("mean_residual"))).alias("recent_mean_residual"),
        F.count("alert").alias("total_alerts"),
        F.max_by(F.when(F.col("alert").isNotNull(), F.col("alert")),
                 F.when(F.col("alert").isNotNull(), F.col("batch"))).alias("last_alert_type"),
        F.max(F.when(F.col("alert").isNotNull(), F.col("batch"))).alias("last_alert_batch"))


def residual_monthly(df: DataFrame, date: str, residual, limit: float = 500.0) -> DataFrame:
    """M7: mean residual per month and a flag when its magnitude exceeds ``limit``."""
    m = df.groupBy(F.trunc(date, "month").alias("month")).agg(F.avg(residual).alias("mean_residual"))
    return m.withColumn("flagged", F.abs(F.col("mean_residual")) > F.lit(limit))
