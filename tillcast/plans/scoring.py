"""Batch scoring flow: validated requests -> request-day features ->
fitted preprocessing -> bootstrap interval + tiered routing -> response rows.

``fit_scorer`` trains every artifact from a history panel (preprocessing,
training medians, fast ridge, accurate boosted trees, bootstrap replicas
and the routing threshold). ``Scorer.score`` is then one plan per request
table: no per-request loop and no batch-size cap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import filters as B
from tillcast.operators import regression as R
from tillcast.operators import scoring as P
from tillcast.operators import uncertainty as U
from tillcast.plans.training import FEATURES, ModelData, model_frames

FAST_LABEL, ACCURATE_LABEL = "fast (ridge)", "accurate (gbt)"


@dataclass
class Scorer:
    history: DataFrame
    data: ModelData
    fast: R.Fitted | None
    accurate: R.Fitted | None
    ensemble: U.Ensemble
    threshold: float

    def features(self, requests: DataFrame) -> DataFrame:
        """P4 + P5: the 29 model inputs per valid request, ``used_fallback`` for unknown stores."""
        return request_features(requests, self.history, self.data)

    def score(self, requests: DataFrame) -> DataFrame:
        """Prediction (clamped at 0), ensemble interval, uncertainty and model used.

        With both models the uncertainty routes; with one of them every request
        gets that one (the accurate one if it is there); without any it is an error.
        """
        if self.fast is None and self.accurate is None:
            raise ValueError("the scorer has no model")
        x = self.features(requests)
        for model, name in ((self.fast, "p_fast"), (self.accurate, "p_accurate")):
            x = model.predict(x, name) if model is not None else x.withColumn(name, F.lit(None).cast("double"))
        x = U.interval(self.ensemble.predictions(x))
        if self.fast is not None and self.accurate is not None:
            x = U.route(x, self.threshold)
        else:
            x = x.withColumns({"use_accurate": F.lit(self.accurate is not None),
                               "prediction": F.coalesce("p_accurate", "p_fast")})
        return x.select("request_id", "store_id", "date",
                        F.greatest(F.lit(0.0), F.col("prediction")).alias("predicted_sales"),
                        F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"),
                        F.col("std_pred").alias("uncertainty"),
                        F.when(F.col("use_accurate"), F.lit(ACCURATE_LABEL)).otherwise(F.lit(FAST_LABEL)).alias("model_used"),
                        "used_fallback")


def request_features(requests: DataFrame, history: DataFrame, data: ModelData, as_of: bool = False) -> DataFrame:
    """P4 + P5 without any model: valid requests -> request-day window
    features -> fitted preprocessing -> training-median fill; unknown stores
    get the training-median vector and ``used_fallback``."""
    valid = P.validate_requests(requests).where("valid")
    rp = P.request_to_panel(valid)
    known = P.request_window_features(rp, history, as_of=as_of)
    x = data.preprocessor.transform(known.drop("latest", "m", "hmin", "hmax", "proxy"))
    x = B.fill_with(x.select("request_id", *[F.col(c).cast("double").alias(c) for c in FEATURES]),
                    data.medians, FEATURES)
    x = x.withColumn("used_fallback", F.lit(False))
    unknown = valid.join(known.select("request_id"), "request_id", "left_anti") if as_of \
        else P.unknown_store(valid, history)
    unknown = P.fallback_rows(unknown, data.medians, FEATURES)
    out = x.unionByName(unknown)
    return out.join(valid.select("request_id", "store_id", "date"), "request_id")


def fit_scorer(history: DataFrame, n_boot: int = 30, percentile: float = 80.0,
               accurate_spec: dict | None = None) -> Scorer:
    md = model_frames(history)
    fast = R.fit(md.train, FEATURES, R.MODEL_SPECS["Ridge (L2)"])
    accurate = R.fit(md.train, FEATURES, accurate_spec or R.ACCURATE_SPEC)
    ens = U.bootstrap_fit(md.train, FEATURES, n_boot)
    # routing threshold from a held-out slice (the test split)
    std = U.interval(ens.predictions(md.test))
    thr = U.fit_threshold(std, "std_pred", percentile)
    return Scorer(history, md, fast, accurate, ens, thr)
