"""Training data flow: panel -> features -> temporal split -> fitted
preprocessing -> median fill -> model-ready (features, y) frames.

Each step is a DataFrame transformation; the two outputs are written to
the checkpoint folder once because every model, fold and replica reads
them again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import encoders as E
from tillcast.operators import filters as B
from tillcast.operators import splits as V
from tillcast.operators import windows as W
from tillcast.session import cut_lineage

# The 29 model inputs of the composed flow: panel columns left after
# dropping leakage (Sales, Customers), the closed flag and the date, plus
# window features, interactions, date parts and the two encodings.
FEATURES = [
    "Store", "DayOfWeek", "Promo", "StateHoliday", "SchoolHoliday", "CompetitionDistance", "Promo2",
    "lag_7", "lag_14", "lag_30", "rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30",
    "trend_slope_30d", "Promo_x_SchoolHoliday", "sales_momentum",
    "Year", "Month", "WeekOfYear", "DayOfMonth", "IsWeekend", "Quarter",
    "Month_sin", "Month_cos", "Week_sin", "Week_cos",
    "StoreType_encoded", "Assortment_encoded",
]
KEYS = ["key_store", "key_date"]


@dataclass
class ModelData:
    train: DataFrame      # KEYS + FEATURES + y, open training rows
    test: DataFrame       # same columns, open test rows
    preprocessor: E.Preprocessor
    medians: dict         # training median per feature


def model_frames(panel: DataFrame, test_months: int = 3, materialize: bool = True) -> ModelData:
    """Build train/test model frames from a raw panel (features on all rows,
    closed days dropped after the features, fit on training rows only)."""
    feats = W.panel_features(panel)
    feats = feats.withColumns({"key_store": F.col("Store"), "key_date": F.col("Date")})
    if materialize:
        # written once: the split, every fitted step and both transforms read it
        feats = cut_lineage(feats)
    train_raw, test_raw = V.time_split(feats, test_months)
    pre = E.fit_preprocessor(train_raw)

    def prep(df):
        out = pre.transform(df.drop("Customers"))
        return out.withColumnRenamed("Sales", "y").select(*KEYS, *[F.col(c).cast("double").alias(c) for c in FEATURES], "y")

    xtr, xte = prep(train_raw), prep(test_raw)
    if materialize:
        xtr = cut_lineage(xtr)   # read by the medians and by the fill
    med = B.train_medians(xtr, FEATURES)
    xtr = B.fill_with(xtr, med, FEATURES)
    xte = B.fill_with(xte, med, FEATURES)
    if materialize:
        xtr, xte = cut_lineage(xtr), cut_lineage(xte)
    return ModelData(xtr, xte, pre, med)
