"""Estimators and transformers of ``pyspark.ml`` around the fitted objects, for ``Pipeline`` and ``CrossValidator``.

``PanelFeatures`` adds the window features (W8), ``PanelPreprocessor`` fits the
leakage-safe preprocessing (E1-E7) and ``BoostedTrees`` the histogram
booster (L5). Fitted models are written with ``write().save(path)`` and
read back in any session; their tables are Parquet beside the metadata.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import boosting, encoders as E
from tillcast.operators import windows as W
from tillcast.sources import sinks


class _Writer(MLWriter):
    """Metadata of the parameters, then what the model adds."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        self.model._save_state(spark, path)


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._load_state(spark, path)
        return model


class _Saved(MLWritable, MLReadable):
    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class PanelFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Lags, rolling statistics, trend and interactions of a panel."""

    targetCol = Param(Params._dummy(), "targetCol", "measure that the features look back on", TypeConverters.toString)
    entityCol = Param(Params._dummy(), "entityCol", "entity of the panel", TypeConverters.toString)
    dateCol = Param(Params._dummy(), "dateCol", "day of the panel", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, targetCol: str = "Sales", entityCol: str = "Store", dateCol: str = "Date"):
        super().__init__()
        self._setDefault(targetCol="Sales", entityCol="Store", dateCol="Date")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return W.panel_features(dataset, target=get(self.targetCol), entity=get(self.entityCol), date=get(self.dateCol))


class _PreprocessorParams(Params):
    targetCol = Param(Params._dummy(), "targetCol", "target whose means encode the levels", TypeConverters.toString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns to encode", TypeConverters.toListString)
    smoothing = Param(Params._dummy(), "smoothing", "rows' worth of the global mean in a level's encoding", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(targetCol="Sales", categoricalCols=["StoreType", "Assortment"], smoothing=10.0)


class PanelPreprocessor(Estimator, _PreprocessorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Closed days out, date features, holiday flag, group medians, target encoding (E1-E7), fitted on the given rows."""

    @keyword_only
    def __init__(self, *, targetCol: str = "Sales", categoricalCols: list[str] | None = None, smoothing: float = 10.0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PanelPreprocessorModel:
        get = self.getOrDefault
        fitted = E.fit_preprocessor(dataset, get(self.targetCol), get(self.categoricalCols), get(self.smoothing))
        return self._copyValues(PanelPreprocessorModel(fitted))


class PanelPreprocessorModel(Model, _PreprocessorParams, _Saved):
    def __init__(self, fitted: E.Preprocessor | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset)

    def _save_state(self, spark: SparkSession, path: str) -> None:
        imputer, encoder = self.fitted.imputer, self.fitted.encoder
        sinks.save_table(imputer.medians, f"{path}/imputer")
        for c, t in encoder.tables.items():
            sinks.save_table(t, f"{path}/encoding_{c}")
        sinks.save_params(spark, {
            "imputer": {"target": imputer.target, "group": imputer.group, "global_median": imputer.global_median, "n_levels": imputer.n_levels},
            "encoder": {"global_mean": encoder.global_mean, "suffix": encoder.suffix, "drop_source": encoder.drop_source, "n_levels": encoder.n_levels},
            "columns": list(encoder.tables), "categorical": self.fitted.categorical}, f"{path}/state")

    def _load_state(self, spark: SparkSession, path: str) -> None:
        state = sinks.load_params(spark, f"{path}/state")
        tables = {c: sinks.load_table(spark, f"{path}/encoding_{c}") for c in state["columns"]}
        self.fitted = E.Preprocessor(E.GroupMedian(medians=sinks.load_table(spark, f"{path}/imputer"), **state["imputer"]),
                                     E.TargetEncoding(tables=tables, **state["encoder"]), state["categorical"])


class _BoostedParams(HasLabelCol, HasPredictionCol, HasSeed):
    featureCols = Param(Params._dummy(), "featureCols", "numeric input columns", TypeConverters.toListString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    lr = Param(Params._dummy(), "lr", "learning rate", TypeConverters.toFloat)
    subsample = Param(Params._dummy(), "subsample", "share of rows of a tree", TypeConverters.toFloat)
    colsample = Param(Params._dummy(), "colsample", "share of columns of a tree", TypeConverters.toFloat)
    minChild = Param(Params._dummy(), "minChild", "least rows of a child", TypeConverters.toFloat)
    l1 = Param(Params._dummy(), "l1", "L1 penalty of leaves", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "L2 penalty of leaves", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="y", predictionCol="prediction", seed=42, trees=100, depth=6, lr=0.1, subsample=1.0, colsample=1.0,
                         minChild=1.0, l1=0.0, l2=1.0)

    def spec(self) -> dict:
        get = self.getOrDefault
        return {"kind": "gbt", "min_child": get(self.minChild)} | {k: get(getattr(self, k)) for k in ("trees", "depth", "lr", "subsample", "colsample", "l1", "l2")}


class BoostedTrees(Estimator, _BoostedParams, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient-boosted regression trees on histograms (``operators.boosting``)."""

    @keyword_only
    def __init__(self, *, featureCols: list[str] | None = None, labelCol: str = "y", predictionCol: str = "prediction", seed: int = 42, trees: int = 100,
                 depth: int = 6, lr: float = 0.1, subsample: float = 1.0, colsample: float = 1.0, minChild: float = 1.0, l1: float = 0.0, l2: float = 1.0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        get = self.getOrDefault
        model = boosting.fit_many(dataset, get(self.featureCols), get(self.labelCol), self.spec(), [F.lit(True)], get(self.seed))[0]
        return self._copyValues(BoostedTreesModel(model))


class BoostedTreesModel(Model, _BoostedParams, _Saved):
    def __init__(self, model: boosting.Trees | None = None):
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.predict(dataset, self.getOrDefault(self.predictionCol))

    def _save_state(self, spark: SparkSession, path: str) -> None:
        sinks.save_table(spark.createDataFrame(self.model.rows(), sinks.NODES), f"{path}/nodes")
        sinks.save_params(spark, {"features": self.model.features, "base": self.model.base, "shape": list(self.model.feature.shape)}, f"{path}/state")

    def _load_state(self, spark: SparkSession, path: str) -> None:
        state = sinks.load_params(spark, f"{path}/state")
        self.model = boosting.Trees.of_rows(state["features"], state["base"], tuple(state["shape"]), sinks.load_table(spark, f"{path}/nodes").collect())
