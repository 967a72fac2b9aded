"""The pyspark.ml classes: in pipelines, saved and read back, in cross-validation."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tillcast.operators import encoders as E
from tillcast.operators import splits as V
from tillcast.operators import windows as W
from tillcast.plans.ml import BoostedTrees, BoostedTreesModel, PanelFeatures, PanelPreprocessor
from tillcast.sources.tables import store_panel

SF = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(repr(round(v, 9)) if isinstance(v, float) else repr(v) for v in r) for r in df.select(*cols).collect()), cols


def test_pipeline_saved_and_loaded_equals_preprocess(spark, tmp_path):
    panel = store_panel(spark, SF, materialize=True)
    train, _ = V.time_split(panel, 3)
    model = Pipeline(stages=[PanelFeatures(), PanelPreprocessor(smoothing=5.0)]).fit(train)
    plain = E.fit_preprocessor(W.panel_features(train), smoothing=5.0).transform(W.panel_features(panel))
    assert rows(model.transform(panel)) == rows(plain)
    model.write().overwrite().save(f"{tmp_path}/pipeline")
    other = spark.newSession()
    again = PipelineModel.load(f"{tmp_path}/pipeline")
    assert [type(s).__name__ for s in again.stages] == ["PanelFeatures", "PanelPreprocessorModel"]
    assert again.stages[1].getOrDefault("smoothing") == 5.0 and again.stages[1].uid == model.stages[1].uid
    assert rows(again.transform(panel)) == rows(plain)
    assert other.sparkContext is spark.sparkContext
    Pipeline(stages=[PanelFeatures(targetCol="Customers"), PanelPreprocessor()]).write().overwrite().save(f"{tmp_path}/unfitted")
    assert Pipeline.load(f"{tmp_path}/unfitted").getStages()[0].getOrDefault("targetCol") == "Customers"


def test_boosted_trees_in_cross_validation(spark, tmp_path):
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 2))
    df = spark.createDataFrame([(float(a), float(b), float(4 * a + (b > 0))) for a, b in x], "a double, b double, y double")
    est = BoostedTrees(featureCols=["a", "b"], trees=4, depth=2, lr=0.5)
    grid = ParamGridBuilder().addGrid(est.trees, [1, 6]).build()
    found = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=2, seed=1).fit(df)
    assert found.avgMetrics[1] < found.avgMetrics[0] and found.bestModel.getOrDefault("trees") == 6
    found.bestModel.write().overwrite().save(f"{tmp_path}/trees")
    again = BoostedTreesModel.load(f"{tmp_path}/trees")
    both = again.transform(df).withColumnRenamed("prediction", "p").transform(found.bestModel.transform)
    assert both.filter(F.col("p") != F.col("prediction")).count() == 0
