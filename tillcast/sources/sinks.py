"""Report sinks and fitted-artifact persistence (A2-A5).

Reports are written as Spark output folders (partitioned files, written
in parallel); readers accept both those folders and single files, e.g.
the one-array JSON form (``multiLine``). Fitted state is data: tables as
parquet, parameters as one-row JSON, MLlib models with their own writer.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A2: CSV report with a header (e.g. the model comparison)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3/A4: JSON-lines report (PSI report, drift alerts)."""
    df.write.mode(mode).json(path)


def read_json_report(spark: SparkSession, path: str, schema=None, form: str | None = None) -> DataFrame:
    """Read a JSON report. ``form`` is ``lines`` (what ``write_json`` writes: a record per
    line) or ``array`` (each file one array of records, possibly indented); by
    default the first character of the report tells."""
    if form is None:
        first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
        form = "array" if first and first[0]["value"].lstrip().startswith("[") else "lines"
    r = spark.read.option("multiLine", {"lines": False, "array": True}[form])
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def alerts(states: DataFrame) -> DataFrame:
    """A4: alert records from CUSUM states: type, message, timestamp and the fired sum."""
    a = states.where(F.col("alert").isNotNull())
    msg = F.format_string("Residuals drift %s: sum %.2f",
                          F.when(F.col("alert") == "POSITIVE_DRIFT", "up").otherwise("down"), F.col("alert_value"))
    return a.select("entity", F.col("alert").alias("type"), msg.alias("message"),
                    F.col("batch").cast("string").alias("timestamp"),
                    F.when(F.col("alert") == "POSITIVE_DRIFT", F.col("alert_value")).alias("cusum_pos"),
                    F.when(F.col("alert") == "NEGATIVE_DRIFT", F.col("alert_value")).alias("cusum_neg"))


def write_alerts(states: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_json(alerts(states), path, mode)


def write_alerts_stream(stream_states: DataFrame, path: str, checkpoint: str):
    """A4 streaming form: append alert records to a JSON file sink."""
    return (alerts(stream_states).writeStream.format("json").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").start())


# ---------------------------------------------------------------- A5 fitted artifacts
def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """One-row JSON of scalar/array parameters (scaler moments, medians, threshold)."""
    spark.createDataFrame([(json.dumps(params),)], "params string").write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


NODES = "tree int, node int, feature int, threshold double, value double, gain double"


def _save_model(model, path: str) -> dict | None:
    """Description of a fitted model; the nodes of boosted trees are a table next to it."""
    if model is None:
        return None
    if hasattr(model.model, "raw"):
        return {"kind": model.kind, "features": model.features, "label": model.label, "linear": asdict(model.model)}
    if model.kind != "gbt":
        raise ValueError(f"no writer for a model of kind {model.kind}")
    save_table(SparkSession.getActiveSession().createDataFrame(model.model.rows(), NODES), path)  # trees x nodes numbers
    return {"kind": model.kind, "features": model.features, "label": model.label, "path": path.rsplit("/", 1)[1],
            "base": model.model.base, "shape": list(model.model.feature.shape)}


def _load_model(spec: dict | None, path: str):
    from tillcast.operators.boosting import Trees
    from tillcast.operators.regression import Fitted, Linear
    if spec is None:
        return None
    if "linear" in spec:
        model = Linear(**spec["linear"])
    else:
        nodes = load_table(SparkSession.getActiveSession(), f"{path}/{spec['path']}").collect()
        model = Trees.of_rows(spec["features"], spec["base"], tuple(spec["shape"]), nodes)
    return Fitted(spec["kind"], spec["features"], None, model, spec["label"])


def save_scorer(scorer, path: str) -> None:
    """Persist every fitted artifact of a ``plans.scoring.Scorer``, and the history
    its features look back on."""
    spark = scorer.history.sparkSession
    pre = scorer.data.preprocessor
    save_table(scorer.history, f"{path}/history")
    save_table(pre.imputer.medians, f"{path}/imputer_medians")
    for c, t in pre.encoder.tables.items():
        save_table(t, f"{path}/encoding_{c}")
    ens = scorer.ensemble
    save_params(spark, {
        "imputer": {"target": pre.imputer.target, "group": pre.imputer.group, "global_median": pre.imputer.global_median,
                    "n_levels": pre.imputer.n_levels},
        "encoder": {"cols": list(pre.encoder.tables), "global_mean": pre.encoder.global_mean, "suffix": pre.encoder.suffix,
                    "drop_source": pre.encoder.drop_source, "n_levels": pre.encoder.n_levels},
        "categorical": pre.categorical, "medians": scorer.data.medians, "threshold": scorer.threshold,
        "fast": _save_model(scorer.fast, f"{path}/fast_model"), "accurate": _save_model(scorer.accurate, f"{path}/accurate_model"),
        "ensemble": {"features": ens.features, "intercepts": ens.intercepts, "coefs": ens.coefs},
    }, f"{path}/params")


def load_scorer(spark: SparkSession, path: str):
    """The ``Scorer`` that ``save_scorer`` wrote; a model that was not saved is missing in it too."""
    from tillcast.operators.encoders import GroupMedian, Preprocessor, TargetEncoding
    from tillcast.operators.uncertainty import Ensemble
    from tillcast.plans.scoring import Scorer
    from tillcast.plans.training import ModelData
    p = load_params(spark, f"{path}/params")
    imputer = GroupMedian(medians=load_table(spark, f"{path}/imputer_medians"), **p["imputer"])
    enc = dict(p["encoder"])
    tables = {c: load_table(spark, f"{path}/encoding_{c}") for c in enc.pop("cols")}
    pre = Preprocessor(imputer, TargetEncoding(tables=tables, **enc), p["categorical"])
    return Scorer(load_table(spark, f"{path}/history"), ModelData(None, None, pre, p["medians"]),
                  _load_model(p["fast"], path), _load_model(p["accurate"], path), Ensemble(**p["ensemble"]), p["threshold"])
