"""Model registry as a table: versions, best candidate, archiving, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.operators.dedup import first_rows

METRICS = ["rmse", "r2", "mae", "accuracy", "f1_weighted", "f1"]


def version_number(c: Column) -> Column:
    """'v12' or 'v12.3' -> 12; anything else -> 0. Numbers, so v10 comes after v9."""
    return F.coalesce(F.regexp_extract(c, r"^v*(\d+)(\.|$)", 1).try_cast("long"), F.lit(0).cast("long"))


def next_versions(registry: DataFrame, target: str = "target") -> DataFrame:
    """The version the next model of every target gets."""
    top = F.max(version_number(F.col("version")))
    return registry.groupBy(target).agg(F.concat(F.lit("v"), top + 1).alias("next_version"))


def best_models(candidates: DataFrame, target: str = "target", score: str = "score",
                order: str = "id") -> DataFrame:
    """Highest score per target; the first candidate wins a tie."""
    return first_rows(candidates, [target], [F.col(score).desc_nulls_last(), F.col(order).asc()])


def archive_active(registry: DataFrame, targets: list[str] | None = None) -> DataFrame:
    """Turn the active models of the given targets (default: all) into archived ones."""
    hit = F.col("status") == "active"
    if targets is not None:
        hit = hit & F.col("target").isin(targets)
    return registry.withColumn("status", F.when(hit, "archived").otherwise(F.col("status")))


def active_models(registry: DataFrame) -> DataFrame:
    """The newest active record of every target."""
    return first_rows(registry.where(F.col("status") == "active"), ["target"],
                      [F.col("trained_at").desc_nulls_last(), F.col("version").desc()])


def flat_registry(registry: DataFrame) -> DataFrame:
    """Metrics as columns (null where absent), readable status and training date."""
    fields = []
    if "metrics" in registry.columns and isinstance(registry.schema["metrics"].dataType, T.StructType):
        fields = registry.schema["metrics"].dataType.fieldNames()
    flat = registry.select(*[c for c in registry.columns if c != "metrics"],
                           *[F.col(f"metrics.{m}").alias(m) for m in fields])
    flat = flat.withColumns({m: F.lit(None).cast("double") for m in METRICS if m not in flat.columns})
    status = F.col("status") if "status" in flat.columns else F.lit(None).cast("string")
    out = flat.withColumn("status", F.initcap(F.coalesce(status, F.lit("unknown"))))
    if "training_date" in out.columns:
        out = out.withColumn("training_date", F.date_format("training_date", "yyyy-MM-dd HH:mm"))
    return out


def registry_counts(registry: DataFrame) -> DataFrame:
    """Total, active and archived models."""
    return registry.agg(F.count(F.lit(1)).alias("total_models"),
                        F.count_if(F.lower("status") == "active").alias("active_models"),
                        F.count_if(F.lower("status") == "archived").alias("archived_models"))


def metric_presence(flat: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Per metric: whether any model of a task that uses it has a value."""
    regression = F.coalesce(F.col("task_type"), F.lit("regression")) == "regression"
    row = flat.agg(*[F.coalesce(F.max(F.col(m).isNotNull()), F.lit(False)).alias(m) for m in metrics or METRICS],
                   F.coalesce(F.max(regression), F.lit(False)).alias("_r"),
                   F.coalesce(F.max(~regression), F.lit(False)).alias("_c"))
    used = [(F.col(m) & F.col("_r" if m in ("rmse", "r2", "mae") else "_c")).alias(m) for m in metrics or METRICS]
    return row.select(*used).unpivot([], metrics or METRICS, "metric", "present")


def display_columns(flat: DataFrame) -> DataFrame:
    """The registry table as shown: base columns and the metrics in use. One row comes back first."""
    present = {r.metric for r in metric_presence(flat).collect() if r.present}
    return flat.select("model_name", "version", "training_date", "task_type",
                       *[m for m in METRICS if m in present], "status")
