"""Readers and writers of labelled tables, reports, metrics and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from labelwright.functions.local import local_table
from labelwright.operators.noise import LabelNoise
from labelwright.spec import LabelledSpec

RUNS = "run_id string, model string, dataset string, kind string, name string, value string, logged_at timestamp"
RESULTS = "noise_level double, accuracy double, f1_macro double, precision_macro double, recall_macro double"


def scan_labelled(
    spark: SparkSession,
    path: str,
    id_col: str,
    label_col: str | None = None,
    schema: str | T.StructType | None = None,
    fmt: str = "parquet",
) -> tuple[DataFrame, LabelledSpec]:
    """A labelled table and its columns; the last column is the label unless named.

    CSV files have a header and take an explicit schema; without one the types
    are inferred, which reads the data twice.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    elif schema:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    return df, LabelledSpec.of(df, id_col, label_col)


def with_dataset_name(df: DataFrame) -> DataFrame:
    """Add ``dataset``, the file name without folder and extension."""
    return df.withColumn(
        "dataset", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    )


def stack_datasets(parts: dict[str, DataFrame]) -> DataFrame:
    """Several data sets as one table with a ``dataset`` column."""
    out = None
    for name, df in parts.items():
        named = df.withColumn("dataset", F.lit(name))
        out = named if out is None else out.unionByName(named)
    if out is None:
        raise ValueError("no data sets to stack")
    return out


def write_noisy(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One folder per noise level from one job."""
    writer = df.write.mode(mode).partitionBy("noise_level").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_metadata(metadata: DataFrame, path: str, mode: str = "errorifexists") -> None:
    metadata.write.mode(mode).json(path)


def noise_run(df: DataFrame, noise: LabelNoise, path: str, source: str) -> DataFrame:
    """Write all levels and the metadata beside them; returns the metadata.

    A level too low to select a row is written like any other, with its metadata.
    """
    from labelwright.operators.noise import noise_metadata, transitions

    write_noisy(noise.sweep(df), f"{path}/data")
    written = df.sparkSession.read.parquet(f"{path}/data")
    metadata = noise_metadata(transitions(written, noise.spec, noise), noise, source)
    write_metadata(metadata, f"{path}/metadata")
    return df.sparkSession.read.schema(metadata.schema).json(f"{path}/metadata")


def write_metrics(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    metrics.write.mode(mode).json(path)


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """Per-level results; levels without a file are simply absent."""
    return spark.read.schema(RESULTS).option("recursiveFileLookup", True).json(folder)


def write_report(results: DataFrame, summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines: one object per result row and one per summary row, with the time of the run."""
    def section(name: str, df: DataFrame) -> DataFrame:
        return df.select(
            F.current_timestamp().cast("string").alias("evaluation_timestamp"),
            F.lit(name).alias("section"),
            F.to_json(F.struct(*df.columns)).alias("body"),
        )

    section("results", results).unionByName(section("summary", summary)).write.mode(mode).json(path)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    model: str,
    dataset: str,
    params: dict[str, object],
    metrics: DataFrame,
) -> None:
    """Append parameters and metrics (metric, value) of one run to the table of runs."""
    keys = [F.lit(run_id).alias("run_id"), F.lit(model).alias("model"), F.lit(dataset).alias("dataset")]
    given = local_table(
        spark, [(k, str(v)) for k, v in params.items()], "name string, value string"
    ).select(*keys, F.lit("param").alias("kind"), "name", "value")
    measured = metrics.select(
        *keys,
        F.lit("metric").alias("kind"),
        F.col("metric").alias("name"),
        F.col("value").cast("string").alias("value"),
    )
    given.unionByName(measured).withColumn("logged_at", F.current_timestamp()).write.mode(
        "append"
    ).partitionBy("model").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)
