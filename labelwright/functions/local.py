"""Small driver-side tables as local relations: planned inline, without a job of their own."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """For tables whose size is bounded by classes, levels, folds or blocks."""
    struct = StructType.fromDDL(schema)
    names = struct.fieldNames()
    columns = list(zip(*rows)) or [()] * len(names)
    arrow = to_arrow_schema(struct)
    table = pa.Table.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, struct)
