"""What a labelled table is, and the parameters of a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T


@dataclass(frozen=True)
class LabelledSpec:
    """Columns of a labelled table. The id must be unique; the label may be null."""

    id_col: str
    feature_cols: tuple[str, ...]
    label_col: str

    @classmethod
    def of(cls, df: DataFrame, id_col: str, label_col: str | None = None) -> "LabelledSpec":
        """Take the last column as the label unless one is named; the rest are features."""
        label = label_col or df.columns[-1]
        if label not in df.columns or id_col not in df.columns or label == id_col:
            raise ValueError(f"id {id_col!r} and label {label!r} must be two columns of the table")
        features = tuple(c for c in df.columns if c not in (id_col, label))
        return cls(id_col, features, label)

    def check(self, df: DataFrame) -> None:
        """Schema check without a job: columns exist and features are numeric."""
        types = {f.name: f.dataType for f in df.schema.fields}
        missing = [c for c in (self.id_col, *self.feature_cols, self.label_col) if c not in types]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        bad = [c for c in self.feature_cols if not isinstance(types[c], T.NumericType)]
        if bad:
            raise ValueError(f"features must be numeric: {bad}")

    def project(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        """The spec's columns, features as doubles and the label as a string, and any to keep."""
        self.check(df)
        return df.select(
            self.id_col,
            *[F.col(c).cast("double").alias(c) for c in self.feature_cols],
            F.col(self.label_col).cast("string").alias(self.label_col),
            *keep,
        )


@dataclass(frozen=True)
class Params:
    """Run parameters with the default values of the experiment."""

    seed: int = 42
    noise_levels: tuple[float, ...] = (0.05, 0.10, 0.50)
    test_size: float = 0.2
    folds: int = 5
    k: int = 5
    threshold: float = 0.5
    normalize: bool = True
    confidence: float = 0.8
    low_confidence: float = 0.6
    trees: int = 100
    max_depth: int = 30
    c: float = 1.0
    max_iter: int = 1000
    svm_iter: int = 100
    # Relative duality gap at which a kernel machine is done, largest slope of a logistic one,
    # and the mean kernel error up to which landmarks are added.
    svm_gap: float = 0.01
    slope: float = 1e-5
    kernel_tolerance: float = 0.01
    # Class tables are held on the driver and broadcast; every function that does so takes
    # this bound, and a label with more values is an error there.
    max_classes: int = 10_000


def check_level(level: float) -> float:
    if not 0.0 <= level <= 1.0:
        raise ValueError(f"level must be between 0.0 and 1.0, got {level}")
    return float(level)
