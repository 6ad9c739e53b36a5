"""Label quality for large labelled Spark tables."""

from labelwright.spec import LabelledSpec, Params

__all__ = ["LabelledSpec", "Params"]
