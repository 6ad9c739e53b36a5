import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelwright.session import local_session
from labelwright.spec import LabelledSpec

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def clusters(seed=42, per_class=50):
    """Three separated clusters of two features."""
    rng = np.random.default_rng(seed)
    centres = {"A": (0, 0), "B": (5, 5), "C": (0, 5)}
    parts = [
        pd.DataFrame(rng.normal(c, 0.5, (per_class, 2)), columns=["feature1", "feature2"]).assign(
            target=label
        )
        for label, c in centres.items()
    ]
    out = pd.concat(parts, ignore_index=True)
    out.insert(0, "id", range(len(out)))
    return out


CLUSTERS = LabelledSpec("id", ("feature1", "feature2"), "target")


@pytest.fixture(scope="session")
def clean(spark):
    return spark.createDataFrame(clusters())


@pytest.fixture(scope="session")
def flipped(spark):
    """Ten known flips: rows 5-9 say B, rows 55-59 say C."""
    rows = clusters()
    rows.loc[5:9, "target"] = "B"
    rows.loc[55:59, "target"] = "C"
    return spark.createDataFrame(rows)
