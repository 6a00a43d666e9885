import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vecshoal.session import local_session, scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return lambda label: scratch_path(spark, label)


@pytest.fixture
def points(spark):
    """A maker of point tables: ``(id, reduced, ...)`` from a matrix."""

    def make(matrix, partitions=3, **columns):
        rows = [
            (f"p{i:05d}", [float(x) for x in row], *[int(values[i]) for values in columns.values()])
            for i, row in enumerate(np.asarray(matrix))
        ]
        schema = "id string, reduced array<double>" + "".join(f", {name} int" for name in columns)
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture
def items(spark):
    """A maker of labelled items: ``(id, dataset, url, encd, img_name, cluster_id)``."""

    def make(rows):
        full = [
            (id_, "images", f"u/{id_}.jpg", None if v is None else [float(x) for x in v], id_, c) for id_, v, c in rows
        ]
        schema = "id string, dataset string, url string, encd array<double>, img_name string, cluster_id int"
        return spark.createDataFrame(full, schema)

    return make
