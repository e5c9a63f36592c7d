import os

# Small matrices: threads of the linear algebra library only get in each other's way.
os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A table from rows and a schema, in a few partitions, with an extra column whose name clashes easily."""

    def make(rows, schema, partitions=3):
        wide = [(*r, "x") for r in rows]
        return spark.createDataFrame(wide, schema + ", row string").repartition(partitions)

    return make


@pytest.fixture
def by_value():
    """Sends a module's functions to the workers with its globals as they are now, patched ones included."""
    from pyspark import cloudpickle

    sent = []

    def send(module):
        cloudpickle.register_pickle_by_value(module)
        sent.append(module)

    yield send
    for module in sent:
        cloudpickle.unregister_pickle_by_value(module)
