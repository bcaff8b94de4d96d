import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphmill.session import local_session  # noqa: E402

# The 7-vertex demo graph (src, dst, weight) with labels A..G.
DEMO_EDGES = [(1, 2, 7.0), (1, 4, 5.0), (2, 3, 8.0), (2, 4, 9.0), (2, 5, 7.0), (3, 5, 5.0),
              (4, 5, 15.0), (4, 6, 6.0), (5, 6, 8.0), (5, 7, 9.0), (6, 7, 11.0)]
DEMO_LABELS = [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "E"), (6, "F"), (7, "G")]


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="graphmill-tests")
    yield s


@pytest.fixture
def demo(spark):
    return spark.createDataFrame(DEMO_EDGES, "src long, dst long, weight double")


def edges_df(spark, pairs):
    rows = [(a, b, 1.0) if len(t := (a, b)) == 2 else t for a, b in pairs]
    return spark.createDataFrame(rows, "src long, dst long, weight double")


def as_map(df, key="id", value="value", ndigits=6):
    return {r[key]: (round(r[value], ndigits) if isinstance(r[value], float) else r[value])
            for r in df.collect()}
