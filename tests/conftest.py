import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from supplyscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    small = {"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2"}
    return local_session(8, {**small, "spark.checkpoint.dir": shared})


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, nulls first."""

    def collect(df, *cols):
        chosen = df.select(*[f"`{c}`" for c in cols]) if cols else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(x is not None, str(x)) for x in r])

    return collect
