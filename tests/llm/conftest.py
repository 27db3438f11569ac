import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    """A given table, cached as rows on first use."""
    from tripmill.llm.common import table as read

    return lambda name: read(spark, sf_dir, name)


@pytest.fixture(scope="session")
def larger(sf_dir):
    """The largest of the small given tables, for accuracy on held-out rows."""
    path = os.path.join(os.path.dirname(sf_dir), "sf0.1")
    if not os.path.isdir(path):
        pytest.skip(f"no test tables at {path}")
    return path
