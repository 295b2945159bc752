import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stellwerk.session import local_session  # noqa: E402


# Started here, because test modules build columns when they are imported.
SESSION = local_session(4, memory="8g", partitions=4)


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def over(spark):
    """Evaluate a column over a list of texts (or tuples with a DDL)."""

    def evaluate(column, rows, ddl="x STRING"):
        data = [r if isinstance(r, tuple) else (r,) for r in rows]
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "_i INT, " + ddl)
        found = frame.select("_i", column.alias("v")).collect()
        return [r.v for r in sorted(found, key=lambda r: r._i)]

    return evaluate
