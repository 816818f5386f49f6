import gzip
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bazaarlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4",
                    "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    from bazaarlake.sinks.tables import ensure_schema

    name = f"t_{abs(hash(str(tmp_path))) % 10**10}"
    ensure_schema(spark, name, str(tmp_path / "warehouse"))
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@pytest.fixture
def put(tmp_path):
    """Write one JSON document (or raw bytes) as a gzip feed file; returns the root."""
    def write(path, document):
        target = tmp_path / "feeds" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        if isinstance(document, bytes):
            target.write_bytes(document)
        else:
            target.write_bytes(gzip.compress(json.dumps(document).encode()))
        return str(tmp_path / "feeds")

    return write
