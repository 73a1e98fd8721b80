import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows to a DataFrame, with a DDL schema; times as ISO text in columns of type timestamp_ntz."""
    from datetime import datetime

    from pyspark.sql import types as T

    def build(schema, rows):
        parsed = T._parse_datatype_string(schema)
        times = {i for i, f in enumerate(parsed.fields) if isinstance(f.dataType, T.TimestampNTZType)}
        return spark.createDataFrame(
            [tuple(datetime.fromisoformat(v) if i in times and v is not None else v for i, v in enumerate(r))
             for r in rows],
            parsed,
        )

    return build


RUNS = ("execution_audit_id long, parent_execution_audit_id long, top_level_execution_audit_id long, "
        "execution_name string, task_type string, created_on timestamp_ntz, updated_on timestamp_ntz, "
        "execution_audit_status string, return_result string")


@pytest.fixture(scope="session")
def runs(make):
    """Executions from (id, parent, top, name, start, end[, status[, type]])."""

    def build(rows):
        full = []
        for r in rows:
            number, parent, top, name, start, end, *rest = r
            status = rest[0] if rest else "COMPLETE"
            kind = rest[1] if len(rest) > 1 else "PLSQL"
            full.append((number, parent, top, name, kind, start, end, status, "OK" if status == "COMPLETE" else "FAILURE"))
        return make(RUNS, full)

    return build


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
