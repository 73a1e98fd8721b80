"""Schemas of the logical tables, as the operators expect them."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "b": T.LongType(),
    "i": T.IntegerType(),
    "s": T.StringType(),
    "d": T.DoubleType(),
    "t": T.TimestampNTZType(),
    "day": T.DateType(),
    "f": T.BooleanType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


EXECUTIONS = _schema(
    execution_audit_id="b", parent_execution_audit_id="b", top_level_execution_audit_id="b", execution_name="s",
    task_type="s", created_on="t", updated_on="t", execution_audit_status="s", return_result="s",
)
FLOW_DIM = _schema(flow_name="s", critical_ind="s")
FLOW_STEPS = _schema(
    execution_audit_id="b", prev_execution_audit_id="b", prev_created_on="t", prev_execution_name_short="s",
    execution_name_short="s", type="s", cnt="b", duration_mins="d", p80_duration_mins="d",
    top_level_execution_audit_id="b", root_execution_name="s", root_created_on="t", root_updated_on="t",
)
SESSION_SNAP = _schema(
    sid="b", sql_id="s", logon_time="t", population_date="t", instance_startup_date="t", fixed_table_sequence="b",
    status="s", command="i", program="s", user_id="b", username="s", schemaname="s", machine="s",
)
SQLSTATS_SNAP = _schema(
    sql_id="s", sql_text="s", instance_startup_date="t", population_date="t", executions="b", elapsed_time="b",
)
USERS = _schema(user_id="b", username="s", created="t", default_tablespace="s", profile="s")
REPORT_USERS = _schema(
    id="b", login="s", fullname="s", email="s", groups="s", disabled="f", never_connected="f", description="s",
    last_login="t",
)
CONTROL = _schema(procedure_name="s", run_date="t")
FRESHNESS_LOG = _schema(
    snapshot_datetime="t", dw_last_run="t", rate_date="t", other_facts_days_diff="i", cdrs_days_diff="i",
)
INTERFACE_TABLES = _schema(flow_name="s", table_name="s", start_date_key="t")
LOAD_CONTROL = _schema(table_name="s", data_ref_date="t")
LOAD_LOG = _schema(table_name="s", data_ref_date="t")
SQL_EXECUTIONS = _schema(sql_id="s", elapsed_time_mins="d", command="i", program="s")
USER_DAY = _schema(user_id="b", day="day", num_of_selects_executed="b")
ACTIONS = _schema(action="i", name="s")
COLUMN_COMMENTS = _schema(owner="s", column_name="s", comments="s")
SCHEMA_SCOPE = _schema(schema_name="s", include_ind="i")
STORAGE_SPACES = _schema(tablespace_name="s", contents="s", extent_management="s", status="s")
SPACE_BYTES = _schema(tablespace_name="s", bytes="b")
OWNED_TABLES = _schema(owner="s", table_name="s", tablespace_name="s", degree="s")
MVIEW_LINKS = _schema(mview_owner="s", mview_name="s", view_owner="s", view_name="s")
VIEW_TABLES = _schema(
    mview_owner="s", mview_name="s", view_owner="s", view_name="s", table_owner="s", table_name="s",
)
VIEW_COLUMNS = _schema(
    mview_owner="s", mview_name="s", view_owner="s", view_name="s", table_owner="s", table_name="s", col_name="s",
)
HIERARCHY = _schema(employee_id="b", manager_id="b", last_name="s")


def conform(df, schema: T.StructType):
    """Pick the schema's columns by name and cast them; a missing column is an error."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
