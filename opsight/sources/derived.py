"""The logical tables, derived from the given tables.

One SQL text per table serves Spark and the checking engine; ``Dialect`` fills in the two spots
where they differ. Every text reads its source tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the registered queries: the reporting moment and the day the captures are split at.
NOW = "2024-02-05 08:00:00"
SPLIT = "2024-01-18 00:00:00"


@dataclass(frozen=True)
class Dialect:
    ts: str
    add_seconds: Callable[[str, str], str]

    def literal(self, text: str) -> str:
        return f"CAST('{text}' AS {self.ts})"

    def trunc(self, unit: str, ts: str = "ts") -> str:
        return f"CAST(date_trunc('{unit}', {ts}) AS {self.ts})"


SPARK = Dialect("TIMESTAMP_NTZ", lambda t, n: f"timestampadd(SECOND, {n}, {t})")
CHECK = Dialect("TIMESTAMP", lambda t, n: f"({t} + to_seconds({n}))")


def _text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR(20))"


_TREE = "event_id - event_id % 64"
_PARENT = "event_id - event_id % 64 + CAST(floor((event_id % 64 - 1) / 2) AS BIGINT)"


def executions(d: Dialect) -> str:
    start = d.trunc("second")
    return f"""
        SELECT event_id AS execution_audit_id,
               CASE WHEN event_id % 64 = 0 THEN NULL ELSE {_PARENT} END AS parent_execution_audit_id,
               {_TREE} AS top_level_execution_audit_id,
               'FLOW_' || {_text("CAST(floor(event_id / 64) AS BIGINT) % 5")}
                 || CASE WHEN event_id % 64 = 0 THEN '' ELSE ':STEP_' || {_text("event_id % 64")} END AS execution_name,
               CASE event_id % 4 WHEN 0 THEN 'PLSQL' WHEN 1 THEN 'PLSQLProcedure' WHEN 2 THEN 'PLSQLFunction'
                 ELSE 'ProcessFlow' END AS task_type,
               {start} AS created_on,
               {d.add_seconds(start, "CAST(round(value * 600) AS BIGINT)")} AS updated_on,
               CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETE' END AS execution_audit_status,
               CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'OK' END AS return_result
        FROM {{events}}"""


def flow_dim(d: Dialect) -> str:
    return f"""
        SELECT 'FLOW_' || {_text("f")} AS flow_name, CASE WHEN f < 3 THEN 'Y' ELSE 'N' END AS critical_ind
        FROM (SELECT DISTINCT CAST(floor(event_id / 64) AS BIGINT) % 5 AS f FROM {{events}}) q"""


def flow_steps(d: Dialect) -> str:
    """A step has one row per predecessor: the tree parent, and for purchases also the root."""
    steps = f"""
            SELECT event_id, event_type, value, ts, {_TREE} AS root_id, {_PARENT} AS prev_id,
                   CASE WHEN event_type = 'purchase' AND event_id <> {_TREE} AND {_PARENT} <> {_TREE} THEN 2 ELSE 1 END
                     AS cnt
            FROM {{events}}"""
    second = f"""
            SELECT event_id, event_type, value, ts, root_id, root_id AS prev_id, cnt FROM ({steps}) q WHERE cnt = 2"""
    return f"""
        SELECT s.event_id AS execution_audit_id,
               CASE WHEN s.event_id = s.root_id THEN NULL ELSE s.prev_id END AS prev_execution_audit_id,
               CASE WHEN s.event_id = s.root_id THEN NULL ELSE {d.trunc("second", "s.ts")} END AS prev_created_on,
               CASE WHEN s.event_id = s.root_id THEN NULL
                    ELSE CASE WHEN s.prev_id % 7 = 0 THEN 'AND_' ELSE 'STEP_' END || {_text("s.prev_id % 64")} END
                 AS prev_execution_name_short,
               CASE WHEN s.event_id % 7 = 0 THEN 'AND_' ELSE 'STEP_' END || {_text("s.event_id % 64")}
                 AS execution_name_short,
               CASE s.event_id % 4 WHEN 0 THEN 'Mapping' WHEN 1 THEN 'Procedure' WHEN 2 THEN 'Function' END AS type,
               CAST(s.cnt AS BIGINT) AS cnt,
               CASE WHEN s.event_type = 'signup' AND s.value > 200 THEN NULL ELSE s.value END AS duration_mins,
               s.value * 2 AS p80_duration_mins,
               s.root_id AS top_level_execution_audit_id,
               'FLOW_' || {_text("CAST(floor(s.event_id / 64) AS BIGINT) % 5")} AS root_execution_name,
               {d.trunc("second", "r.ts")} AS root_created_on,
               {d.add_seconds(d.trunc("second", "r.ts"), "CAST(round(r.value * 600) AS BIGINT)")} AS root_updated_on
        FROM ({steps} UNION ALL {second}) s JOIN {{events}} r ON r.event_id = s.root_id"""


def hierarchy(d: Dialect) -> str:
    return """
        SELECT CAST(n_nationkey AS BIGINT) AS employee_id,
               CASE WHEN n_nationkey = 0 THEN NULL ELSE CAST(floor((n_nationkey - 1) / 3) AS BIGINT) END AS manager_id,
               n_name AS last_name
        FROM {nation}"""


_COMMAND = "CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 3 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 6 ELSE -86 END"
_STATEMENT = f"event_type || '_' || {_text('event_id % 20')}"


def session_snap(d: Dialect) -> str:
    return f"""
        SELECT user_id AS sid,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_STATEMENT} END AS sql_id,
               {d.trunc("day")} AS logon_time, {d.trunc("hour")} AS population_date,
               {d.trunc("week")} AS instance_startup_date, event_id AS fixed_table_sequence,
               CASE WHEN value < 60 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, {_COMMAND} AS command,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 11 = 1 THEN 'oracle (P001)'
                    WHEN event_id % 11 = 2 THEN 'busobj.exe' ELSE 'report' END AS program,
               user_id AS user_id,
               CASE WHEN event_type = 'purchase' AND event_id % 50 = 7 THEN 'MONITOR' ELSE 'U' || {_text("user_id")} END
                 AS username,
               CASE WHEN event_id % 13 = 0 THEN 'SYS' ELSE 'U' || {_text("user_id")} END AS schemaname,
               props AS machine
        FROM {{events}}"""


def _sqlstats(d: Dialect, test: str = "1 = 1") -> str:
    return f"""
        SELECT k AS sql_id, 'select ' || k AS sql_text, w AS instance_startup_date, max(h) AS population_date,
               count(*) AS executions, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS elapsed_time
        FROM (SELECT {_STATEMENT} AS k, {d.trunc("week")} AS w, {d.trunc("hour")} AS h, value, ts FROM {{events}}) q
        WHERE {test} GROUP BY k, w"""


def sqlstats(d: Dialect) -> str:
    return _sqlstats(d)


def sqlstats_before(d: Dialect) -> str:
    return _sqlstats(d, f"ts < {d.literal(SPLIT)}")


def sqlstats_after(d: Dialect) -> str:
    return _sqlstats(d, f"ts >= {d.literal(SPLIT)}")


def users(d: Dialect) -> str:
    return f"""
        SELECT c_custkey AS user_id, 'U' || {_text("c_custkey")} AS username,
               {d.add_seconds(d.literal("2008-06-20 12:00:00"), "c_custkey * 86400")} AS created,
               CASE c_custkey % 3 WHEN 0 THEN 'USERS' WHEN 1 THEN 'TS_DATA' ELSE 'TEMP' END AS default_tablespace,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'ANALYST' ELSE 'DEFAULT' END AS profile
        FROM {{customer}}"""


def sql_exec(d: Dialect) -> str:
    return f"""
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS sql_id, value AS elapsed_time_mins,
               {_COMMAND} AS command, event_type AS program
        FROM {{events}}"""


def report_exec(d: Dialect) -> str:
    return """
        SELECT o_orderkey AS report_id, o_custkey AS user_id, round(o_totalprice / 1000, 1) AS duration_in_mins
        FROM {orders}"""


def actions(d: Dialect) -> str:
    """Names of the commands that occur; the unknown one has none."""
    return f"""
        SELECT command AS action, CASE command WHEN 2 THEN 'INSERT' WHEN 3 THEN 'SELECT' WHEN 6 THEN 'UPDATE' END AS name
        FROM (SELECT DISTINCT {_COMMAND} AS command FROM {{events}}) q"""


def user_day(d: Dialect) -> str:
    return """
        SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS num_of_selects_executed
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)"""


def report_user_day(d: Dialect) -> str:
    return """
        SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, count(*) AS num_of_bo_exectns
        FROM {orders} GROUP BY o_custkey, CAST(o_orderdate AS DATE)"""


def control(d: Dialect) -> str:
    return """
        SELECT CASE event_type WHEN 'click' THEN 'LAST_RUN' WHEN 'view' THEN 'RATE_DATE' ELSE upper(event_type) END
                 AS procedure_name,
               max(ts) AS run_date
        FROM {events} GROUP BY event_type"""


def load_control(d: Dialect) -> str:
    return f"""
        SELECT 'T' || {_text("p_partkey")} AS table_name,
               {d.add_seconds(d.literal("2024-01-01 00:00:00"), "(p_partkey % 40) * 86400")} AS data_ref_date
        FROM {{part}}"""


def interface_tables(d: Dialect) -> str:
    return f"""
        SELECT p_brand AS flow_name,
               CASE WHEN p_size > 25 THEN 'T' ELSE 't' END || {_text("p_partkey")} AS table_name,
               {d.add_seconds(d.literal("2024-01-01 00:00:00"), "(p_partkey % 50) * 86400")} AS start_date_key
        FROM {{part}}"""


def load_log(d: Dialect) -> str:
    return f"""
        SELECT 'T' || {_text("l_partkey")} AS table_name, l_shipdate AS data_ref_date FROM {{lineitem}}"""


def comments(d: Dialect) -> str:
    return f"""
        SELECT source AS owner, 'C' || {_text("documents.doc_id")} AS column_name, {_text("quality")} AS comments
        FROM {{documents}} documents LEFT JOIN {{labels}} labels ON documents.doc_id = labels.doc_id"""


def table_comments(d: Dialect) -> str:
    return f"""
        SELECT source AS owner, 'D' || {_text("documents.doc_id")} AS table_name, {_text("toxic")} AS comments
        FROM {{documents}} documents LEFT JOIN {{labels}} labels ON documents.doc_id = labels.doc_id"""


def schema_scope(d: Dialect) -> str:
    return """
        SELECT DISTINCT source AS schema_name, CASE WHEN source = 'src3' THEN 0 ELSE 1 END AS include_ind
        FROM {documents}"""


def spaces(d: Dialect) -> str:
    return """
        SELECT n_name AS tablespace_name,
               CASE WHEN n_nationkey % 5 = 0 THEN 'TEMPORARY' ELSE 'PERMANENT' END AS contents,
               CASE WHEN n_nationkey % 10 = 0 THEN 'DICTIONARY' ELSE 'LOCAL' END AS extent_management,
               'ONLINE' AS status
        FROM {nation}"""


def data_files(d: Dialect) -> str:
    """One space has no files: its rows go to a name no space has."""
    return """
        SELECT CASE WHEN n_nationkey = 3 THEN 'NONE' ELSE n_name END AS tablespace_name,
               CAST(20000 + c_custkey * 1024 AS BIGINT) AS bytes
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


def free_space(d: Dialect) -> str:
    return """
        SELECT n_name AS tablespace_name, CAST(5000 + s_suppkey * 512 AS BIGINT) AS bytes
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


def temp_files(d: Dialect) -> str:
    return """
        SELECT n_name AS tablespace_name, CAST(20000 + c_custkey * 1024 AS BIGINT) AS bytes
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


def temp_headers(d: Dialect) -> str:
    return """
        SELECT n_name AS tablespace_name, CAST(5000 + s_suppkey * 512 AS BIGINT) AS bytes_used
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


def owned_tables(d: Dialect) -> str:
    return f"""
        SELECT p_type AS owner, 'T' || {_text("p_partkey")} AS table_name, n_name AS tablespace_name,
               CASE WHEN p_size > 40 THEN 'DEFAULT' ELSE {_text("p_size % 8")} END AS degree
        FROM {{part}} JOIN {{nation}} ON p_partkey % 25 = n_nationkey"""


def segments(d: Dialect) -> str:
    return f"""
        SELECT 'T' || {_text("p_partkey")} AS segment_name, CAST(p_size AS BIGINT) * 1048576 AS bytes FROM {{part}}"""


def mviews(d: Dialect) -> str:
    return f"""
        SELECT CASE WHEN p_size > 20 THEN 'T' ELSE 'M' END || {_text("p_partkey")} AS container_name FROM {{part}}"""


def sql_area(d: Dialect) -> str:
    return f"""
        SELECT k AS sql_id, 'select ' || k AS sql_text, count(*) AS buffer_gets
        FROM (SELECT {_STATEMENT} AS k FROM {{events}}) q GROUP BY k"""


def processes(d: Dialect) -> str:
    return """SELECT c_custkey AS sid, c_custkey + 1000 AS spid FROM {customer}"""


def px_sessions(d: Dialect) -> str:
    return """
        SELECT c_custkey AS sid, c_custkey - c_custkey % 4 AS qcsid, CAST(16 AS BIGINT) AS req_degree,
               CAST(CASE WHEN c_custkey % 8 = 1 THEN 8 ELSE 16 END AS BIGINT) AS degree
        FROM {customer}"""


def mview_analysis(d: Dialect) -> str:
    return f"""
        SELECT upper(source) AS owner, 'MV_' || {_text("doc_id")} AS mview_name,
               {d.add_seconds(d.literal("2024-01-01 00:00:00"), "(doc_id % 60) * 86400")} AS last_refresh_date
        FROM {{documents}}"""


def mview_relations(d: Dialect) -> str:
    return f"""
        SELECT upper(source) AS owner, 'MV_' || {_text("doc_id")} AS mview_name, source AS detailobj_owner,
               'V' || {_text("doc_id")} AS detailobj_name
        FROM {{documents}}"""


def mview_links(d: Dialect) -> str:
    return f"""
        SELECT upper(source) AS mview_owner, 'MV_' || {_text("doc_id")} AS mview_name, source AS view_owner,
               'V' || {_text("doc_id")} AS view_name
        FROM {{documents}}"""


def source_lines(d: Dialect) -> str:
    """Lower-case mentions; some with another character where the name has its wildcard."""
    return f"""
        SELECT 'PKG_' || {_text("doc_id % 2")} AS name,
               CASE lang WHEN 'en' THEN 'refresh(' || source || '.mv_' || {_text("doc_id")} || ')'
                         WHEN 'de' THEN 'refresh(' || source || '.mv-' || {_text("doc_id")} || ')'
                         ELSE 'skip ' || {_text("doc_id")} END AS text
        FROM {{documents}}"""


def view_texts(d: Dialect) -> str:
    return f"""
        SELECT source AS owner, 'V' || {_text("doc_id")} AS view_name, text, n_chars AS text_length
        FROM {{documents}}"""


def lineage_names(d: Dialect) -> str:
    """A passage split at its first full stop, so that owner, stop and table name give the passage back."""
    return """
        SELECT split_part(text, '.', 1) AS owner, substr(text, length(split_part(text, '.', 1)) + 2) AS table_name
        FROM {benchmark}"""


def tab_columns(d: Dialect) -> str:
    one = """SELECT split_part(text, '.', 1) AS owner, substr(text, length(split_part(text, '.', 1)) + 2) AS table_name,
               '%s' AS column_name FROM {benchmark}"""
    return " UNION ALL ".join(one % word for word in ("then", "her", "zzz"))


@cache
def used_tables(text: str) -> tuple[str, ...]:
    return tuple(t for t in BASE_TABLES if re.search(r"\{" + t + r"\}", text))


def logical(spark: SparkSession, sf_dir: str, table: Callable[[Dialect], str],
            frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """A logical table as a DataFrame. ``frames`` holds base tables already open, or put in place of
    the files (such as a stream); those opened here are added."""
    text = table(SPARK)
    frames = {} if frames is None else frames
    for t in used_tables(text):
        if t not in frames:
            frames[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(text, **{t: frames[t] for t in used_tables(text)})


def check_sql(tables: list[Callable[[Dialect], str]], body: str) -> str:
    """The checking query: the logical tables as common table expressions, then ``body``."""
    names = {t: t for t in BASE_TABLES}
    ctes = [f"{t.__name__} AS ({t(CHECK).format(**names)})" for t in tables]
    return "WITH RECURSIVE " + ", ".join(ctes) + " " + body
