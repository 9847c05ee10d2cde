import pytest
from pyspark.errors import AnalysisException

from fabpulse.operators.governance import open_as, role_query, role_views
from fabpulse.sources.tables import read_table
from fabpulse.sinks.tables import ensure_table

COUNTS = "SELECT machine_id, COUNT(*) AS n FROM fact_sensor_readings GROUP BY 1"
AUDIT = "SELECT machine_id, _ingested_at FROM fact_sensor_readings LIMIT 3"
SUMMARY = "SELECT machine_id, AVG(avg_value) FROM hourly_machine_summary GROUP BY 1;"

FACT = """SELECT 'r' AS reading_id, 'm' AS machine_id, 1D AS reading_value,
                 current_timestamp() AS _ingested_at, current_timestamp() AS _loaded_at"""
LOADERS = {
    "fact_sensor_readings": lambda s: s.sql(FACT),
    "hourly_machine_summary": lambda s: s.sql("SELECT 'm' AS machine_id, 2D AS avg_value"),
    "dim_machine": lambda s: s.sql("SELECT 1 AS machine_sk"),
    "anomaly_log": lambda s: s.sql("SELECT 'r' AS reading_id"),
}


@pytest.mark.parametrize(("role", "sql", "allowed"), [
    ("engineer", COUNTS, True), ("engineer", AUDIT, True), ("engineer", SUMMARY, True),
    ("analyst", COUNTS, True), ("analyst", AUDIT, False), ("analyst", SUMMARY, True),
    ("viewer", COUNTS, False), ("viewer", AUDIT, False), ("viewer", SUMMARY, True),
    ("engineer", "SELECT * FROM anomaly_log", True),
    ("analyst", "SELECT * FROM anomaly_log", False),
])
def test_role_matrix(spark, role, sql, allowed):
    session = role_views(spark, role, LOADERS)
    if allowed:
        assert role_query(session, role, sql).count() == 1
    else:
        with pytest.raises(PermissionError):
            role_query(session, role, sql)


def test_star_does_not_leak(spark):
    session = role_views(spark, "analyst", LOADERS)
    visible = role_query(session, "analyst", "SELECT * FROM fact_sensor_readings -- all")
    assert visible.columns == ["reading_id", "machine_id", "reading_value"]


def test_hidden_columns_can_be_named_in_text(spark):
    session = role_views(spark, "analyst", LOADERS)
    text = "SELECT '_loaded_at' AS note FROM fact_sensor_readings"
    assert role_query(session, "analyst", text).first().note == "_loaded_at"


def test_unknown_role(spark):
    with pytest.raises(ValueError, match="unknown role"):
        role_views(spark, "guest", LOADERS)


def test_files_and_commands_are_out_of_reach(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "secret"))
    session = role_views(spark, "viewer", LOADERS)
    with pytest.raises(PermissionError):
        role_query(session, "viewer", f"SELECT * FROM parquet.`{tmp_path}/secret`")
    for command in ("SET spark.sql.runSQLOnFiles=true", "DROP VIEW dim_machine"):
        with pytest.raises(AnalysisException):
            role_query(session, "viewer", command)


def test_other_mistakes_stay_analysis_errors(spark):
    session = role_views(spark, "analyst", LOADERS)
    with pytest.raises(AnalysisException):
        role_query(session, "analyst", "SELECT nonsense FROM fact_sensor_readings")


def test_a_session_answers_its_own_role_only(spark):
    session = role_views(spark, "engineer", LOADERS)
    with pytest.raises(PermissionError, match="not opened as"):
        role_query(session, "viewer", "SELECT * FROM anomaly_log")
    with pytest.raises(PermissionError, match="not opened as"):
        role_query(spark, "viewer", "SELECT 1")


@pytest.mark.parametrize("call", ["java_method", "REFLECT", "try_reflect", "`java_method`"])
def test_java_methods_are_refused(spark, call):
    session = role_views(spark, "viewer", LOADERS)
    with pytest.raises(PermissionError, match="Java"):
        role_query(session, "viewer", f"SELECT {call} ('java.lang.System', 'getProperty', 'user.home')")


READS_PROPERTY = "('java.lang.System', 'getProperty', 'user.dir')"


@pytest.mark.parametrize("text", [
    f"SELECT reflect/**/{READS_PROPERTY}",
    f"SELECT java_method -- c\n{READS_PROPERTY}",
    "SELECT `reflect`/*a*/('java.lang.System', 'getenv', 'HOME')",
    f"SELECT system.builtin.reflect{READS_PROPERTY}",
    f"SELECT upper(concat('x', TRY_REFLECT{READS_PROPERTY}))",
    f"SELECT 1 WHERE EXISTS (SELECT java_method{READS_PROPERTY})",
    f"WITH c AS (SELECT reflect{READS_PROPERTY} AS x) SELECT 1 FROM dim_machine WHERE machine_sk IN (SELECT x FROM c)",
    f"SELECT * FROM VALUES (reflect{READS_PROPERTY}) AS t(x)",
    f"SELECT schema_of_json(reflect{READS_PROPERTY})",
    f"SELECT transform(array(1), x -> reflect{READS_PROPERTY})",
    f"SELECT max(reflect{READS_PROPERTY}) OVER () FROM dim_machine ORDER BY reflect{READS_PROPERTY}",
    f"SELECT * FROM dim_machine, LATERAL (SELECT java_method{READS_PROPERTY})",
    f"SELECT IDENTIFIER('refl' || 'ect'){READS_PROPERTY}",
    "SELECT * FROM IDENTIFIER('anomaly' || '_log')",
    "SELECT input_file_name() FROM dim_machine",
])
def test_refused_however_it_is_written(spark, text):
    session = role_views(spark, "viewer", LOADERS)
    with pytest.raises(PermissionError):
        role_query(session, "viewer", text)


@pytest.mark.parametrize(("text", "value"), [
    ("SELECT 'reflect(x)' AS v", "reflect(x)"),
    ("SELECT 'java_method (' AS v -- reflect(x)", "java_method ("),
    ("SELECT count(*) AS `reflect(x)` FROM dim_machine /* reflect('a') */", 1),
    ("SELECT 'SubqueryAlias a.b' AS v FROM dim_machine", "SubqueryAlias a.b"),
    ("SELECT sum(x) FROM (SELECT explode(sequence(1, 3)) AS x) JOIN (SELECT id FROM range(1)) ON true", 6),
    ("SELECT max(r) FROM (SELECT rank() OVER (ORDER BY machine_sk) AS r FROM dim_machine)", 1),
    ("SELECT (SELECT max(avg_value) FROM hourly_machine_summary) + machine_sk FROM dim_machine", 3.0),
    ("WITH RECURSIVE n(i) AS (SELECT 1 UNION ALL SELECT i + 1 FROM n WHERE i < 4) SELECT max(i) FROM n", 4),
])
def test_allowed_however_it_reads(spark, text, value):
    session = role_views(spark, "viewer", LOADERS)
    assert role_query(session, "viewer", text).first()[0] == value


def test_functions_that_are_not_sparks_own_are_refused(spark):
    session = role_views(spark, "viewer", LOADERS)
    session.udf.register("peek", lambda: "secret")
    with pytest.raises(PermissionError, match="PythonUDF"):
        role_query(session, "viewer", "SELECT peek()")


def test_views_of_others_in_the_session_are_refused(spark):
    session = role_views(spark, "viewer", LOADERS)
    session.range(2).createOrReplaceTempView("anomaly_log")
    with pytest.raises(PermissionError, match="anomaly_log"):
        role_query(session, "viewer", "SELECT * FROM anomaly_log")


def test_relations_of_other_sessions_are_refused(spark):
    spark.range(3).createOrReplaceGlobalTempView("secret")
    spark.sql("CREATE TABLE IF NOT EXISTS shared_secret USING parquet AS SELECT 1 AS x")
    session = role_views(spark, "viewer", LOADERS)
    try:
        for text in ("SELECT * FROM global_temp.secret", "SELECT * FROM shared_secret",
                     "SELECT * FROM default.shared_secret",
                     "SELECT 1 WHERE EXISTS (SELECT * FROM global_temp.secret)",
                     "WITH c AS (SELECT * FROM shared_secret) SELECT * FROM c"):
            with pytest.raises(PermissionError, match="may not read"):
                role_query(session, "viewer", text)
    finally:
        spark.catalog.dropGlobalTempView("secret")
        spark.sql("DROP TABLE shared_secret")
    assert role_query(session, "viewer", "WITH c AS (SELECT * FROM dim_machine) SELECT * FROM c").count() == 1


@pytest.mark.parametrize(("role", "allowed"), [
    ("engineer", (True, True, True)), ("analyst", (True, False, True)), ("viewer", (False, False, True))])
def test_roles_over_a_stored_lake(spark, lake, role, allowed):
    for name in ("fact_sensor_readings", "hourly_machine_summary", "anomaly_log", "dim_machine"):
        ensure_table(spark, lake, name)
    session = open_as(spark, role, lake)
    for sql, may in zip((COUNTS, AUDIT, SUMMARY), allowed):
        if may:
            assert role_query(session, role, sql).count() == 0
        else:
            with pytest.raises(PermissionError):
                role_query(session, role, sql)
    assert read_table(spark, lake, "anomaly_log").count() == 0
