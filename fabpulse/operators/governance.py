"""Role-scoped sessions: a role sees views of its tables without its hidden columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fabpulse.config import ROLES
from fabpulse.layout import Layout
from fabpulse.session import own_session
from fabpulse.sources.tables import read_table

Loader = Callable[[SparkSession], DataFrame]

ROLE_KEY = "fabpulse.role"
# Functions that call Java methods by name.
REFLECTION = frozenset({"java_method", "reflect", "try_reflect"})

_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."
_NODES = "org.apache.spark.sql.catalyst.plans.logical."
# Rows that come from no table: of the query text, of its own WITH, and counted ones.
_ROWS_OF_THE_QUERY = frozenset(
    {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "UnionLoopRef", "EmptyRelation"})
# Expressions that run code or tell paths.
_REFUSED_EXPRESSIONS = frozenset({
    "CallMethodViaReflection", "InputFileName", "ScalaUDF", "PythonUDF", "PythonUDAF", "PythonUDTF",
})
# Names of relations and functions that are only computed while the text is analysed.
_COMPUTED_NAMES = frozenset({"ExpressionWithUnresolvedIdentifier", "PlanWithUnresolvedIdentifier"})


def role_views(spark: SparkSession, role: str, loaders: Mapping[str, Loader]) -> SparkSession:
    """A session of its own, holding views of the tables the role may read.

    `loaders` builds each table in the session it is given.
    """
    _known(role)
    session = own_session(spark)
    rights = ROLES[role]
    for name, load in loaders.items():
        if name in rights.tables:
            load(session).drop(*rights.hidden_columns).createOrReplaceTempView(name)
    # Files must not be readable past the views.
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    session.conf.set(ROLE_KEY, role)
    return session


def open_as(spark: SparkSession, role: str, layout: Layout) -> SparkSession:
    """A role's session over the tables of a stored lake."""
    _known(role)
    return role_views(spark, role, {
        name: lambda session, name=name: read_table(session, layout, name)
        for name in ROLES[role].tables
    })


def _known(role: str) -> None:
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}, expected one of {sorted(ROLES)}")


def role_query(session: SparkSession, role: str, sql: str) -> DataFrame:
    """Run a query in the session of that very role. What it may not see is a PermissionError.

    The text is run as a subquery, which only a query can be. It is refused before anything of it runs: as parsed
    where it calls a Java method or computes a name, since analysis may evaluate constants, and as analysed where
    a relation is none of the role's views, or an expression none of Spark's own. What is written in
    literals and comments, or how a name is quoted, is of no account.
    """
    _known(role)
    if session.conf.get(ROLE_KEY, None) != role:
        raise PermissionError(f"this session was not opened as {role!r}")
    query = f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)"
    try:
        _check_parsed(session, role, session._jsparkSession.sessionState().sqlParser().parsePlan(query))
        result = session.sql(query)
    except AnalysisException as error:
        raise _as_denial(error, role) from error
    _check_analysed(session, role, result._jdf.queryExecution().analyzed())
    return result


def _check_parsed(session: SparkSession, role: str, plan: JavaObject) -> None:
    """No Java method called by name, and no name that is computed."""
    for _, item in _walk(session, plan):
        kind = _class(item)[1]
        if kind in _COMPUTED_NAMES:
            raise PermissionError(f"role {role!r} may not compute names")
        if kind in ("UnresolvedFunction", "UnresolvedTableValuedFunction"):
            parts = item.nameParts() if kind == "UnresolvedFunction" else item.name()
            name = _java(session, parts)[-1].lower()
            if name in REFLECTION:
                raise PermissionError(f"role {role!r} may not call Java methods by {name}")


def _check_analysed(session: SparkSession, role: str, plan: JavaObject) -> None:
    """Relations are the role's views, expressions are Spark's own."""
    for is_plan, item in _walk(session, plan, _is_view):
        package, kind = _class(item)
        if not is_plan:
            if not package.startswith(_EXPRESSIONS) or kind in _REFUSED_EXPRESSIONS:
                raise PermissionError(f"role {role!r} may not use {kind}")
        elif _is_view(item):
            name = item.desc().identifier()
            if not item.isTempView() or name.database().isDefined() or name.table() not in ROLES[role].tables:
                raise PermissionError(f"role {role!r} may not read {name.unquotedString()}")
        elif not package.startswith(_NODES) or item.children().isEmpty() and kind not in _ROWS_OF_THE_QUERY:
            raise PermissionError(f"role {role!r} may not read {kind}")


def _is_view(plan: JavaObject) -> bool:
    return _class(plan) == (_NODES, "View")


def _class(item: JavaObject) -> tuple[str, str]:
    """Package and name of an object's class."""
    package, _, name = item.getClass().getName().rpartition(".")
    return f"{package}.", name.rstrip("$")


def _java(session: SparkSession, items: JavaObject) -> list:
    return list(session._jvm.scala.jdk.javaapi.CollectionConverters.asJava(items))


def _walk(
    session: SparkSession, plan: JavaObject, closed: Callable[[JavaObject], bool] = lambda _: False,
) -> Iterator[tuple[bool, JavaObject]]:
    """(whether it is a node, node or expression) of a plan, with subqueries and WITH; not below `closed` nodes."""
    subquery = session._jvm.java.lang.Class.forName(f"{_EXPRESSIONS}PlanExpression")
    node = session._jvm.java.lang.Class.forName(f"{_NODES}LogicalPlan")
    waiting = [(True, plan)]
    while waiting:
        is_plan, item = waiting.pop()
        yield is_plan, item
        if is_plan:
            if closed(item):
                continue
            waiting += [(False, e) for e in _java(session, item.expressions())]
        elif subquery.isInstance(item):
            waiting.append((True, item.plan()))
        waiting += [(is_plan, child) for child in _java(session, item.children())]
        waiting += [(True, inner) for inner in _java(session, item.innerChildren()) if node.isInstance(inner)]


def _as_denial(error: AnalysisException, role: str) -> Exception:
    condition = error.getCondition() or ""
    if condition.startswith("UNRESOLVED_COLUMN"):
        named = (error.getMessageParameters() or {}).get("objectName", "")
        column = named.replace("`", "").split(".")[-1].lower()
        if column not in ROLES[role].hidden_columns:
            return error
        return PermissionError(f"role {role!r} may not read column {column}")
    denied = ("TABLE_OR_VIEW_NOT_FOUND", "UNSUPPORTED_DATASOURCE_FOR_DIRECT_QUERY")
    if condition.startswith(denied):
        return PermissionError(f"role {role!r} may not read this table: {error}")
    return error
