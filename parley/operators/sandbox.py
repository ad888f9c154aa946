"""Read-only SQL over named tables, with a row cap and, if wanted, a time limit.

What a statement may do is decided on its parsed plan, not on its text, so comments, quoting and
letter case play no part. Names that are themselves computed (``IDENTIFIER``) are refused, and the
analyzed plan, in which every name is resolved, is checked once more. Hints and pipe syntax are
refused too, although they only read.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

# Plan nodes that only read. Anything else, commands and table functions among them, is refused.
READING = frozenset(
    {
        "Aggregate", "Deduplicate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect",
        "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation", "Pivot", "Project",
        "Sample", "Sort", "SubqueryAlias", "Union", "Unpivot", "UnresolvedHaving", "UnresolvedInlineTable",
        "UnresolvedRelation", "UnresolvedSubqueryColumnAliases", "UnresolvedWith", "Window",
        "WithWindowDefinition",
    }
)
# Functions that run code of the caller's choice, and what they are once analyzed.
FORBIDDEN_FUNCTIONS = frozenset({"reflect", "java_method", "try_reflect"})
FORBIDDEN_EXPRESSIONS = frozenset({"CallMethodViaReflection", "TryReflect"})
# What a statement over temporary views may hold when analyzed: no files, no catalog tables.
FOREIGN_RELATIONS = frozenset({"HiveTableRelation", "DataSourceV2Relation", "UnresolvedCatalogRelation"})


class ForbiddenStatement(ValueError):
    pass


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _check_expression(expression, names: frozenset[str]) -> None:
    if _kind(expression) == "UnresolvedFunction":
        parts = _items(expression.nameParts())
        if len(parts) > 1 or parts[-1].lower() in FORBIDDEN_FUNCTIONS:
            raise ForbiddenStatement(f"{'.'.join(parts)} is not allowed")
    if "UnresolvedIdentifier" in _kind(expression):
        raise ForbiddenStatement("a computed name is not allowed")
    if _kind(expression) in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
        _check_plan(expression.plan(), names)
    for child in _items(expression.children()):
        _check_expression(child, names)


def _check_plan(plan, names: frozenset[str]) -> None:
    kind = _kind(plan)
    if kind not in READING:
        raise ForbiddenStatement(f"{kind} is not a reading statement")
    if kind == "UnresolvedRelation":
        parts = _items(plan.multipartIdentifier())
        if len(parts) != 1 or parts[0].lower() not in names:
            raise ForbiddenStatement(f"no table {'.'.join(parts)} here")
    if kind == "UnresolvedWith":
        for named in _items(plan.cteRelations()):
            _check_plan(named._2(), names)
            names = names | {named._1().lower()}
    for expression in _items(plan.expressions()):
        _check_expression(expression, names)
    for child in _items(plan.children()):
        _check_plan(child, names)


def _check_analyzed(plan) -> None:
    """Whatever way a name was written: no reflection in the plan as it will run."""
    kind = _kind(plan)
    if kind in FOREIGN_RELATIONS or kind.endswith("Command"):
        raise ForbiddenStatement(f"{kind} is not allowed")

    def walk(expression) -> None:
        if _kind(expression) in FORBIDDEN_EXPRESSIONS:
            raise ForbiddenStatement(f"{_kind(expression)} is not allowed")
        if _kind(expression) in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
            _check_analyzed(expression.plan())
        for child in _items(expression.children()):
            walk(child)

    for expression in _items(plan.expressions()):
        walk(expression)
    for child in _items(plan.children()) + _items(plan.innerChildren()):
        if _kind(child) not in ("LogicalRDD", "LogicalRelation") and hasattr(child, "expressions"):
            _check_analyzed(child)


def check_read_only(spark: SparkSession, sql: str, tables: Iterable[str] = ()) -> None:
    """Raise unless the text is a single query over the named tables and its own WITH clauses."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException as e:
        raise ForbiddenStatement("not a single statement in SQL") from e
    _check_plan(plan, frozenset(t.lower() for t in tables))


def guarded_sql(
    spark: SparkSession, sql: str, views: Mapping[str, DataFrame], max_rows: int = 20
) -> DataFrame:
    """Run one query over the given tables and keep at most ``max_rows`` rows.

    The cap is part of the plan. Names resolve while the statement is analyzed; when this returns,
    the session has the temporary views it had before.
    """
    check_read_only(spark, sql, views)
    catalog = spark._jsparkSession.sessionState().catalog()
    before = {name: spark.table(name) for name in views if catalog.getTempView(name).isDefined()}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        found = spark.sql(sql)
        _check_analyzed(found._jdf.queryExecution().analyzed())
        return found.limit(max_rows)
    finally:
        for name in views:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def guarded_rows(
    spark: SparkSession, sql: str, views: Mapping[str, DataFrame], max_rows: int = 20, seconds: float | None = None
) -> tuple[list[dict], bool]:
    """The capped rows and whether there were more; fetches one row beyond the cap.

    With ``seconds``, raises TimeoutError if they are not there by then. The statement's jobs carry a
    tag of their own, by which they alone are ended; other work of the session goes on. A task notices
    between rows it reads, not within what it makes of one row."""
    wanted = guarded_sql(spark, sql, views, max_rows + 1)
    if seconds is None:
        rows = wanted.collect()
    else:
        rows = _within(spark, wanted, seconds)
    return [r.asDict(recursive=True) for r in rows[:max_rows]], len(rows) > max_rows


def _within(spark: SparkSession, df: DataFrame, seconds: float) -> list:
    tag = f"guarded-{uuid.uuid4().hex}"
    done, late, context = threading.Event(), threading.Event(), spark.sparkContext

    def end() -> None:
        # Again and again, as a statement that is still being planned has no job to end yet.
        wait = seconds
        while not done.wait(wait):
            late.set()
            context.cancelJobsWithTag(tag)
            wait = 0.5

    watcher = threading.Thread(target=end, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        return df.collect()
    except Exception as e:
        if late.is_set():
            raise TimeoutError(f"the statement took more than {seconds} s") from e
        raise
    finally:
        done.set()
        context.removeJobTag(tag)
