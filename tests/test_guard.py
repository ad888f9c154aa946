"""What the SQL door refuses, and its time limit."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from parley.operators import sandbox


@pytest.fixture
def chats(spark):
    return {"chats": spark.range(30).withColumn("x", F.col("id") % 3)}


@pytest.mark.parametrize("sql", [
    "SELECT IDENTIFIER('java_method')('java.lang.System', 'getProperty', 'user.home') FROM chats",
    "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.home') FROM chats",
    "SELECT 1 FROM chats WHERE IDENTIFIER('try_' || 'reflect')('java.lang.System', 'getProperty', 'user.home') = '/'",
    "SELECT (SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')) FROM chats",
    "SELECT * FROM IDENTIFIER('cha' || 'ts')",
    "SELECT IDENTIFIER('i' || 'd') FROM chats",
    "SELECT transform(array(1), x -> java_method('java.lang.System', 'getProperty', 'user.home')) FROM chats",
    "WITH c AS (SELECT reflect('java.lang.System', 'getProperty', 'user.home') AS h FROM chats) SELECT h FROM c",
    "SELECT * FROM parquet.`/tmp`", "SELECT * FROM range(3)", "DROP TABLE chats", "SELECT 1; SELECT 2",
])
def test_refused(spark, chats, sql):
    with pytest.raises(sandbox.ForbiddenStatement):
        sandbox.guarded_sql(spark, sql, chats)


@pytest.mark.parametrize("sql, rows", [
    ("SELECT x, count(*) AS n FROM chats GROUP BY x ORDER BY x", [(0, 10), (1, 10), (2, 10)]),
    ("WITH c AS (SELECT max(id) AS m FROM chats) SELECT id FROM chats JOIN c ON id = m", [(29,)]),
    ("SELECT id FROM chats WHERE id IN (SELECT max(id) FROM chats) AND exists (SELECT 1 FROM chats)", [(29,)]),
    ("SELECT transform(array(1, 2), x -> x + 1)[1] AS two, 'reflect' AS s FROM chats LIMIT 1", [(3, "reflect")]),
])
def test_allowed(spark, chats, sql, rows):
    assert [tuple(r) for r in sandbox.guarded_sql(spark, sql, chats).collect()] == rows


def test_analyzed_plan_is_checked_on_its_own(spark):
    plan = spark.range(1).select(F.expr("java_method('java.lang.Math', 'random')"))._jdf.queryExecution().analyzed()
    with pytest.raises(sandbox.ForbiddenStatement):
        sandbox._check_analyzed(plan)


def test_time_limit_ends_the_statement_only(spark):
    slow = "SELECT sum(sqrt(id)) AS s FROM big"
    views = {"big": spark.range(10**13), "small": spark.range(9)}
    other: list = []
    worker = threading.Thread(target=lambda: other.append(spark.range(3_000_000).selectExpr("sum(sqrt(id))").first()))
    worker.start()
    start = time.time()
    with pytest.raises(TimeoutError):
        sandbox.guarded_rows(spark, slow, views, seconds=2)
    assert time.time() - start < 30
    worker.join()
    assert other
    assert sandbox.guarded_rows(spark, "SELECT count(*) AS n FROM small", views, seconds=60) == ([{"n": 9}], False)
