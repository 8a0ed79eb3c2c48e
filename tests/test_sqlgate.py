import pytest

from dealerlake.sqlgate import safe_sql


@pytest.mark.parametrize(
    "sql",
    [
        "", None, "with a as (select 1) select * from a", "drop table t", "select 1; delete from t",
        "select 'update'", "select * from t where grant = 1", "SELECT reflect('java.lang.System', 'exit', 1)",
        "select java_method('a', 'b')", "select transform(a) using 'sh' from t", "select 1 where (select max(try_reflect('a', 'b')) from t) = 1",
        "select * from (select transform(a) using 'sh' as (b) from t)", "select upper(Java_Method('a', 'b')) from t",
    ],
)
def test_refused(spark, sql):
    with pytest.raises(ValueError):
        safe_sql(spark, sql)


def test_allowed(spark):
    assert [r.x for r in safe_sql(spark, "```sql\nselect id as x from range(5);\n```", limit=3).collect()] == [0, 1, 2]
    assert safe_sql(spark, "SELECT updated FROM (SELECT 1 AS updated)").count() == 1
    assert safe_sql(spark, "select id from range(10) where id >= :lo", args={"lo": 8}).count() == 2
    assert safe_sql(spark, "select id from range(500)").count() == 200
    assert safe_sql(spark, "select id from range(500) order by id LIMIT 300").count() == 300
    assert safe_sql(spark, "select id from (select id from range(500) limit 400)").count() == 200
    assert safe_sql(spark, "select id, 'x limit 400' as x from range(500)").count() == 200
    assert safe_sql(spark, "select transform(array(1, 2), x -> x + 1) as t").first().t == [2, 3]


def test_files_are_not_readable(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)not found|unsupported|cannot be found"):
        safe_sql(spark, f"select * from parquet.`{tmp_path}/t`").collect()
    assert spark.sql(f"select * from parquet.`{tmp_path}/t`").count() == 1


@pytest.mark.parametrize(
    "sql, n",
    [
        ("select id from range(500) -- limit 10", 200),
        ("select id from range(500) /* limit 10 */", 200),
        ("select id from range(500) limit 10 -- all of them", 10),
        ("select id from range(500) limit all", 200),
        ("select id from range(500) limit :n", 300),
        ("select id from range(500) limit 100 + 150", 250),
        ("select id from range(500) limit 7 offset 3", 7),
        ("select id from range(500) where id in (select id from range(450) limit 400)", 200),
        ("select id, 'x\n-- ' as x from range(500) limit 210", 210),
        ("select id, \"limit 5\" as x from range(500)", 200),
        ("select `limit 5` from (select id as `limit 5` from range(500))", 200),
        ("select 'reflect' as word from range(500) limit 201", 201),
    ],
)
def test_only_the_statements_own_limit_counts(spark, sql, n):
    assert safe_sql(spark, sql, args={"n": 300} if ":n" in sql else None).count() == n
