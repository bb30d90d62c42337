"""Goldens on the seed HR rows: the two analytic queries and pandas-style stats."""

from decimal import Decimal

from pyspark.sql import functions as F

from sluice.operators import analytics as A


def test_group_count_avg_seed(hr):
    out = A.group_count_avg(hr["employees"], "department", "salary", scale=2).collect()
    got = [(r.department, r.employee_count, r.avg_salary) for r in out]
    # ordered by count desc, then department (ties 3/3 and 2/2 resolved by name)
    assert got == [
        ("Engineering", 5, 89800.0),
        ("Finance", 3, 92000.0),
        ("Marketing", 3, 75000.0),
        ("Human Resources", 2, 66500.0),
        ("Sales", 2, 107500.0),
    ]


def test_group_mean_min_max_seed(hr):
    out = {r.department: r for r in A.group_mean_min_max(hr["employees"], "department", "salary", scale=2).collect()}
    assert out["Engineering"].min_value == Decimal("85000.00")
    assert out["Engineering"].max_value == Decimal("95000.00")
    assert out["Sales"].mean_value == 107500.0
    assert out["Human Resources"].min_value == Decimal("65000.00")


def test_project_participation_seed(hr):
    out = A.project_participation(
        hr["projects"], hr["departments"], hr["employee_projects"],
        project_id="id", project_name="name", project_budget="budget", project_department="department_id",
        department_id="id", department_name="name", assignment_project="project_id",
        assignment_member="employee_id",
    ).collect()
    got = [(r.project_name, str(r.project_budget), r.department_name, r.employee_count) for r in out]
    assert got == [
        ("Cloud Migration", "500000.00", "Engineering", 4),
        ("Mobile App Development", "420000.00", "Engineering", 3),
        ("Financial System Upgrade", "350000.00", "Finance", 3),
        ("Sales Analytics Platform", "300000.00", "Sales", 2),
        ("Website Redesign", "250000.00", "Marketing", 3),
        ("Employee Portal", "180000.00", "Human Resources", 2),
    ]


def test_sql_entry_point_matches_dataframe(spark, hr):
    hr["employees"].createOrReplaceTempView("employees_view")
    sql = spark.sql(
        "SELECT department, COUNT(*) AS employee_count FROM employees_view GROUP BY department"
    )
    df = hr["employees"].groupBy("department").agg(F.count("*").alias("employee_count"))
    assert sorted(sql.collect()) == sorted(df.collect())


def test_filter_not_in_top_is_top_k(spark):
    from tests.conftest import SF_SMALL

    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    out = A.filter_not_in_top(
        c, equals={"c_mktsegment": "BUILDING"}, not_in={"c_nationkey": [0, 1]},
        order_by=[F.col("c_acctbal").desc(), F.col("c_custkey")], limit=3,
    )
    from sluice.plans.inspect import plan_text

    plan = plan_text(out)
    assert "TakeOrderedAndProject" in plan  # per-partition top-k, no global sort
    rows = out.collect()
    assert len(rows) == 3 and all(r.c_mktsegment == "BUILDING" and r.c_nationkey not in (0, 1) for r in rows)
    assert [r.c_acctbal for r in rows] == sorted([r.c_acctbal for r in rows], reverse=True)


def test_preview_requires_order(spark):
    import pytest

    df = spark.range(10)
    with pytest.raises(ValueError):
        A.preview(df, 3, [])
    assert [r.id for r in A.preview(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_sql_variants_on_seed_views(spark, hr):
    for name, df in hr.items():
        df.createOrReplaceTempView(f"{name}_view")
    stats = A.grouped_stats_sql(spark, "employees_view", "department", "salary").collect()
    assert [(r.department, r.employee_count, r.avg_salary) for r in stats][0] == ("Engineering", 5, 89800.0)
    part = A.participation_sql(
        spark,
        ("projects_view", "departments_view", "employee_projects_view"),
        project=("id", "name", "budget", "department_id"), department=("id", "name"), assignment=("project_id", "employee_id"),
    ).collect()
    assert [(r.project_name, r.employee_count) for r in part] == [
        ("Cloud Migration", 4), ("Mobile App Development", 3), ("Financial System Upgrade", 3),
        ("Sales Analytics Platform", 2), ("Website Redesign", 3), ("Employee Portal", 2),
    ]


def test_min_max_and_row_count(spark):
    df = spark.range(5, 42)
    assert tuple(A.min_max(df, "id").first()) == (5, 41)
    assert A.row_count(df).first().row_count == 37


def test_default_mean_does_not_round(spark):
    df = spark.createDataFrame([("a", 0.125), ("a", 0.0)], "k STRING, v DOUBLE")
    assert A.group_count_avg(df, "k", "v").first().avg_salary == 0.0625
    assert A.group_count_avg(df, "k", "v", scale=2).first().avg_salary == 0.065  # 0.13 / 2: money rounding
