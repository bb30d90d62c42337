"""The analytic queries: grouped statistics and project participation.

All of them are plain DataFrame plans. Grouped aggregates run partial
(map-side) then final, so a hot group key costs one partial row per input
partition in the shuffle, not its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import hot_keys, partitions_for, salt_replicate, salt_spread

#: Keys with at least this share of the assignments are looked for where tasks are sized by rows.
LEAST_HOT_SHARE = 0.001


def exact_mean(value: str, scale: int | None = None) -> Column:
    """Mean whose result does not depend on summation order.

    With ``scale`` the values are summed as DECIMAL(18, scale) -- exact for
    money columns (decimals, or doubles with at most ``scale`` decimals) --
    and divided once at the end. ``scale=None`` (the default) is Spark's
    ``avg``: other doubles must not be rounded to a fixed scale.
    """
    if scale is None:
        return F.avg(value)
    total = F.sum(F.col(value).cast(f"decimal(18,{scale})")).cast("double")
    return total / F.count(value)


def group_count_avg(
    df: DataFrame,
    key: str,
    value: str,
    *,
    count_name: str = "employee_count",
    avg_name: str = "avg_salary",
    scale: int | None = None,
) -> DataFrame:
    """``SELECT key, COUNT(*), AVG(value) ... GROUP BY key ORDER BY count DESC``.

    The group key is the second sort key so ties come out in a fixed order.
    """
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name), exact_mean(value, scale).alias(avg_name))
        .orderBy(F.col(count_name).desc(), F.col(key))
    )


def group_mean_min_max(
    df: DataFrame,
    key: str,
    value: str,
    *,
    key_name: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Per-group mean / min / max, computed by Spark (not on collected rows)."""
    return (
        df.groupBy(F.col(key).alias(key_name or key))
        .agg(
            exact_mean(value, scale).alias("mean_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
        .orderBy(key_name or key)
    )


def project_participation(
    projects: DataFrame,
    departments: DataFrame,
    assignments: DataFrame,
    *,
    project_id: str,
    project_name: str,
    project_budget: str,
    project_department: str,
    department_id: str,
    department_name: str,
    assignment_project: str,
    assignment_member: str,
    hot_key_share: float | None = None,
    hot_key_splits: int = 32,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Projects joined to their department and their assignments, with the
    number of distinct members per (project name, budget, department name),
    ordered by budget descending.

    Projects are joined with departments first, then with the assignments.
    No join is hinted: AQE broadcasts a side whose measured size allows it and
    shuffles otherwise. The frames keep their own column names under table
    aliases, so when the project key is also a grouping column (a name that
    is the key) both phases of the distinct aggregate reuse the join's hash
    partitioning: the assignments are shuffled exactly once.

    Hot projects: with AQE's ``forceOptimizeSkewedJoin`` (``session``
    defaults) a skewed join partition is split at run time. Where the session
    cannot be relied on, ``hot_key_share`` salts instead: project keys holding
    at least that share of the assignments (by a one-pass sketch) spread
    their assignments over ``hot_key_splits`` salts by a hash of the member,
    and only those projects' rows are repeated per salt on the other side.
    Each (project, member) pair still meets each matching project row once,
    so the counts are unchanged; the aggregate then needs its own exchange.

    ``rows_per_task`` bounds a task's memory whatever the input's size: tables
    with more assignments than that on every core are dealt over as many
    partitions as that takes (AQE coalesces to a number of shuffled bytes, see
    ``partitions_for``). AQE doesn't split those, so keys with more rows than a
    task's are salted.
    """
    partitions = partitions_for(assignments, rows_per_task) if rows_per_task else None
    if partitions and hot_key_share is None:
        hot_key_share = max(LEAST_HOT_SHARE, 1 / partitions)
    p = projects.alias("p")
    d = departments.alias("d")
    a = assignments.alias("ep")
    head = p.join(d, F.col(f"p.{project_department}") == F.col(f"d.{department_id}"))
    on = F.col(f"p.{project_id}") == F.col(f"ep.{assignment_project}")
    hot = hot_keys(assignments, assignment_project, min_share=hot_key_share) if hot_key_share else []
    if hot:
        head = head.withColumn("_hs", salt_replicate(F.col(f"p.{project_id}"), hot, hot_key_splits))
        # An int as on the other side: a cast in the join would undo the partitioning below.
        salt = salt_spread(F.col(assignment_project), hot, F.col(assignment_member), hot_key_splits).cast("int")
        a = a.withColumn("_as", salt)
        on = on & (F.col("_hs") == F.col("_as"))
    if partitions:
        head = head.repartition(partitions, F.col(f"p.{project_id}"), *([F.col("_hs")] if hot else []))
    joined = head.join(a, on)
    return (
        joined.groupBy(
            F.col(f"p.{project_name}").alias("project_name"),
            F.col(f"p.{project_budget}").alias("project_budget"),
            F.col(f"d.{department_name}").alias("department_name"),
        )
        .agg(F.countDistinct(F.col(f"ep.{assignment_member}")).alias("employee_count"))
        .orderBy(F.col("project_budget").desc(), "project_name", "department_name")
    )


def filter_not_in_top(
    df: DataFrame,
    *,
    equals: dict[str, object],
    not_in: dict[str, Sequence[object]],
    order_by: Sequence[Column],
    limit: int,
) -> DataFrame:
    """Equality filters AND NOT IN lists, then the first ``limit`` rows in a
    total order. Spark plans ORDER BY + LIMIT as a per-partition top-k and a
    final merge (TakeOrderedAndProject), not a global sort."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    for c, vs in not_in.items():
        cond = cond & ~F.col(c).isin(list(vs))
    return df.filter(cond).orderBy(*order_by).limit(limit)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """``SELECT COUNT(*)`` as a one-row frame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_val"), F.max(column).alias("max_val"))


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a stated order (``show(n)`` has none)."""
    if not order_by:
        raise ValueError("a preview needs an order to be repeatable")
    return df.orderBy(*order_by).limit(n)


def grouped_stats_sql(spark, view: str, key: str, value: str) -> DataFrame:
    """``group_count_avg`` written as SQL over a session view: row count and
    plain average per key, most rows first. Same plan."""
    return spark.sql(
        f"SELECT {quote(key)}, count(*) AS employee_count, avg({quote(value)}) AS avg_salary "
        f"FROM {quote(view)} GROUP BY ALL ORDER BY 2 DESC, 1"
    )


def participation_sql(
    spark,
    views: Sequence[str],
    *,
    project: Sequence[str],
    department: Sequence[str],
    assignment: Sequence[str],
) -> DataFrame:
    """``project_participation`` written as SQL over three session views
    (projects, departments, assignments). ``project``: its id, name, budget and
    department columns; ``department``: id and name; ``assignment``: project
    and member. The members of each project are made distinct before the join,
    so a hot project brings one row per member to it."""
    projects, departments, assignments = map(quote, views)
    p_id, p_name, p_budget, p_department = map(quote, project)
    d_id, d_name = map(quote, department)
    a_project, a_member = map(quote, assignment)
    return spark.sql(
        f"""
        WITH members AS (SELECT DISTINCT {a_project} AS pid, {a_member} AS member FROM {assignments}),
        named AS (
          SELECT x.{p_id} AS pid, x.{p_name} AS project_name, x.{p_budget} AS project_budget, y.{d_name} AS department_name
          FROM {projects} AS x INNER JOIN {departments} AS y ON y.{d_id} = x.{p_department}
        )
        SELECT project_name, project_budget, department_name, count(DISTINCT member) AS employee_count
        FROM named INNER JOIN members USING (pid)
        GROUP BY project_name, project_budget, department_name
        ORDER BY project_budget DESC, project_name, department_name
        """
    )


def quote(name: str) -> str:
    """One back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"
