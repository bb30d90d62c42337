import os
import sys
import tempfile
import uuid
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("sluice-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="sluice-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def derby():
    from sluice.config import derby_memory

    return derby_memory(f"t_{uuid.uuid4().hex[:10]}")


# Seed HR tables (fixed values from the demo data set).
DEPARTMENTS = [
    (1, "Engineering", "Building A, Floor 2", Decimal("1500000.00")),
    (2, "Marketing", "Building B, Floor 1", Decimal("800000.00")),
    (3, "Finance", "Building A, Floor 3", Decimal("1200000.00")),
    (4, "Human Resources", "Building B, Floor 2", Decimal("500000.00")),
    (5, "Sales", "Building C, Floor 1", Decimal("2000000.00")),
]
EMPLOYEES = [
    (1, "John", "Smith", "john.smith@example.com", "Engineering", 85000.00, "2018-06-15"),
    (2, "Emily", "Johnson", "emily.johnson@example.com", "Marketing", 72000.00, "2019-03-22"),
    (3, "Michael", "Williams", "michael.williams@example.com", "Finance", 95000.00, "2017-11-08"),
    (4, "Sarah", "Brown", "sarah.brown@example.com", "Human Resources", 68000.00, "2020-01-15"),
    (5, "David", "Jones", "david.jones@example.com", "Engineering", 92000.00, "2018-09-30"),
    (6, "Jennifer", "Garcia", "jennifer.garcia@example.com", "Marketing", 75000.00, "2019-07-12"),
    (7, "Robert", "Miller", "robert.miller@example.com", "Finance", 88000.00, "2018-04-05"),
    (8, "Lisa", "Davis", "lisa.davis@example.com", "Human Resources", 65000.00, "2020-02-28"),
    (9, "James", "Rodriguez", "james.rodriguez@example.com", "Engineering", 90000.00, "2017-08-17"),
    (10, "Mary", "Martinez", "mary.martinez@example.com", "Sales", 105000.00, "2018-12-03"),
    (11, "William", "Hernandez", "william.hernandez@example.com", "Sales", 110000.00, "2017-05-20"),
    (12, "Patricia", "Lopez", "patricia.lopez@example.com", "Engineering", 87000.00, "2019-10-11"),
    (13, "Richard", "Gonzalez", "richard.gonzalez@example.com", "Finance", 93000.00, "2018-07-25"),
    (14, "Elizabeth", "Wilson", "elizabeth.wilson@example.com", "Marketing", 78000.00, "2019-04-18"),
    (15, "Thomas", "Anderson", "thomas.anderson@example.com", "Engineering", 95000.00, "2017-09-22"),
]
PROJECTS = [
    (1, "Cloud Migration", "2022-01-15", "2022-12-31", 1, 500000.00),
    (2, "Website Redesign", "2022-03-01", "2022-08-31", 2, 250000.00),
    (3, "Financial System Upgrade", "2022-02-15", "2022-11-30", 3, 350000.00),
    (4, "Employee Portal", "2022-04-01", "2022-10-31", 4, 180000.00),
    (5, "Mobile App Development", "2022-01-10", "2022-09-30", 1, 420000.00),
    (6, "Sales Analytics Platform", "2022-03-15", None, 5, 300000.00),
]
EMPLOYEE_PROJECTS = [
    (1, 1, "Lead Developer", "2022-01-15"),
    (5, 1, "DevOps Engineer", "2022-01-20"),
    (9, 1, "Backend Developer", "2022-01-25"),
    (12, 1, "Frontend Developer", "2022-02-01"),
    (2, 2, "Marketing Lead", "2022-03-01"),
    (6, 2, "Content Specialist", "2022-03-05"),
    (14, 2, "UX Designer", "2022-03-10"),
    (3, 3, "Finance Lead", "2022-02-15"),
    (7, 3, "Financial Analyst", "2022-02-20"),
    (13, 3, "System Architect", "2022-03-01"),
    (4, 4, "HR Lead", "2022-04-01"),
    (8, 4, "UI Designer", "2022-04-05"),
    (1, 5, "Technical Advisor", "2022-01-15"),
    (5, 5, "Lead Mobile Developer", "2022-01-20"),
    (15, 5, "QA Engineer", "2022-02-01"),
    (10, 6, "Sales Lead", "2022-03-15"),
    (11, 6, "Data Analyst", "2022-03-20"),
]

SCHEMAS = {
    "departments": "id INT, name STRING, location STRING, budget DECIMAL(15,2)",
    "employees": "id INT, first_name STRING, last_name STRING, email STRING, department STRING, "
    "salary DECIMAL(10,2), hire_date DATE",
    "projects": "id INT, name STRING, start_date DATE, end_date DATE, department_id INT, budget DECIMAL(15,2)",
    "employee_projects": "employee_id INT, project_id INT, role STRING, join_date DATE",
}


@pytest.fixture(scope="session")
def hr(spark):
    from sluice.sources.rows import from_rows

    rows = {
        "departments": DEPARTMENTS,
        "employees": EMPLOYEES,
        "projects": PROJECTS,
        "employee_projects": EMPLOYEE_PROJECTS,
    }
    return {name: from_rows(spark, rows[name], SCHEMAS[name]) for name in rows}
