"""sluice: move relational tables into columnar storage with Spark, query them,
write results back over JDBC and check the transfer.

Everything here is a thin, declarative layer over the DataFrame / SQL API:
plans are built lazily and handed to Catalyst, which owns pushdown, pruning,
join selection and codegen. Python code on the driver only validates options,
plans read bounds and publishes tables; no row-at-a-time Python runs in a job.
"""

from sluice.config import JdbcConfig
from sluice.session import build_session, shared_path

__all__ = ["JdbcConfig", "build_session", "shared_path"]
__version__ = "0.1.0"
