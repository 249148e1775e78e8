"""clicklens: clickstream analytics as Spark DataFrame and Structured Streaming jobs.

Batch jobs over a visit log (top categories, most active sessions per top
category, page-to-page conversion) and ad-click jobs (daily totals, daily top
ads per area, sliding click trends, threshold banning), each written as a
``DataFrame -> DataFrame`` function so the same code serves batch and stream.
"""

from clicklens.config import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
