"""lastmile: order-delivery analytics as composable Spark DataFrame functions.

raw order rows -> seven warehouse tables -> (incremental upserts) -> two marts,
with data-quality checks in between. Nothing here creates a SparkSession; callers
pass DataFrames (or a session for I/O helpers).
"""

__version__ = "0.1.0"
