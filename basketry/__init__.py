"""basketry: user-item interaction analytics on the Spark DataFrame API.

Sub-packages
------------
sources    readers for JSON lines / CSV / Parquet, the test-table relations, writers
functions  column expressions (hashes, tokenizing, formatting) used by operators
operators  the analytic operators (reports, layout, itemsets, similarity, graph)
plans      named queries over the test tables and their DuckDB oracle SQL
streaming  incremental (Structured Streaming) form of the activity counts
"""

from basketry.session import build_session, ensure_checkpoint_dir  # noqa: F401

__all__ = ["build_session", "ensure_checkpoint_dir"]
