"""Spark-native tabular ingestion, cleaning and reconciliation.

Every operator takes a DataFrame (plus plain parameters) and returns a lazy
DataFrame.  The few places that must look at data before the final plan can be
built (date pattern choice, sample cut-off, column widths) run one distributed
aggregate whose result has a fixed size bound.
"""

from tideline.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
