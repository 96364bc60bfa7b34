"""riskframe: tabular risk analytics expressed as Spark DataFrame and Column functions."""

from riskframe.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
