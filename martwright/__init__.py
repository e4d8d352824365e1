"""Sales feeds to trusted tables and marts, as composable Spark DataFrame operators."""

from martwright.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
