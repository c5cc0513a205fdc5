"""Bronze → silver → gold analytics for Spark, written as DataFrame operators."""

from lakemill.session import build_session, cut, shared_dir

__all__ = ["build_session", "cut", "shared_dir"]
