"""Star-schema warehouse toolkit for PySpark."""

from starmart.session import configure, scratch_path

__all__ = ["configure", "scratch_path"]
