"""wattline — Spark-native analytics for tables of meter readings.

Every operator is DataFrame-in / DataFrame-out and is expressed with the
DataFrame / SQL API so that Catalyst plans it; Python runs only in small,
Arrow-batched helpers where no built-in expression exists.
"""

from wattline.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
__version__ = "0.1.0"
