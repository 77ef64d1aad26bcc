"""starweave: star-schema ETL on Spark.

Readers with declared schemas, cleaning transforms, natural-key fact builds,
dimension load modes, date dimensions, query-shaped tables and data-quality
checks, all expressed with DataFrame / SQL built-ins so Catalyst plans them.
"""

from starweave.session import build_session, scratch_path, use_utc

__all__ = ["build_session", "scratch_path", "use_utc"]
