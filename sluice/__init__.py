"""sluice: configuration-driven ingestion and change-apply on Spark.

One row of a control table describes one source table.  From it the
engine extracts the table in full or from a stored high watermark, lands
it as Parquet, casts it to the target's schema while setting bad rows
aside, stamps lineage columns, keeps the latest row per key and merges it
into a current-state table with soft deletes.  Everything is expressed
with DataFrame / Spark SQL operations so that Catalyst and AQE plan it.
"""

from sluice.spec import TableSpec, BUSINESS_SPECS, spec_for
from sluice.session import get_session, scratch_dir

__all__ = ["TableSpec", "BUSINESS_SPECS", "spec_for", "get_session",
           "scratch_dir"]
