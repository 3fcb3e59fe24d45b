from sluice.sinks.write import (LandResult, land, load_raw, read_raw, read_rejects,
                                write_rejects, append_log, read_log, compact_log,
                                write_dq_results)
from sluice.sinks.staging import StagingTable, read_staging

__all__ = ["LandResult", "land", "load_raw", "read_raw", "read_rejects", "write_rejects",
           "append_log", "read_log", "compact_log", "write_dq_results", "StagingTable",
           "read_staging"]
