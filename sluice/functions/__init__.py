from sluice.functions.scalar import (batch_id, batch_id_col, dated_path, dated_path_col,
                                     seconds_between, hours_before, warehouse_type,
                                     safe_cast, castable, fmt_ts)

__all__ = ["batch_id", "batch_id_col", "dated_path", "dated_path_col", "seconds_between",
           "hours_before", "warehouse_type", "safe_cast", "castable", "fmt_ts"]
