from sluice.streaming.incremental import (late_rows, lookback_extract, stream_landing,
                                          stream_merge)

__all__ = ["late_rows", "lookback_extract", "stream_landing", "stream_merge"]
