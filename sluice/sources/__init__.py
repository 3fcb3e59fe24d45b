from sluice.sources.extract import (extract, default_watermark, typed_watermark, read_source,
                                    read_landing, read_csv, jdbc_reader, with_source_file,
                                    landing_path, replay)

__all__ = ["extract", "default_watermark", "typed_watermark", "read_source", "read_landing",
           "read_csv", "jdbc_reader", "with_source_file", "landing_path", "replay"]
