"""Sources and sinks."""

from cadence.sources.readers import (detect_format, load_training_data, read_database,
                                     read_feather, read_mixed_directory, read_object,
                                     read_source, require_data, union_by_name)
from cadence.sources.sinks import (append_log, publish_features, write_findings_json,
                                   write_processed, write_splits)

__all__ = ["detect_format", "load_training_data", "read_database", "read_feather",
           "read_mixed_directory", "read_object", "read_source", "require_data", "union_by_name",
           "append_log", "publish_features", "write_findings_json", "write_processed", "write_splits"]
