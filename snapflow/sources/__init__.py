from snapflow.sources.lake import (
    list_files,
    object_store_conf,
    partition_date,
    path_exists,
    read_bronze,
    read_silver,
)
from snapflow.sources.landing import LandingError, normalize_records, read_landed_json, stamp_ingestion, to_bronze
from snapflow.sources.sinks import append_snapshot, stage, write_json
from snapflow.sources.tables import PublishConflict, PublishError, publish, read_table

__all__ = [
    "LandingError",
    "PublishConflict",
    "PublishError",
    "append_snapshot",
    "list_files",
    "normalize_records",
    "object_store_conf",
    "partition_date",
    "path_exists",
    "publish",
    "read_bronze",
    "read_landed_json",
    "read_silver",
    "read_table",
    "stage",
    "stamp_ingestion",
    "to_bronze",
    "write_json",
]
