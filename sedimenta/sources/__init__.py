"""Landing files, stored tables and previews."""

from sedimenta.sources.landing import (
    LandingFormat,
    archive_files,
    read_landing,
    write_files,
)
from sedimenta.sources.preview import preview
from sedimenta.sources.snapshots import (
    SnapshotInfo,
    compact_table,
    create_or_upsert,
    expire_snapshots,
    latest_version,
    read_changes,
    read_table,
    set_matched,
    table_exists,
    upsert,
    write_snapshot,
)

__all__ = [
    "LandingFormat",
    "SnapshotInfo",
    "archive_files",
    "compact_table",
    "create_or_upsert",
    "expire_snapshots",
    "latest_version",
    "preview",
    "read_changes",
    "read_landing",
    "read_table",
    "set_matched",
    "table_exists",
    "upsert",
    "write_files",
    "write_snapshot",
]
