"""Table sinks (F1-F5) and shared-folder helpers."""

from daybook.sinks.tables import (
    append_table,
    create_or_replace_table_as,
    create_or_replace_view,
    open_table,
    overwrite_table,
    publish_staged,
    read_table,
    recover,
    scratch_path,
    shared_dir,
    stage,
    verify_write,
)

__all__ = [
    "append_table",
    "create_or_replace_table_as",
    "create_or_replace_view",
    "open_table",
    "overwrite_table",
    "publish_staged",
    "read_table",
    "recover",
    "scratch_path",
    "shared_dir",
    "stage",
    "verify_write",
]
