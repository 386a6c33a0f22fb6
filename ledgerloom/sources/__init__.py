from ledgerloom.sources.files import (  # noqa: F401
    export_csv,
    export_scores,
    lower_names,
    read_csv,
    read_csv_head,
    scratch_folder,
    written,
)
from ledgerloom.sources.lake import Lake, ingest_table, ingest_tables, stamp_ingest  # noqa: F401
