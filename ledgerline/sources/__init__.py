from ledgerline.sources.tables import (  # noqa: F401
    TEST_TABLES,
    load_table,
    load_tables,
    read_csv_set,
    read_csv_with_rejects,
    rejects_by_file,
    write_csv,
    write_table,
)
