from vatlens.sources.bindings import Bindings, bind  # noqa: F401
from vatlens.sources.tables import (  # noqa: F401
    dates_as_text, read_catalog, read_csv, read_parquet, read_table, table_exists,
    write_csv, write_parquet,
)
