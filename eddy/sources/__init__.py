from .tables import read_table, table_path  # noqa: F401
