"""Everything that touches storage: the CSV lake, tables, and their slots."""
