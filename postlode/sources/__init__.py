from postlode.sources.dumps import read_array_dump, read_envelope_dump, read_json_lines
from postlode.sources.seeds import read_seed, seed_table
from postlode.sources.tables import Table, Warehouse

__all__ = [
    "Table", "Warehouse", "read_array_dump", "read_envelope_dump", "read_json_lines",
    "read_seed", "seed_table",
]
