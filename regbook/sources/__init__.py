from .delimited import load_registry, read_delimited
from .lookups import lookup, operation_dim, region_dim
from .tables import read_table

__all__ = ["load_registry", "lookup", "operation_dim", "read_delimited", "read_table", "region_dim"]
