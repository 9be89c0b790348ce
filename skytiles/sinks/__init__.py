from .cells import read_cells, read_rows, write_cells, write_rows
from .sizing import OutputSize, output_size

__all__ = ["read_cells", "read_rows", "write_cells", "write_rows", "OutputSize", "output_size"]
