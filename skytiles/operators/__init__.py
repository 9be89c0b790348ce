from .capacity import capacity_split, cell_counts, spread_outputs, with_out_cell
from .checks import quarantine
from .grid import (assign_cell, assign_padded, bounds_row, grid_cells,
                   grid_side, cells_for_size, ra_reach)
from .histogram import (by_output, capped_histogram, cell_histogram, histogram_lines,
                        output_histogram)
from .strips import assign_strips
from .summary import bounds, footer_bounds, line_counts, object_counts, object_summary

__all__ = ["capacity_split", "cell_counts", "with_out_cell", "quarantine", "capped_histogram", "assign_cell", "assign_padded", "bounds_row",
           "grid_cells", "grid_side", "cells_for_size", "ra_reach", "cell_histogram", "histogram_lines",
           "assign_strips", "bounds", "footer_bounds", "line_counts", "object_counts",
           "object_summary", "by_output", "output_histogram",
           "spread_outputs"]
