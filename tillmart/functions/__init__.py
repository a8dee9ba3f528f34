from tillmart.functions.cells import bad_cells, cut_cells, typed_cell
from tillmart.functions.text import base_name, full_name, month_of, pack_columns

__all__ = ["bad_cells", "base_name", "cut_cells", "full_name", "month_of", "pack_columns", "typed_cell"]
