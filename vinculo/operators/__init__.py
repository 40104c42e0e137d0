"""DataFrame -> DataFrame building blocks."""

from vinculo.operators.conform import (
    add_missing,
    keep_present,
    pick_columns,
    rename_headers,
    require_columns,
)
from vinculo.operators.fuzzy import match_names
from vinculo.operators.keys import keep_keys, keep_keys_and_blanks, one_per_key, own_key, target_keys
from vinculo.operators.nesting import Lists, attach_lists, nest
from vinculo.operators.tiling import tiled_join
from vinculo.operators.window_join import within_days

__all__ = [
    "Lists",
    "add_missing",
    "attach_lists",
    "keep_keys",
    "keep_keys_and_blanks",
    "keep_present",
    "match_names",
    "nest",
    "one_per_key",
    "own_key",
    "pick_columns",
    "rename_headers",
    "require_columns",
    "target_keys",
    "tiled_join",
    "within_days",
]
