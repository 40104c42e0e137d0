"""Writers of silver, gold and lineage output."""

from vinculo.sinks.registry_files import write_registry_files
from vinculo.sinks.writers import (
    row_counter,
    write_annotated,
    write_gold,
    write_lineage,
    write_silver,
    write_table,
)

__all__ = ["row_counter", "write_annotated", "write_gold", "write_lineage", "write_registry_files", "write_silver", "write_table"]
