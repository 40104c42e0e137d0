"""Registered queries over the given tables, with their SQL counterparts."""

from vinculo.catalogue import flows, linking, registry, scalars
from vinculo.catalogue.entries import Entry, Tables

ENTRIES: dict[str, Entry] = {
    **scalars.ENTRIES.all,
    **registry.ENTRIES.all,
    **linking.ENTRIES.all,
    **flows.ENTRIES.all,
}

__all__ = ["ENTRIES", "Entry", "Tables"]
