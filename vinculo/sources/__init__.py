"""Readers of roster and registry files, and queries over file manifests and index pages."""

from vinculo.sources.links import month_links, zip_links
from vinculo.sources.manifest import (
    choose_snapshot,
    family_of,
    first_files,
    list_files,
    natural_order,
    parse_prefixes,
    pending_files,
    select_prefixes,
)
from vinculo.sources.records import read_records
from vinculo.sources.registry import FAMILIES, Selection, file_report, read_registry, read_selected, read_table, torn_lines
from vinculo.sources.roster import conform_roster, read_roster

__all__ = [
    "FAMILIES",
    "Selection",
    "choose_snapshot",
    "conform_roster",
    "family_of",
    "file_report",
    "first_files",
    "list_files",
    "month_links",
    "natural_order",
    "parse_prefixes",
    "pending_files",
    "read_records",
    "read_registry",
    "read_roster",
    "read_selected",
    "read_table",
    "select_prefixes",
    "torn_lines",
    "zip_links",
]
