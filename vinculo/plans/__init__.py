"""The composed dataflows."""

from vinculo.plans.companies import build_companies, company_starts, nest_establishments
from vinculo.plans.founders import founder_lists, label_founders
from vinculo.plans.gold import GoldConfig, Registry, build_gold, export_columns, run
from vinculo.plans.increments import add_layer, current_rows, merge_layers, refreshed_names
from vinculo.plans.links import PartnerLinks, find_links, founder_relations, link_partners
from vinculo.plans.partners import build_partner_tables, partner_rows
from vinculo.plans.roster import transform_roster

__all__ = [
    "GoldConfig",
    "PartnerLinks",
    "Registry",
    "add_layer",
    "build_companies",
    "build_gold",
    "build_partner_tables",
    "company_starts",
    "current_rows",
    "export_columns",
    "find_links",
    "founder_lists",
    "founder_relations",
    "label_founders",
    "link_partners",
    "merge_layers",
    "nest_establishments",
    "partner_rows",
    "refreshed_names",
    "run",
    "transform_roster",
]
