"""Column expressions; all of them stay inside the JVM."""

from vinculo.functions.dates import (
    age_bucket,
    age_years,
    day_gap,
    decade,
    parse_registry_date,
    parse_roster_date,
    safe_date,
)
from vinculo.functions.documents import (
    clean_cpf,
    full_company_number,
    registry_fragment,
    roster_fragment,
)
from vinculo.functions.privacy import keyed_hash, salt_fingerprint
from vinculo.functions.similarity import (
    may_match,
    missing_share,
    name_profile,
    name_tokens,
    token_set_match,
    token_set_ratio,
    with_token_set_ratio,
)
from vinculo.functions.text import digits_only, filled, has_name, is_present, normalize_name

__all__ = [
    "age_bucket",
    "age_years",
    "clean_cpf",
    "day_gap",
    "decade",
    "digits_only",
    "filled",
    "full_company_number",
    "has_name",
    "is_present",
    "keyed_hash",
    "may_match",
    "missing_share",
    "name_profile",
    "name_tokens",
    "normalize_name",
    "parse_registry_date",
    "parse_roster_date",
    "registry_fragment",
    "roster_fragment",
    "safe_date",
    "salt_fingerprint",
    "token_set_match",
    "token_set_ratio",
    "with_token_set_ratio",
]
