"""Every tunable of the engine, validated once at construction."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

# The default rule set. They decide results, so they are spelled out as is.
ICP_INDUSTRIES = ("Data & Analytics", "Software", "Developer Tools", "Sales Tech", "Marketing Tech")
ADJACENT_INDUSTRIES = ("Fintech", "Healthcare", "HR Tech", "Cybersecurity", "E-commerce & Retail")
INDUSTRY_BUCKETS = (
    "Software", "Data & Analytics", "Cybersecurity", "Fintech", "Healthcare", "Marketing Tech",
    "Sales Tech", "HR Tech", "E-commerce & Retail", "Logistics", "Developer Tools", "Media",
)
HOME_COUNTRIES = ("US", "CA", "GB")
EVENT_POINTS = {"meeting": 80, "reply": 50, "web_visit": 15, "email_open": 8}
SENIORITIES = ("IC", "Manager", "Director", "VP", "C-level")
PERSONAS = ("Data/RevOps leader", "Data/RevOps practitioner", "Executive", "Other", "Unknown")
TIERS = ("A", "B", "C")
STAGES = ("New", "Engaged", "Replied", "Meeting booked")
ENRICHMENT_STATUSES = ("clay", "mock", "missing")
PROVIDERS = ("clay", "mock")
COLUMN_MAP = {
    "Domain": "domain",
    "Industry": "industry",
    "Employee Count": "employee_count",
    "Country": "hq_country",
    "Founded": "founded_year",
    "Size": "size_band",
    "Description": "description",
    "Enrich company": "matched_name",
}
OPTIONAL_COLUMNS = ("Enrich company", "Size", "Description")
ERROR_RATES = {
    "missing_title": 0.05,
    "invalid_email": 0.03,
    "stale_record": 0.03,
    "orphan_contact": 0.01,
    "duplicate_contact": 0.05,
    "conflicting_industry": 0.02,
}


@dataclass(frozen=True)
class Config:
    reference_date: str = "2026-09-27"
    stale_contact_days: int = 365
    stale_enrichment_days: int = 90

    w_fit: Decimal = Decimal("0.40")
    w_role: Decimal = Decimal("0.25")
    w_engagement: Decimal = Decimal("0.20")
    w_intent: Decimal = Decimal("0.15")
    tier_a_min: float = 62
    tier_b_min: float = 50
    icp_industries: tuple[str, ...] = ICP_INDUSTRIES
    adjacent_industries: tuple[str, ...] = ADJACENT_INDUSTRIES
    home_countries: tuple[str, ...] = HOME_COUNTRIES
    event_points: Mapping[str, float] = field(default_factory=lambda: dict(EVENT_POINTS))
    engagement_half_life_days: float = 30

    fuzzy_threshold: float = 0.9

    batch_size: int = 50
    column_map: Mapping[str, str] = field(default_factory=lambda: dict(COLUMN_MAP))
    optional_columns: tuple[str, ...] = OPTIONAL_COLUMNS
    provider_prefixes: Mapping[str, str] = field(default_factory=lambda: {"mock_": "mock"})
    default_provider: str = "clay"

    email_rewrite: str = "example_com"
    field_prefix: str = "sync_"
    listed_tiers: tuple[str, ...] = ("A", "B")

    random_seed: int = 42
    error_rates: Mapping[str, float] = field(default_factory=lambda: dict(ERROR_RATES))

    # Scale controls. They change plans and the size of slices, never which rows there are.
    hot_key_rows: int = 1_000_000   # a key with at least this many rows is salted into slices of this size
    most_rows: int | None = None    # rows of the largest input table, if known; fewer than hot_key_rows: no hot keys
    max_hot_keys: int = 10_000      # a hot key also holds at least this part of all rows, so no more can exist
    salts: int = 64                 # fewest slices a hot key is cut into
    block_names_max: int = 64       # name blocks larger than this get sub-keys before pairing
    list_slice: int = 10_000        # ids of a merge list that stand in one row, about

    def __post_init__(self) -> None:
        weights = (self.w_fit, self.w_role, self.w_engagement, self.w_intent)
        if any(w < 0 for w in weights):
            raise ValueError(f"weights must not be negative: {weights}")
        if abs(sum(weights) - 1) > Decimal("0.0001"):
            raise ValueError(f"weights must add up to 1, got {sum(weights)}")
        if self.tier_b_min > self.tier_a_min:
            raise ValueError("tier_b_min must not exceed tier_a_min")
        if not 0.7 < self.fuzzy_threshold <= 1:
            raise ValueError("fuzzy_threshold must be in (0.7, 1]")
        if self.email_rewrite not in ("example_com", "as_is"):
            raise ValueError(f"unknown email_rewrite mode {self.email_rewrite!r}")
        if min(self.salts, self.hot_key_rows, self.max_hot_keys, self.list_slice, self.batch_size) < 1:
            raise ValueError("salts, hot_key_rows, max_hot_keys, list_slice and batch_size must be positive")
