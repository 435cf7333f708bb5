"""The data-quality suite run after each build: 37 rules."""

from __future__ import annotations

from ..operators.quality import (
    Rule, accepted_range, accepted_values, not_null, relationships, unique, unique_combination,
)


def _key(table: str, column: str) -> list[Rule]:
    return [unique(table, column), not_null(table, column)]


def _dimension(table: str, key: str) -> list[Rule]:
    # A key has several versions, so it is unique only together with valid_from.
    return [unique_combination(table, [key, "valid_from"]), not_null(table, key)]


def _member(column: str, dim: str, key: str) -> list[Rule]:
    return [not_null(FACT, column), relationships(FACT, column, dim, key)]


FACT = "gold.fact_listings"

SILVER_RULES = [
    *_key("silver.listings", "listing_row_id"),
    *_key("silver.host", "host_id"),
    *_key("silver.listing_latest", "listing_id"),
    *_key("silver.nsw_lga_suburb", "suburb_name"),
    *_key("silver.nsw_lga_code", "lga_code"),
    *_key("silver.nsw_lga_code", "lga_name_upper"),
]

STAR_RULES = [
    *_dimension("gold.dim_listing", "listing_id"),
    *_dimension("gold.dim_host", "host_id"),
    *_dimension("gold.dim_lga", "lga_code"),
    *_dimension("gold.dim_suburb", "suburb_name"),
    *_key(FACT, "listing_row_id"),
    *_member("listing_id", "gold.dim_listing", "listing_id"),
    *_member("host_id", "gold.dim_host", "host_id"),
    *_member("listing_lga_code", "gold.dim_lga", "lga_code"),
    *_member("host_suburb", "gold.dim_suburb", "suburb_name"),
    accepted_range(FACT, "price", low=0),
    accepted_range(FACT, "availability_30", low=0, high=30),
    not_null(FACT, "is_active"),
    accepted_values(FACT, "is_active", [0, 1]),
]

MART_RULES = [
    unique_combination("mart.listing_neighbourhood", ["listing_neighbourhood", "month_year"]),
    unique_combination("mart.property_type",
                       ["property_type", "room_type", "accommodates", "month_year"]),
    unique_combination("mart.host_neighbourhood", ["host_neighbourhood_lga", "month_year"]),
]

ALL_RULES = [*SILVER_RULES, *STAR_RULES, *MART_RULES]
