"""Declared schemas; none is ever inferred."""

from __future__ import annotations

RAW = (
    "ingest_seq long, source_id string, source_name string, source_url string, title string, start_text string, date_text string, end_text string, all_day boolean, "
    "location_text string, summary_text string, price_text string, registration_url string, image_url string, city string, county string, age_min int, age_max int, "
    "extra_tags array<string>, extracted_from string, extraction_confidence double"
)
EVENT = (
    "id string, source_name string, source_url string, title string, summary string, start timestamp_ntz, end timestamp_ntz, all_day boolean, location_name string, location_address string, "
    "latitude double, longitude double, geo_confidence double, is_mappable boolean, geo_within_service_region boolean, city string, county string, age_min int, age_max int, "
    "cost_type string, price_text string, is_free boolean, price_type string, pricing_summary string, registration_required boolean, registration_fee_text string, extracted_price_text string, "
    "tags array<string>, family_friendly_score double, family_relevance_score double, family_relevance_label string, rainy_day_friendly boolean, registration_url string, image_url string, "
    "last_verified_at timestamp, extracted_from string, extraction_confidence double, short_note string"
)
CANDIDATE = (
    "candidate_id string, seed_source_name string, seed_url string, discovered_title string, discovered_date_text string, discovered_location_text string, candidate_original_url string, "
    "status string, confidence double, requires_manual_review boolean, notes string, extracted_title string, extracted_date_text string, extracted_venue string, extracted_address string, "
    "extracted_cost_text string, extracted_description_snippet string, extracted_registration_url string, original_source_name string, review_reason string, resolution_attempts int, "
    "last_resolution_error string, suggested_next_action string, discovered_at timestamp, resolved_at timestamp"
)
GEO_CACHE = "query string, latitude double, longitude double, confidence double, resolved_at timestamp"
CURATED = (
    "slug string, title string, source_url string, venue string, address string, city string, county string, summary string, price_text string, tags array<string>, "
    "run struct<start_date: string, end_date: string, start_time: string, end_time: string, days_of_week: array<string>>, "
    "dates array<struct<date: string, start_time: string, end_time: string, note: string>>, verified_on string, enabled boolean"
)
SOURCE = "id string, name string, enabled boolean"
