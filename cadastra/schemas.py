"""Frozen schemas of the engine's tables."""

from __future__ import annotations

FIELDS = ("sr_no", "applicant", "survey", "village_taluka", "existing_use", "proposed_use", "area_proposed", "decision")
TALUKAS = ("bardez", "bicholim", "canacona", "dharbandora", "mormugao", "pernem", "ponda", "quepem", "salcete", "sanguem", "sattari", "tiswadi")
VARIANTS = ("change_of_zone", "ndz")
STATUSES = ("pending", "processing", "parsed", "extracted", "completed", "failed")

META = "gazette_id string, source_filename string, sha256 string, page_count int"
PAGES = "gazette_id string, page_no int, text string"
TABLES = "gazette_id string, idx int, page_no int, n_rows int, n_cols int, header array<string>, grid array<array<string>>, text_before array<string>, text_after array<string>"
COLUMN_MAP = "struct<" + ", ".join(f"{f}: int" for f in FIELDS) + ">"
APPLICATION = (
    "gazette_id string, source_filename string, notification_no string, table_variant string, sr_no string, applicant string, survey_raw string, village string,"
    " taluka string, existing_use string, total_area_sqm bigint, proposed_use string, area_proposed_sqm bigint, decision string, page_from int, page_to int,"
    " confidence double, row_hash string"
)
APPLICATION_COLUMNS = tuple(c.split()[0] for c in APPLICATION.split(", "))
PLOT_COLUMNS = ("gazette_id", "notification_no", "sr_no", "survey_number", "is_part", "village", "taluka", "row_hash")
