"""Table schemas (DDL strings) and the event-field catalogue."""

from __future__ import annotations

ACCESS_EVENTS = (
    "site_id string, event_guid string, event_dt timestamp, event_dt_msk timestamp, "
    "transaction_type_id int, direction string, person_id string, territory_id string, "
    "territory_name string, zone_type string, access_point_type string, card_code string"
)
PERSONS = (
    "site_id string, person_id string, last_name string, first_name string, middle_name string, "
    "tab_number string, department_name string, synced_at timestamp"
)
STAR_EVENTS = (
    "source_id string, event_guid string, event_dt timestamp, transaction_type_id int, "
    "person_id string, territory_id string, card_code string"
)
DIM_SOURCES = "source_id string, city string, host_addr string, created_at timestamp"
DIM_PERSONS = (
    "source_id string, person_id string, last_name string, first_name string, middle_name string, "
    "tab_number string, org_id string, canonical_person_id string, synced_at timestamp"
)
DIM_ORG_UNITS = "source_id string, id string, name string, descr string, parent_id string"
DIM_TERRITORIES = (
    "source_id string, id string, type int, name string, descr string, parent_id string, "
    "component_id string, feature_mask string"
)
DIM_TRANSACTION_TYPES = "id int, name string, class_mask bigint"
LEDGER = (
    "source_id string, period_start timestamp, period_end timestamp, status string, "
    "rows_loaded int, started_at timestamp, finished_at timestamp, error_msg string"
)
ZONE_MAP = "site_id string, territory_name string, zone_type string, access_point_type string"
CARDS = "person_id string, pos bigint, card_code string, is_primary string, acc_group string"

# Columns of the event export, in order.
EXPORT_FIELDS = (
    "event_datetime", "transaction_code", "transaction_name", "territory_name", "zone_name",
    "person_id", "person_fullname", "person_lastname", "person_firstname", "department",
    "tab_number", "card_code",
)
# Leading columns of the finished export; the rest follow.
EXPORT_PRIORITY = (
    "event_datetime_local", "date", "hour", "weekday", "is_entry", "transaction_code",
    "transaction_name", "person_fullname", "department", "tab_number", "territory_name",
    "zone_name", "card_code", "person_id", "event_datetime",
)
# Positions of the two positional payload layouts.
PILOT_FIELDS = (
    "event_guid", "event_dt", "transaction_type_id", "person_id", "territory_ids", "card_code",
    "territory_name",
)
STAR_FIELDS = (
    "event_guid", "event_dt", "transaction_type_id", "person_id", "territory_ids", "card_code",
)

# Event-field catalogue.
EVENT_FIELDS = (
    "event_date", "event_time", "event_datetime", "transaction_code_10", "transaction_code_hex", "transaction_name",
    "territory_name", "territory_ids", "zone_name", "part_name", "workstation", "person_id", "person_fullname",
    "person_fullname_alt", "person_lastname", "person_firstname", "person_middlename", "tab_number", "department",
    "department_desc", "organization", "access_group", "card_code", "card_valid_from", "card_valid_to", "operator",
    "details", "summary", "heading", "message", "operator_comments",
)
