"""Explicit schemas of every input and stored table."""

from __future__ import annotations

# Column names and types of the stored records.
RAW_CATALOG = (
    "pl_name string, hostname string, discoverymethod string, disc_year int, "
    "pl_orbper double, pl_rade double, pl_bmasse double, pl_eqt double, "
    "st_teff double, st_rad double, st_mass double, sy_dist double"
)
RAW_COLUMNS = [part.split()[0] for part in RAW_CATALOG.split(", ")]

CLEAN_CATALOG = (
    "pl_name string, hostname string, discovery_method string, disc_year int, "
    "orbital_period_days double, radius_earth double, radius_jupiter double, "
    "mass_earth double, mass_jupiter double, equilibrium_temp_k double, "
    "stellar_teff_k double, stellar_radius_solar double, stellar_mass_solar double, "
    "distance_pc double, is_habitable_zone boolean"
)
STORED_CATALOG = CLEAN_CATALOG + ", run_id string, ingested_at timestamp, updated_at timestamp"

RUNS = (
    "run_id string, started_at timestamp, completed_at timestamp, status string, "
    "records_extracted bigint, records_validated bigint, records_failed_validation bigint, "
    "records_transformed bigint, records_loaded bigint, error_message string"
)

QUERY_CATALOG = (
    "pl_name string, hostname string, discovery_method string, disc_year int, "
    "orbital_period double, pl_rade double, pl_bmasse double, pl_eqt double, "
    "st_teff double, st_rad double, sy_dist double, ra double, dec double"
)
EXPORT_COLUMNS = [part.split()[0] for part in QUERY_CATALOG.split(", ")]

LOG_ENTRY = (
    "ts timestamp, level string, logger string, message string, context map<string,string>"
)
ALERT_RULES = (
    "name string, metric string, operator string, threshold double, "
    "window_seconds int, severity string, channels array<string>"
)
CHECK_RESULTS = (
    "check string, status string, value double, threshold double, message string, "
    "timestamp string, details string, duration_ms double"
)
CONFIG_NODES = "env string, path array<string>, kind string, value string"
TILES = "frame_id string, ty int, tx int, h int, w int, px array<double>"
