"""Schemas and thresholds of the position analytics."""

from __future__ import annotations

ALGORITHM_VERSION = "1.2.0"

POSITIONS = (
    "ts timestamp, icao24 string, lat double, lon double, alt_baro_ft float, alt_geom_ft float, gs_kt float, track float, "
    "callsign string, nic tinyint, nac_p tinyint, sil tinyint, nic_age_s float, source string, on_ground boolean, anonymous boolean"
)

# Thresholds that results depend on.
BAD_NIC_BELOW, NIC_BINS, BAD_NACP_BELOW, LOW_ALT_FT = 5, 12, 8, 5000
ADSB_SOURCES = ("adsb_icao", "adsb_icao_nt")
MIN_AIRCRAFT, LOW_MAX_RATIO, HIGH_MIN_RATIO, BACKGROUND_RATE, SIGNIFICANCE = 5, 0.025, 0.1, 0.015, 0.01
LOW_MAX_AIRCRAFT, HIGH_MIN_AIRCRAFT, HIGH_MAX_WIDTH, LOW_MAX_COVERAGE, HIGH_MIN_COVERAGE, WILSON_Z = 20, 100, 0.08, 0.5, 0.75, 1.96
MIN_PEERS, CLEAN_PEER_SHARE, MIN_CLEAN_BUCKETS, FAULTY_SHARE = 3, 0.2, 3, 0.8
MIN_GAP_S, MAX_GAP_S, MIN_DIST_NM, MIN_SPEED_KT, EARTH_RADIUS_NM = 1, 120, 10, 1500, 3440.065
CLUSTER_NM, MIN_JUMPS_FOR_SHARED, EVENT_GAP_S, GOOD_NIC, CONVERGENCE_DEG, CONVERGENCE_WINDOW_S = 30, 4, 600, 7, 2, 600
MIN_EVENT_AIRCRAFT, SCALE_MEDIUM, SCALE_LARGE = 3, 10, 30
MAX_DETAIL_AGE_S, MAX_CORRUPT_SHARE = 60, 0.01
MAX_BAD_AIRCRAFT, MAX_CELL_AIRCRAFT, MAX_DETAIL_CELLS = 50, 100, 2000
EDGE_MARGIN_DEG = 0.05
RESOLUTIONS = (3, 4, 5)
