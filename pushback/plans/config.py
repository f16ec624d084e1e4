"""Job configuration as plain dataclasses (defaults follow the reference's base file)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pushback.sources.flight_tables import FlightWindow

# Fixed values of the reference's base configuration.
TEST_SIZE = 0.2
NIQR_RAMP_TAXI = 3.0
NIQR_FULL_TAXI = [0, 1]
NIQR_AMA_TAXI = [0, 1]
REQUIRED_TIMES = ["departure_runway_actual_time", "departure_movement_area_actual_time",
                  "departure_stand_actual_time"]
UPPERLIMIT_COUNTS = {"ramp": {"dep_stand_AMA_count": 0.3, "dep_AMA_runway_count": 0.4,
                              "arr_runway_AMA_count": 0.6}}
CROSS_VAL = {"algo": "montecarlo", "n_cv": 10}
UNIMPEDED_FRACTION_GTE = 0.9
SPEED_THRESHOLD_KNOTS = 4.0
METRICS = ["mean_absolute_error", "rmse", "MAD_residual", "median_residual"]


@dataclass
class PipelineParams:
    window: FlightWindow = field(default_factory=FlightWindow)
    test_size: float = TEST_SIZE
    random_seed: Any = 1234
    niqr: Mapping[str, Any] = field(default_factory=lambda: {
        "ramp": NIQR_RAMP_TAXI, "full": NIQR_FULL_TAXI, "ama": NIQR_AMA_TAXI})
    non_null: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "full": REQUIRED_TIMES, "ramp": REQUIRED_TIMES, "ama": REQUIRED_TIMES})
    upperlimit_counts: Mapping[str, Mapping[str, float]] | None = field(
        default_factory=lambda: UPPERLIMIT_COUNTS)
    cross_val: Mapping[str, Any] | None = field(default_factory=lambda: CROSS_VAL)
    freight_airlines: Sequence[str] | None = None
    features_core: Sequence[str] = ("departure_stand_actual", "departure_runway_actual")
    unimpeded_fraction_gte: float | None = UNIMPEDED_FRACTION_GTE
    speed_threshold_knots: float = SPEED_THRESHOLD_KNOTS
    occupancy_timeout_s: int = 3600
    occupancy_bucket: str = "hour"
    occupancy_infer_times: bool = True
    occupancy_timeout_flights: bool = True
