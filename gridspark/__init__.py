"""gridspark: Spark-native grid telemetry fault analytics.

Operators take and return DataFrames; thresholds are arguments.  The most
used ones are re-exported here; everything else lives in the subpackages
(``sources``, ``functions``, ``operators``, ``plans``, ``streaming``).
"""
__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions and classes of this package that run in Python workers
    (the frozen-baseline walk, the stateful processor) are pickled by value,
    so executors need no installed copy of the package."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 -- older cloudpickle: ship the package instead
        pass


_ship_by_value()

from .operators.cohort import cohort_sample  # noqa: E402
from .operators.detect import detect_windowed  # noqa: E402
from .operators.detect_state import (  # noqa: E402
    detect_frozen, event_status, event_summary, score_detections,
)
from .operators.health import fault_counts, feeder_health, feeder_windows  # noqa: E402
from .operators.overlay import overlay_faults  # noqa: E402
from .operators.quality import (  # noqa: E402
    clean_readings, derive_meter_readings, expect_or_drop, expectation_report, silver_readings,
    unify_readings,
)
from .operators.waveform import flatten_waveform, pivot_channels  # noqa: E402
from .streaming.detect import detect_frozen_stream  # noqa: E402

__all__ = [
    "clean_readings", "cohort_sample", "derive_meter_readings", "detect_frozen", "detect_frozen_stream",
    "detect_windowed", "event_status", "event_summary", "expect_or_drop", "expectation_report",
    "fault_counts", "feeder_health", "feeder_windows", "flatten_waveform", "overlay_faults",
    "pivot_channels", "score_detections", "silver_readings", "unify_readings",
]
