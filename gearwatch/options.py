"""Options every operator takes, with the default settings of the domain."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults that results depend on.
LAGS = (1, 2)
WINDOW_SECONDS = {"1h": 3600, "4h": 4 * 3600, "8h": 8 * 3600}
EMA_ALPHAS = (0.3, 0.5, 0.7)
HORIZON_HOURS = 24
TEST_SIZE = 0.2
SENSOR_MIN = -10000.0
SENSOR_MAX = 100000.0
SEED = 42

# Column names that are recognised.
MACHINE_ALIASES = ("Product ID", "product_id", "machine_id", "Machine ID", "machine", "id")
FAILURE_ALIASES = (
    "Machine failure", "machine_failure", "Machine Failure",
    "failure", "Failure", "FAILURE",
    "target", "Target", "TARGET",
    "label", "Label", "LABEL",
)
ID_COLUMNS = ("UDI", "udi", "id", "ID", "Type", "TWF", "HDF", "PWF", "OSF", "RNF")
MODEL_EXCLUDES = ("failure", "Machine failure", "Product ID") + ID_COLUMNS

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3600 * MICROS_PER_SECOND
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


@dataclass(frozen=True)
class LogOptions:
    """Names and parameters of a sensor log.

    ``order`` holds the columns that break ties between rows of one machine at one
    instant; Spark keeps no row order, so a log needs them to be reproducible.
    """

    machine: str = "machine_id"
    time: str = "timestamp"
    order: tuple[str, ...] = ("seq",)
    failure: str = "failure"
    target: str = "failure_within_24h"
    lags: tuple[int, ...] = LAGS
    windows: tuple[tuple[str, int], ...] = tuple(WINDOW_SECONDS.items())
    alphas: tuple[float, ...] = EMA_ALPHAS
    horizon_hours: float = HORIZON_HOURS
    test_size: float = TEST_SIZE
    sensor_min: float = SENSOR_MIN
    sensor_max: float = SENSOR_MAX
    # A missing failure flag is "no failure"; True makes it count as a failure.
    missing_is_failure: bool = False
    # Rows one window group may hold before a machine is cut into segments.
    group_rows: int = 1_000_000
    # Rows one machine may have inside the widest window before panes replace frames;
    # about where the two cost the same (README, "Measured").
    dense_rows: int = 300

    @property
    def horizon_us(self) -> int:
        return int(self.horizon_hours * MICROS_PER_HOUR)

    @property
    def windows_us(self) -> list[tuple[str, int]]:
        return [(name, seconds * MICROS_PER_SECOND) for name, seconds in self.windows]
