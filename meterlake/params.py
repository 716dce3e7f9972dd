"""Operating parameters of the pipeline.

Fixed values (they must equal the reference behaviour for equal results):
  reading timestamp format   yyyy-MM-dd HH:mm:ss.SSSSSSS
  weather time format        yyyy-MM-dd HH:mm:ss
  missing-energy marker      Null   (as a substring), and the empty string
  uninformative group marker ACORN- (as a substring)
  calibration                more than 600 prior readings
  z threshold                8 in mild weather, 15 below 6.0 or above 30.0 degrees
  minimum level              reading above 6.0
  z denominator              standard deviation + 0.1
  state expiry               2 hours of processing time
  watermark                  10 minutes
  window / slide             1 hour / 30 minutes
  retention                  168 hours
  admission cap              500000 records per trigger
  alert text                 "Z-Score: <z, 2 places>"
                             "ALERT CRITICO: Picco anomalo con clima <ctx> (<z, 1 place> sigma)"
  weather context            FREDDO (cold), CALDO (hot), MITE (mild)
  weekend days               Saturday, Sunday
"""

from __future__ import annotations

from dataclasses import dataclass, replace

READING_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSS"
WEATHER_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MISSING_MARKER = "Null"
UNINFORMATIVE_GROUP = "ACORN-"

WATERMARK = "10 minutes"
WINDOW = "1 hour"
SLIDE = "30 minutes"
RETENTION_HOURS = 168.0
MAX_RECORDS_PER_TRIGGER = 500_000
# Files per micro-batch of a file stream: 8 MB message files of some 100 bytes a message make 500 000 records about six
# files; whole published time slices (FILES_PER_SLICE files) are admitted together.
MAX_FILES_PER_TRIGGER = 8

CONTEXT_COLD = "FREDDO"
CONTEXT_HOT = "CALDO"
CONTEXT_MILD = "MITE"
DEVIATION_PREFIX = "Z-Score: "
MESSAGE_PREFIX = "ALERT CRITICO: Picco anomalo con clima "
MESSAGE_SUFFIX = " sigma)"


@dataclass(frozen=True)
class DetectorParams:
    """Thresholds of the running z-score detector.

    ``value_scale`` is the number of decimal places a reading carries (meters
    report fixed-point kWh). Moments are accumulated as exact integers in that
    unit, which makes the score independent of how the history is split
    across tasks or micro-batches.
    """

    calibration: int = 600
    z_mild: float = 8.0
    z_extreme: float = 15.0
    min_level: float = 6.0
    cold: float = 6.0
    hot: float = 30.0
    sd_floor: float = 0.1
    timeout: str | None = "2 hours"
    value_scale: int = 3

    def with_(self, **kw) -> "DetectorParams":
        return replace(self, **kw)


DEFAULT_DETECTOR = DetectorParams()

# Readings beyond this magnitude (or not finite) have no fixed-point form; exact operators leave them out.
MAX_READING = 1e9
