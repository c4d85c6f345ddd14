"""Whether Spark would shuffle a frame to join it, by Spark's own size estimate."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
_UNITS |= {"t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def broadcast_threshold(frame: DataFrame) -> int:
    text = frame.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


def estimated_bytes(frame: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session does not expose one."""
    try:
        statistics = frame._jdf.queryExecution().optimizedPlan().stats()
    except AttributeError:  # a remote session has no JVM plan
        return None
    return int(str(statistics.sizeInBytes()))


def shuffles_when_joined(frame: DataFrame) -> bool:
    size = estimated_bytes(frame)
    return size is None or size > broadcast_threshold(frame)
