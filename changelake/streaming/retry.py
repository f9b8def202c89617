"""Retries around sinks and schema changes."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException, IllegalArgumentException, ParseException, PySparkException

X = TypeVar("X")

#: Spark's error conditions that no retry mends: the statement, its names and its types are wrong. A prefix stands for all that begin so.
FINAL_CONDITIONS = ("PARSE_", "UNRESOLVED_", "TABLE_OR_VIEW_", "DATATYPE_MISMATCH", "CAST_", "DIVIDE_BY_ZERO", "UNSUPPORTED_", "INVALID_", "USER_RAISED_EXCEPTION")
#: Python's classes of errors that no retry mends. (ValueError holds SchemaError and ConfigError.)
FINAL_CLASSES = (ValueError, TypeError, KeyError, AttributeError, PermissionError, FileExistsError, NotImplementedError)


def is_retryable(error: BaseException) -> bool:
    """Whether the same call may succeed later: yes for what the network, files and lost executors do, no for wrong statements and values."""
    if isinstance(error, PySparkException):
        condition = error.getCondition() or ""
        return not isinstance(error, (AnalysisException, ParseException, IllegalArgumentException)) and not condition.startswith(FINAL_CONDITIONS)
    return not isinstance(error, FINAL_CLASSES)


def delay_seconds(attempt: int, base: float, cap: float = 300.0) -> float:
    return min(attempt * base, cap)


def with_retries(do: Callable[[], X], retries: int = 3, base: float = 1.0, cap: float = 300.0, sleep: Callable[[float], None] = time.sleep) -> X:
    """do(), and again up to `retries` times after errors that may pass; the delay grows by `base` each time."""
    for attempt in range(1, retries + 2):
        try:
            return do()
        except Exception as e:
            if attempt > retries or not is_retryable(e):
                raise
            sleep(delay_seconds(attempt, base, cap))
    raise AssertionError("unreachable")
