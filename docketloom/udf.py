"""Arrow UDFs that can be declared before there is a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(returns: str) -> Callable:
    """Like ``pandas_udf``, but the type is read when the function is first used on columns."""

    def declare(f: Callable) -> Callable[..., Column]:
        @wraps(f)
        def on(*columns: Column | str) -> Column:
            return F.pandas_udf(f, returns)(*columns)

        return on

    return declare


def array_udf(returns: str) -> Callable:
    """Like :func:`arrow_udf`, for a function from Arrow arrays to an Arrow array: nested results need no object for each element."""

    def declare(f: Callable) -> Callable[..., Column]:
        @wraps(f)
        def on(*columns: Column | str) -> Column:
            return F.arrow_udf(f, returns)(*columns)

        return on

    return declare
