"""Request -> response by named function.

A registry maps a function name to a column expression of the request's
argument.  Requests ``(id, func, args)`` become responses ``(id, result)``;
a request naming an unknown function becomes a dead letter instead of an
error.  The response carries the request id, so callers join on ``id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.functions.text import prefixed

# Fixed values that must equal the reference's for right results.
ADD_USER = "addUser"
ADD_USER_PREFIX = "add user:"


class FunctionRegistry:
    """``name -> (args column -> result column)``, compiled to one CASE."""

    def __init__(self) -> None:
        self._functions: dict[str, Callable[[Column], Column]] = {}

    def register(self, name: str, fn: Callable[[Column], Column]) -> FunctionRegistry:
        self._functions[name] = fn
        return self

    def names(self) -> list[str]:
        return sorted(self._functions)

    def result(self, func: Column, args: Column) -> Column:
        expr = None
        for name, fn in self._functions.items():
            cond = func == F.lit(name)
            expr = F.when(cond, fn(args)) if expr is None else expr.when(cond, fn(args))
        return expr if expr is not None else F.lit(None).cast("string")

    def known(self, func: Column) -> Column:
        return F.coalesce(func.isin(*self._functions), F.lit(False)) if self._functions else F.lit(False)


def default_registry() -> FunctionRegistry:
    return FunctionRegistry().register(ADD_USER, lambda args: prefixed(ADD_USER_PREFIX, args))


def respond(requests: DataFrame, registry: FunctionRegistry | None = None, id_col: str = "id",
            func_col: str = "func", args_col: str = "args") -> tuple[DataFrame, DataFrame]:
    """(responses ``(id, result)``, dead letters ``(id, func, args, reason)``)."""
    registry = registry or default_registry()
    known = registry.known(F.col(func_col))
    responses = (requests.where(known)
                 .select(F.col(id_col).alias("id"),
                         registry.result(F.col(func_col), F.col(args_col)).alias("result")))
    dead = (requests.where(~known)
            .select(F.col(id_col).alias("id"), F.col(func_col).alias("func"),
                    F.col(args_col).alias("args"), F.lit("unknown function").alias("reason")))
    return responses, dead
