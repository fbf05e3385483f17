"""Column-level helpers: naming and scalar expressions."""

from orderlake.functions.naming import snake_case_columns, to_snake_case
from orderlake.functions.scalars import days_between, evaluated_once, flag, try_ratio_pct

__all__ = ["snake_case_columns", "to_snake_case", "days_between", "evaluated_once", "flag", "try_ratio_pct"]
