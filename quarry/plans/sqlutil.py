"""Small helpers for writing the DuckDB side of a plan."""

from ..fixed import DISCOUNT_FACTOR, DISCOUNT_MIN_QUANTITY, MISSING_CODE, TRUNCATE_MARKER, TRUNCATE_WIDTH


def MS(expr: str) -> str:  # noqa: N802
    """Epoch milliseconds of a timestamp, truncated like Spark's ``unix_millis``."""
    return f"(epoch_us({expr}) // 1000)"


def R6(expr: str) -> str:  # noqa: N802
    """Round a double to 6 places (both engines round half away from zero)."""
    return f"round({expr}, 6)"


def discount_sql(quantity: str, price: str) -> str:
    """The conditional price of :func:`quarry.operators.project.discounted_price`."""
    return f"CASE WHEN {quantity} < {DISCOUNT_MIN_QUANTITY} THEN {price} ELSE {price} * {DISCOUNT_FACTOR} END"


def truncate_sql(code: str) -> str:
    """The code of :func:`quarry.operators.nulls.truncate_code`."""
    return (f"CASE WHEN {code} IS NULL THEN '{MISSING_CODE}' WHEN length({code}) > {TRUNCATE_WIDTH} "
            f"THEN substring({code}, 1, {TRUNCATE_WIDTH}) || '{TRUNCATE_MARKER}' ELSE {code} END")
