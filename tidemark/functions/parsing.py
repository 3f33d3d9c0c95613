"""Text to typed values. Unreadable text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the month texts accepted as YYYYMM (years 1900-2099).
MONTH_PATTERN = r"^(19|20)\d{2}(0[1-9]|1[0-2])$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_decimal(col: Column | str, precision: int = 20, scale: int = 2, decimal_sep: str = ",") -> Column:
    """Locale-formatted amount to DECIMAL, rounded half-up; NULL when it is not a number."""
    text = F.trim(_col(col))
    if decimal_sep != ".":
        text = F.translate(text, decimal_sep, ".")
    return text.try_cast(f"decimal({precision},{scale})")


def parse_integer(col: Column | str) -> Column:
    """Whole number to BIGINT; NULL when it is not one."""
    return F.trim(_col(col)).try_cast("bigint")


def parse_month(col: Column | str) -> Column:
    """YYYYMM text to the first day of that month; NULL unless the trimmed text is a valid month."""
    text = F.trim(_col(col))
    return F.when(text.rlike(MONTH_PATTERN), F.to_date(F.concat(text, F.lit("01")), "yyyyMMdd"))


def _cp1252_tables() -> tuple[str, str]:
    """Code points 0x80-0x9F as ISO-8859-1 shows them, and the characters windows-1252 means by them.

    The bytes that windows-1252 leaves undefined become U+FFFD, so that a damaged text shows.
    """
    codes = range(0x80, 0xA0)
    return "".join(map(chr, codes)), "".join(bytes([c]).decode("windows-1252", "replace") for c in codes)


def decode_cp1252(col: Column | str) -> Column:
    """Repair text read as ISO-8859-1 that was written as windows-1252.

    Spark reads ISO-8859-1 without a legacy flag but refuses windows-1252; the two
    differ only in 0x80-0x9F, so one JVM-side ``translate`` makes up the difference.
    """
    shown, meant = _cp1252_tables()
    return F.translate(_col(col), shown, meant)
