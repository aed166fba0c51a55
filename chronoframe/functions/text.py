"""Numbers and times as text, as engine columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exponential(x: Column, digits: int = 6) -> Column:
    """Scientific notation without zeros or a plus sign in the exponent."""
    parts = F.split(F.format_string(f"%.{digits}e", x.cast("double")), "e")
    return F.concat(parts[0], F.lit("e"), parts[1].cast("int").cast("string"))


def bar(share: Column, width: int = 28) -> Column:
    """A bar of ``width`` signs, the share of them filled."""
    n = F.bround(share * width).cast("int")
    return F.concat(F.repeat(F.lit("#"), n), F.repeat(F.lit("."), F.lit(width) - n))


def clock(seconds: Column) -> Column:
    """h:mm:ss of a number of seconds; dashes if it is unknown or negative."""
    s = F.floor(seconds).cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = F.concat(F.floor(s / 3600).cast("string"), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60))
    return F.when(seconds.isNull() | F.isnan(seconds) | (seconds < 0) | (seconds == float("inf")), "  --:--").otherwise(text)


def panel_too_large(panel: Column, width: Column, height: Column, drizzle: int, share: float = 0.3) -> Column:
    """Whether a panel takes more of the short side than it was planned for."""
    return F.coalesce(panel > share * drizzle * F.least(width, height), F.lit(False))


def few_enough(count: Column, best: Column, most: Column, limit: int = 200) -> Column:
    """Whether a segment has so few frames to stack that each is placed by one resampling."""
    return F.least(count * F.when(best > 0, best).otherwise(0.1), F.when(most > 0, most).otherwise(1_000_000)) <= limit


# The columns of a segment report, their formats and the width of its rule.
REPORT = (("file", "%-14s"), ("start", "%-6d"), ("count", "%-7d"), ("sec", "%-6.1f"), ("state", "%-11s"), ("kind", "%-6s"), ("level", "%6s"), ("med", "%9.5f"), ("p99", "%9.5f"))
REPORT_RULE = 90


def report_line(**columns: Column) -> Column:
    """A segment's line of the report, from a column for each name of ``REPORT``; a null level shows as a dash."""
    of = columns | {"level": F.coalesce(columns["level"].cast("string"), F.lit("-"))}
    return F.format_string(" ".join(form for _, form in REPORT), *(of[name] for name, _ in REPORT))
