"""Posted dates of several shapes as Column expressions; the date is that of the local clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days of a relative unit.
UNITS = {"minute": 0, "hour": 0, "day": 1, "week": 7, "month": 30, "year": 365}
LABEL = "Cập nhật"
_TIME = r"(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
_ZONE = r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?"

# The shape that each source writes its dates in; the others write ISO dates.
SHAPES = {"itviec": "relative", "topdev": "day_first", "careerviet": "updated"}


def iso(raw: Column) -> Column:
    """A whole ISO date or time stamp, separated or basic; nothing may follow."""
    behind = rf"(?:.{_TIME}{_ZONE})?\s*$"
    plain = F.try_to_date(F.regexp_extract(raw, r"^\s*(\d{4}-\d{2}-\d{2})" + behind, 1), "yyyy-MM-dd")
    return F.coalesce(plain, F.try_to_date(F.regexp_extract(raw, r"^\s*(\d{8})" + behind, 1), "yyyyMMdd"))


def updated(raw: Column) -> Column:
    """The day-first date behind the label, anywhere in the text."""
    return F.try_to_date(F.regexp_extract(raw, LABEL + r":\s*(\d{2}-\d{2}-\d{4})", 1), "dd-MM-yyyy")


def day_first(raw: Column) -> Column:
    return F.try_to_date(F.regexp_extract(raw, r"^\s*(\d{2}-\d{2}-\d{4})", 1), "dd-MM-yyyy")


def relative(raw: Column, run_date: Column) -> Column:
    """The first "N units" of the text, before the run date."""
    low = F.lower(raw)
    n = F.regexp_extract(low, r"(\d+)\s*(?:minute|hour|day|week|month|year)", 1)
    unit = F.regexp_extract(low, r"\d+\s*(minute|hour|day|week|month|year)", 1)
    days = F.lit(None).cast("int")
    for name, factor in UNITS.items():
        days = F.when(unit == name, n.try_cast("int") * factor).otherwise(days)
    return F.date_sub(run_date, days)


def posted_date(raw: Column, run_date: Column, source: Column | None = None, shapes: dict[str, str] = SHAPES) -> Column:
    """The date in the shape of its source, else null; without a source, in the first shape that fits."""
    found = {"relative": relative(raw, run_date), "day_first": day_first(raw), "updated": updated(raw)}
    if source is None:
        return F.coalesce(iso(raw), *[found[k] for k in ("updated", "day_first", "relative")])
    out = iso(raw)
    for name, shape in shapes.items():
        out = F.when(source == name, found[shape]).otherwise(out)
    return out
