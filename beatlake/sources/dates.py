"""Run dates: which input days a run covers."""

from __future__ import annotations

from datetime import date, datetime, timedelta


def _day(text: str) -> date:
    return datetime.strptime(text.strip(), "%Y-%m-%d").date()


def run_dates(text: str, as_of: date | None = None) -> list[date]:
    """Days named by ``text``.

    ``a::b`` is the inclusive range, in either order, latest day first; ``a,b,c`` the list as
    given; one date that day; ``yesterday`` and anything else the day before ``as_of``.
    """
    if "::" in text:
        ends = sorted(_day(end) for end in text.split("::")[:2])
        span = (ends[1] - ends[0]).days
        return [ends[1] - timedelta(days=back) for back in range(span + 1)]
    if "-" in text or "," in text:
        return [_day(part) for part in text.split(",")]
    return [(as_of or date.today()) - timedelta(days=1)]


def day_folder(day: date) -> str:
    """Folder of one day under an event feed or a published table."""
    return f"year={day:%Y}/month={day:%m}/day={day:%d}"


def days_glob(root: str, days: list[date]) -> str:
    """One glob for many days; days without a folder simply do not match."""
    return f"{root}/{{{','.join(sorted({day_folder(day) for day in days}))}}}"


def folder_day(folder: str) -> date | None:
    """The day of a folder as ``day_folder`` names it; None for rows without a time."""
    try:
        return date(*(int(part.split("=")[1]) for part in folder.split("/")))
    except ValueError:
        return None
