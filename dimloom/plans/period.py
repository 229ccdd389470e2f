"""The period of the next pull.

A pull asks for whole days, so an instant has to become a day, and the day depends
on the zone: the register's days are local ones. ``zone`` is an argument, never
the session's; ``as_of`` is the instant of asking, never the clock of a task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from zoneinfo import ZoneInfo

from dimloom.sources.state import StateStore

_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def local_day(moment: _dt.datetime | int, zone: str) -> _dt.date:
    """The calendar day in ``zone`` of an aware datetime, or of microseconds since 1970 UTC."""
    if isinstance(moment, int):
        moment = _EPOCH + _dt.timedelta(microseconds=moment)
    if moment.tzinfo is None:
        raise ValueError(f"{moment!r} has no zone: the day it lies in is not known")
    return moment.astimezone(ZoneInfo(zone)).date()


def bounds_text(first: _dt.date, last: _dt.date) -> tuple[str, str]:
    """The period as a feed's address writes it, ``dd.MM.yyyy``."""
    return first.strftime("%d.%m.%Y"), last.strftime("%d.%m.%Y")


def next_period(store: StateStore, as_of: _dt.datetime, zone: str, source: str = "short") -> tuple[_dt.date, _dt.date]:
    """(first, last) day of the next pull: from the source's current mark to the day of asking, both included.

    One start serves all feeds (the short feed's mark, unless told otherwise). The
    day of the mark is asked for again: rows of it may have come later, and
    staging drops those it holds. If the mark lies ahead of ``as_of`` (a row dated
    in the future), the period is the day of asking alone.
    """
    version, _ = store.latest()
    if version < 0:
        version = store.initialize()
    last = local_day(as_of, zone)
    return min(local_day(store.version(version).marks[source][0], zone), last), last


def days(first: _dt.date, last: _dt.date) -> Iterable[_dt.date]:
    return (first + _dt.timedelta(k) for k in range((last - first).days + 1))
