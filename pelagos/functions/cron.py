"""Cron expressions: five fields with lists, ranges, steps and names, H for a place fixed by a name, and @ short forms."""

from __future__ import annotations

import zlib
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SHORT = {"@yearly": "0 0 1 1 *", "@annually": "0 0 1 1 *", "@monthly": "0 0 1 * *", "@weekly": "0 0 * * 0", "@daily": "0 0 * * *", "@midnight": "0 0 * * *", "@hourly": "0 * * * *"}
_BOUNDS = ((0, 59), (0, 23), (1, 31), (1, 12), (0, 7))
_NAMES = ({}, {}, {}, {m: i + 1 for i, m in enumerate("JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split())}, {d: i for i, d in enumerate("SUN MON TUE WED THU FRI SAT".split())})


class Cron:
    """When an expression is due. Where both days are restricted, either may fit."""

    def __init__(self, expression: str, name: str = "") -> None:
        fields = _SHORT.get(expression.strip().lower(), expression).split()
        if len(fields) != 5:
            raise ValueError(f"five fields are needed: {expression!r}")
        self.sets = [self._field(f.upper(), i, name) for i, f in enumerate(fields)]
        if 7 in self.sets[4]:
            self.sets[4] = {d % 7 for d in self.sets[4]}
        self.free = [f.split("/")[0] == "*" for f in fields]

    @staticmethod
    def _field(text: str, at: int, name: str) -> set[int]:
        low, high = _BOUNDS[at]
        number = lambda x: _NAMES[at].get(x) if x in _NAMES[at] else int(x)
        out: set[int] = set()
        for part in text.split(","):
            span, _, step = part.partition("/")
            if span == "H":
                out.add(low + zlib.crc32(f"{name}/{at}".encode()) % (min(high, 28 if at == 2 else 6 if at == 4 else high) - low + 1))
                continue
            a, _, b = ("", "", "") if span == "*" else span.partition("-")
            first = number(a) if a else low
            last = number(b) if b else high if step or not a else first
            if not low <= first <= last <= high or (step and int(step) < 1):
                raise ValueError(f"not a range of {low} to {high}: {part!r}")
            out.update(range(first, last + 1, int(step or 1)))
        return out

    def _day(self, day: datetime) -> bool:
        here, week = day.day in self.sets[2], day.isoweekday() % 7 in self.sets[4]
        return here and week if self.free[2] or self.free[4] else here or week

    def after(self, time: datetime) -> datetime | None:
        """The next minute that is due, strictly later; none within nine years is none."""
        day = time.replace(hour=0, minute=0, second=0, microsecond=0)
        for n in range(366 * 9):
            at = day + timedelta(days=n)
            if at.month in self.sets[3] and self._day(at):
                for h in sorted(self.sets[1]):
                    for m in sorted(self.sets[0]):
                        if (found := at.replace(hour=h, minute=m)) > time:
                            return found
        return None


def next_run(at: Column, expression: str, name: str = "") -> Column:
    """The time at which a schedule is due next after ``at``."""
    known = Cron(expression, name)

    @F.pandas_udf("timestamp")
    def due(times: pd.Series) -> pd.Series:
        return pd.to_datetime(times.map(lambda t: None if pd.isna(t) else known.after(t.to_pydatetime())))

    return due(at)
