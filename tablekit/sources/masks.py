"""Types that hold a sheet's values, found while its cells are parsed.

The same masks as in ``inference``, worked out in the parse tasks for one value after
another, and combined by position with a bitwise and. Runs inside Spark tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from decimal import Decimal
from math import isfinite
from zoneinfo import ZoneInfo

from tablekit.sources.inference import BIGINT, BOOLEAN, DOUBLE, PLAIN_DOUBLE, SPARK_DOUBLE, TIMESTAMP
from tablekit.sources.xlsx import NUMBER

_WHOLE_CELL = re.compile(r"[+-]?[0-9]+")
_NUMBER_CELL = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")
_WHOLE_TEXT = re.compile(r"0|-?[1-9][0-9]*")
_DECIMAL_TEXT = re.compile(r"-?(0|[1-9][0-9]*)\.[0-9]+(E-?[0-9]+)?")
_PLAIN_TEXT = re.compile(r"-?(0|[1-9][0-9]*)\.(0|[0-9]*[1-9])")
_MOMENT_TEXT = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{3})?")
_EXPONENT_AND_MARKS = re.compile(r"[eE].*$|[-+.]")
_SHORT = 15  # so many digits fit a double, and a bigint, whatever they are


class ColumnMasks:
    """What types accept all values seen so far, by position; None without any value."""

    def __init__(self, zone: str = "UTC"):
        self.masks: list[int | None] = []
        self._moment_exists = moments_of(zone)

    def add(self, rows: Sequence[tuple[list[str | None], str]]) -> None:
        """``rows`` are cells and kinds. A position that no type accepts is not read again."""
        width = max((len(cells) for cells, _ in rows), default=0)
        self.masks += [None] * (width - len(self.masks))
        for p in range(width):
            if self.masks[p] == 0:
                continue
            found = {(kinds[p], cells[p]) for cells, kinds in rows if len(cells) > p and cells[p] is not None}
            for kind, value in found:
                mask = number_mask(value) if kind == NUMBER else text_mask(value, self._moment_exists)
                self.masks[p] = mask if self.masks[p] is None else self.masks[p] & mask
                if not self.masks[p]:
                    break


def number_mask(value: str) -> int:
    """The types that hold a cell stored as a number."""
    if _WHOLE_CELL.fullmatch(value):
        if len(value) <= _SHORT:
            return BIGINT | DOUBLE
        as_double = DOUBLE if _digits(repr(float(value))) == _digits(value) else 0
        return as_double | (BIGINT if _fits_bigint(value) else 0)
    if _NUMBER_CELL.fullmatch(value) and isfinite(float(value)):
        return DOUBLE
    return 0


def text_mask(value: str, moment_exists: Callable[[datetime], bool]) -> int:
    """The types that hold a text so that it prints as the same text again."""
    if _WHOLE_TEXT.fullmatch(value):
        if len(value) <= _SHORT:
            return BIGINT | DOUBLE
        if not _fits_bigint(value):
            return 0
        return BIGINT | (DOUBLE if abs(int(value)) <= 2**53 else 0)
    if _DECIMAL_TEXT.fullmatch(value):
        real = float(value)
        mask = SPARK_DOUBLE if isfinite(real) and _as_printed(real) == value else 0
        if _PLAIN_TEXT.fullmatch(value) and _digits(repr(real)) == _digits(value):
            mask |= PLAIN_DOUBLE
        return mask
    if _MOMENT_TEXT.fullmatch(value):
        try:
            return TIMESTAMP if moment_exists(datetime.fromisoformat(value)) else 0
        except ValueError:
            return 0
    return BOOLEAN if value in ("true", "false") else 0


def moments_of(zone: str) -> Callable[[datetime], bool]:
    """Whether a clock time exists in the zone: not if the clocks jump over it."""
    try:
        of = ZoneInfo(zone)
    except Exception:  # an offset such as +02:00 has no jumps
        of = None
    if of is None or zone.upper() in ("UTC", "ETC/UTC", "GMT"):
        return lambda moment: True

    def exists(moment: datetime) -> bool:
        try:
            return moment.replace(tzinfo=of).astimezone(timezone.utc).astimezone(of).replace(tzinfo=None) == moment
        except OverflowError:  # the first and last day of the calendar have no jumps
            return True

    return exists


def _fits_bigint(value: str) -> bool:
    return len(value) <= 4000 and -(2**63) <= int(value) < 2**63


def _digits(number: str) -> str:
    """The significant digits of a number's text."""
    return _EXPONENT_AND_MARKS.sub("", number).strip("0")


def _as_printed(real: float) -> str:
    """The text Spark gives a double."""
    sign, digits, exponent = Decimal(repr(real)).as_tuple()
    minus, text = "-" if sign else "", "".join(map(str, digits)).rstrip("0") or "0"
    if real == 0:
        return f"{minus}0.0"
    scale = len(digits) + exponent - 1  # the power of ten of the first digit
    if -3 <= scale < 7:
        text = text.ljust(scale + 1, "0") if scale >= 0 else text.rjust(len(text) - scale, "0")
        point = max(scale, 0) + 1
        return f"{minus}{text[:point]}.{text[point:] or '0'}"
    return f"{minus}{text[0]}.{text[1:] or '0'}E{scale}"
