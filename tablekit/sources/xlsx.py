"""Stored cell values of one workbook, as text. Runs inside Spark tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from io import BytesIO
from posixpath import join, normpath
from typing import BinaryIO
from xml.etree import ElementTree
from xml.parsers import expat
from zipfile import ZipFile

# Fixed values of the file format: the built-in number formats that show a serial
# number as a date or a time.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}

# Parts of a format code that cannot make it a date: quoted text, escaped
# characters, and bracketed colours or conditions ([h], [mm], [ss] are times).
_FORMAT_NOISE = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)
_DATE_LETTERS = re.compile(r"[dmyhs]", re.IGNORECASE)
_CHUNK_BYTES = 1 << 16
_MOST_KEPT = 1 << 14  # as many as a sheet can have columns

Row = tuple[int, list[str | None]]

# Kinds of cells, one letter each: stored as a number that is no date, or any other.
NUMBER, OTHER = "n", "-"
Cell = tuple[str | None, str]


class Workbook:
    """Reads from the workbook's bytes, or from an open file that can seek; then only the
    parts asked for are read, a piece at a time."""

    def __init__(self, content: bytes | BinaryIO):
        self._zip = ZipFile(BytesIO(content) if isinstance(content, bytes) else content)
        book = self._xml("xl/workbook.xml")
        targets = {
            r.get("Id"): normpath(join("xl", r.get("Target"))).lstrip("/")
            for r in self._xml("xl/_rels/workbook.xml.rels")
        }
        self._sheets = {s.get("name").lower(): targets[_relation_id(s)] for s in book.findall(".//{*}sheet")}
        settings = book.find("{*}workbookPr")
        self._from_1904 = settings is not None and settings.get("date1904") in ("1", "true")
        self._date_styles = self._find_date_styles()
        self._moments = _Memo(lambda stored: serial_to_text(float(stored), self._from_1904))
        self._texts: list[str] | None = None

    def rows(self, sheet: str) -> Iterator[Row]:
        """``(row number, cells from column A on)`` of one sheet, streamed; rows
        without any cell are left out. A sheet the workbook lacks has no rows."""
        for number, cells, _ in self.rows_with_kinds(sheet):
            yield number, cells

    def rows_with_kinds(self, sheet: str) -> Iterator[tuple[int, list[str | None], str]]:
        """The same with the kinds of a row's cells, a letter for each."""
        part = self._sheets.get(sheet.lower())
        if part is None:
            return
        feed = _row_parser(self._value)
        with self._zip.open(part) as stream:
            while chunk := stream.read(_CHUNK_BYTES):
                yield from feed(chunk, False)
        yield from feed(b"", True)

    def _value(self, kind: str, style: str | None, stored: str) -> Cell:
        """Text and kind of a cell from its type, style number and stored value; the stored
        value itself where it cannot be one of that type, for a rule to reject."""
        if kind == "n" and style not in self._date_styles:
            return stored, NUMBER
        if kind == "e":
            return None, OTHER
        if kind == "b":
            return {"1": "true", "0": "false"}.get(stored, stored), OTHER
        texts = self._shared_texts() if kind == "s" else None
        try:
            if texts is not None:
                return texts[int(stored)], OTHER
            if kind == "n":
                return self._moments[stored], OTHER
        except (ValueError, IndexError, OverflowError):
            pass
        return stored, OTHER

    def _shared_texts(self) -> list[str]:
        """The texts that cells of all sheets refer to, read with the first that does."""
        if self._texts is None:
            self._texts = self._read_shared_texts()
        return self._texts

    def _read_shared_texts(self) -> list[str]:
        texts = []
        with self._zip.open("xl/sharedStrings.xml") as stream:
            for _, node in ElementTree.iterparse(stream):
                if node.tag.endswith("}si"):
                    texts.append(_plain_text(node))
                    node.clear()
        return texts

    def _find_date_styles(self) -> set[str]:
        """Numbers of the cell styles that show a number as a date or time."""
        if "xl/styles.xml" not in self._zip.namelist():
            return set()
        styles = self._xml("xl/styles.xml")
        custom = {
            int(f.get("numFmtId")) for f in styles.findall(".//{*}numFmt") if is_date_format(f.get("formatCode"))
        }
        cell_styles = styles.find("{*}cellXfs")
        return {
            str(i)
            for i, style in enumerate(() if cell_styles is None else cell_styles)
            if int(style.get("numFmtId", 0)) in DATE_FORMATS | custom
        }

    def _xml(self, part: str) -> ElementTree.Element:
        return ElementTree.fromstring(self._zip.read(part))


class _Memo(dict):
    """Results of a function of one string, each worked out once as long as there are not
    too many to keep."""

    def __init__(self, function: Callable[[str], object]):
        super().__init__()
        self._function = function

    def __missing__(self, key: str) -> object:
        result = self._function(key)
        if len(self) == _MOST_KEPT:
            self.clear()
        self[key] = result
        return result


def _row_parser(
    value_of: Callable[[str, str | None, str], Cell],
) -> Callable[[bytes, bool], list[tuple[int, list[str | None], str]]]:
    """A function that takes the next bytes of a sheet and returns the rows they end.

    Only ``v`` and ``t`` elements hold values; a ``t`` below ``rPh`` is a reading aid.
    The state is kept in local variables because this runs for every cell.
    """
    local_names = _Memo(lambda tag: tag.rpartition(":")[2])  # without a namespace prefix
    positions = _Memo(column_index)
    rows: list[tuple[int, list[str | None], str]] = []
    cells: list[str | None] = []
    kinds: list[str] = []
    attributes: dict[str, str] = {}
    stored: list[str] = []
    number = 0
    has_value = reading = phonetic = False

    def start(tag: str, found: dict[str, str]) -> None:
        nonlocal cells, kinds, attributes, number, has_value, reading, phonetic
        name = local_names[tag]
        if name == "c":
            attributes = found
            has_value = False
            stored.clear()
        elif name == "v" or name == "t":
            reading = not phonetic
            has_value = has_value or reading
        elif name == "row":
            number = int(found.get("r", number + 1))
            cells, kinds = [], []
        elif name == "rPh":
            phonetic = True

    def text(data: str) -> None:
        if reading:
            stored.append(data)

    def end(tag: str) -> None:
        nonlocal reading, phonetic
        name = local_names[tag]
        if name == "v" or name == "t":
            reading = False
        elif name == "c":
            reference = attributes.get("r")
            position = positions[reference.rstrip("0123456789")] if reference else len(cells)
            while len(cells) <= position:
                cells.append(None)
                kinds.append(OTHER)
            if has_value:
                cells[position], kinds[position] = value_of(attributes.get("t", "n"), attributes.get("s"), "".join(stored))
        elif name == "row" and cells:
            rows.append((number, cells, "".join(kinds)))
        elif name == "rPh":
            phonetic = False

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text

    def feed(chunk: bytes, last: bool) -> list[tuple[int, list[str | None], str]]:
        nonlocal rows
        rows = []
        parser.Parse(chunk, last)
        return rows

    return feed


def _plain_text(node: ElementTree.Element) -> str:
    """Text of a string item: its own, or that of its rich-text runs."""
    parts = [node, *node.findall("{*}r")]
    return "".join(part.findtext("{*}t") or "" for part in parts)


def _relation_id(node: ElementTree.Element) -> str:
    """The ``r:id`` attribute, whose namespace differs between the format's variants."""
    return next(value for name, value in node.items() if name.endswith("}id"))


def column_index(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def is_date_format(code: str) -> bool:
    return bool(_DATE_LETTERS.search(_FORMAT_NOISE.sub("", code)))


def serial_to_text(serial: float, from_1904: bool = False) -> str:
    """A date serial as ISO text, exact to the millisecond.

    In the 1900 system day 60 is a 29 February that never was, so the days before
    it count from one day later.
    """
    if from_1904:
        origin = datetime(1904, 1, 1)
    else:
        origin = datetime(1899, 12, 31) if serial < 60 else datetime(1899, 12, 30)
    moment = origin + timedelta(milliseconds=round(serial * 86_400_000))
    return moment.isoformat(sep=" ", timespec="milliseconds" if moment.microsecond else "seconds")


def header_names(cells: list[str | None]) -> list[str]:
    """Column names of a header row, no two alike but for case: outer blanks go, a blank
    becomes ``_c<position>``, a repeated name gets its position appended, and one that
    is taken even so, or looks like the name of another position, an underscore."""
    stripped = [(cell or "").strip() for cell in cells]
    folded = [name.lower() for name in stripped]
    once = {name for name in folded if name and folded.count(name) == 1}
    taken = {f for i, f in enumerate(folded) if f in once and not _of_other_position(f, i)}
    names = []
    for i, name in enumerate(stripped):
        if folded[i] not in taken:
            name = f"{name}{i}" if name and folded[i] not in once else name or f"_c{i}"
            while name.lower() in taken or _of_other_position(name, i):
                name += "_"
            taken.add(name.lower())
        names.append(name)
    return names


def _of_other_position(name: str, position: int) -> bool:
    return bool(re.fullmatch(r"_c\d+", name.lower())) and name.lower() != f"_c{position}"
