import random
import subprocess
import sys
from datetime import date, datetime
from functools import reduce
from io import BytesIO
from operator import and_
from zipfile import ZipFile

import pytest
from pyspark.sql import functions as F

from plans import final_plan
from verification import fixtures
from verification.fixtures import as_workbooks, encode_workbook, zip_parts
from tablekit.session import path_exists

from tablekit.sources import inference, sheets, xlsx
from tablekit.sources import (
    apply_types,
    infer_types,
    read_sheet,
    scan_sheets,
    sheet_frame,
    sheet_sources,
    stage_sheets,
)
from tablekit.sources.inference import narrowest
from tablekit.sources.masks import ColumnMasks, moments_of, number_mask, text_mask
from tablekit.sources.xlsx import Workbook, column_index, header_names, is_date_format, serial_to_text

STRICT = "http://purl.oclc.org/ooxml"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def workbook_xml(sheet_rows: str, *, shared="", styles="", settings="", target="worksheets/sheet1.xml") -> bytes:
    """A workbook from raw XML, for forms the encoder does not write."""
    relations = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{relations}">{settings}'
        '<sheets><sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
        f'relationships"><Relationship Id="rId1" Target="{target}"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}"><sheetData>{sheet_rows}</sheetData></worksheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">{shared}</sst>',
    }
    if styles:
        parts["xl/styles.xml"] = f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>'
    return zip_parts(parts)


def rows_of(content: bytes, sheet: str = "Data"):
    return list(Workbook(content).rows(sheet))


def as_frame(spark, *contents):
    return spark.createDataFrame(
        [(f"{i}.xlsx", bytearray(c)) for i, c in enumerate(contents)], "path string, content binary"
    )


def test_cells_are_placed_by_reference_and_blank_rows_left_out():
    content = workbook_xml(
        '<row r="2"><c r="B2"><v>1</v></c><c r="D2"><v>2.50</v></c></row><row r="3"/>'
        '<row r="5"><c><v>7</v></c><c><v>8</v></c></row><row><c s="0"/></row>'
    )
    assert rows_of(content) == [(2, [None, "1", None, "2.50"]), (5, ["7", "8"]), (6, [None])]


def test_string_forms():
    content = workbook_xml(
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
        '<c r="C1" t="inlineStr"><is><t xml:space="preserve"> in &lt;line </t></is></c>'
        '<c r="D1" t="inlineStr"><is><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></is></c>'
        '<c r="E1" t="str"><f>A1&amp;B1</f><v>formula</v></c><c r="F1" t="b"><v>1</v></c>'
        '<c r="G1" t="e"><v>#N/A</v></c><c r="H1" t="d"><v>2020-01-02T03:04:05</v></c></row>',
        shared="<si><t>plain</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>no</t></rPh></si>",
    )
    assert rows_of(content) == [
        (1, ["plain", "rich text", " in <line ", "two runs", "formula", "true", None, "2020-01-02T03:04:05"])
    ]


def test_styled_numbers_are_dates():
    styles = (
        '<numFmts><numFmt numFmtId="170" formatCode="[Red]0.00&quot;d&quot;"/>'
        '<numFmt numFmtId="171" formatCode="[$-409]d\\-mmm\\-yy"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    )
    cells = "".join(f'<c r="{c}1" s="{s}"><v>38763.5</v></c>' for c, s in zip("ABCD", range(4)))
    content = workbook_xml(f'<row r="1">{cells}</row>', styles=styles, target="/xl/worksheets/sheet1.xml")
    moment = "2006-02-15 12:00:00"
    assert rows_of(content) == [(1, ["38763.5", moment, "38763.5", moment])]
    later = workbook_xml(f'<row r="1">{cells}</row>', styles=styles, settings='<workbookPr date1904="1"/>')
    assert rows_of(later)[0][1][1] == "2010-02-16 12:00:00"


def test_strict_variant_of_the_format():
    def strict(xml: str) -> str:
        return xml.replace("http://schemas.openxmlformats.org/spreadsheetml/2006/main", STRICT + "/spreadsheetml/main").replace(
            "http://schemas.openxmlformats.org/officeDocument/2006/relationships", STRICT + "/officeDocument/relationships"
        )

    source = ZipFile(BytesIO(encode_workbook({"Data": [["a", "at"], ["x", datetime(2020, 1, 2)]]})))
    content = zip_parts({name: strict(source.read(name).decode()) for name in source.namelist()})
    assert rows_of(content) == [(1, ["a", "at"]), (2, ["x", "2020-01-02 00:00:00"])]


@pytest.mark.parametrize(
    "serial, text",
    [
        (1, "1900-01-01 00:00:00"),
        (59, "1900-02-28 00:00:00"),
        (61, "1900-03-01 00:00:00"),
        (38763.190659722225, "2006-02-15 04:34:33"),
        (45000.000005787, "2023-03-15 00:00:00.500"),
    ],
)
def test_serials(serial, text):
    assert serial_to_text(serial) == text


@pytest.mark.parametrize(
    "code, is_date", [("yyyy-mm-dd", True), ("[h]:mm", True), ("0.00", False), ('0 "days"', False), ("[Red]#,##0", False), ("General", False)]
)
def test_format_codes(code, is_date):
    assert is_date_format(code) is is_date


def test_column_letters_and_header_names():
    assert [column_index(c) for c in ("A", "Z", "AA", "XFD")] == [0, 25, 26, 16383]
    assert header_names(["a", None, "B", "b", "", "c"]) == ["a", "_c1", "B2", "b3", "_c4", "c"]
    assert header_names(["a", "a", "a0"]) == ["a0_", "a1", "a0"]
    assert header_names([" x ", "X", "_c7", "_c3"]) == ["x0", "X1", "_c7_", "_c3"]


def test_sheet_of_many_workbooks_by_column_name(spark):
    first = encode_workbook({"film": [["id", "title"], [1, "a"], [2, None]], "store": [["s"], [9]]})
    second = encode_workbook({"Film": [["title", "ID ", "rate"], ["c", 3, 1.5, None, "beyond"]]}, shared_strings=False)
    third = encode_workbook({"store": [["s"], [8]]})
    rows = stage_sheets(as_frame(spark, first, second, third), ["film", "store"])
    film = sheet_frame(rows, "film")
    assert film.dtypes == [("id", "bigint"), ("title", "string"), ("rate", "double"), ("_c3", "string"), ("_c4", "string")]
    assert sorted(film.collect(), key=str) == [(1, "a", None, None, None), (2, None, None, None, None), (3, "c", 1.5, None, "beyond")]
    assert sorted(sheet_frame(rows, "store").collect()) == [(8,), (9,)]
    with pytest.raises(ValueError, match="no workbook has a sheet 'rental'"):
        sheet_frame(rows, "rental")


@pytest.mark.parametrize("copies", [1, 51])
def test_headers_in_any_order_and_number(spark, copies):
    orders = [["a", "b", "c"], ["c", "a", "b"], ["b"], ["a", "d"]]
    values = {"a": 1, "b": "x", "c": 2.5, "d": True}
    books = [encode_workbook({"s": [names, [values[n] for n in names], []]}) for names in orders]
    books += [encode_workbook({"s": [["a", f"only{k}"], [1, k]]}) for k in range(copies)]
    frame = sheet_frame(stage_sheets(as_frame(spark, *books), ["s"]), "s")
    assert len(frame.columns) == 4 + copies
    expected = [tuple(values[n] if n in names else None for n in "abcd") for names in orders] + [(1, None, None, None)] * copies
    assert sorted(frame.select("a", "b", "c", "d").collect(), key=str) == sorted(expected, key=str)


def test_cells_that_are_no_value_of_their_type_stay_text():
    styles = '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs>'
    cells = ['s="1"><v>9999999</v>', 's="1"><v></v>', 't="s"><v></v>', 't="s"><v>7</v>', 't="b"><v>2</v>', 's="1"><v>43832</v>']
    content = workbook_xml("<row>" + "".join(f"<c {c}</c>" for c in cells) + "</row>", styles=styles)
    assert list(Workbook(content).rows("Data")) == [(1, ["9999999", "", "", "7", "2", "2020-01-02 00:00:00"])]


def test_reading_twenty_files(spark, tmp_path):
    for i in range(20):
        rows = [["id", "name", "flag", "at"], [i, f"n{i}", i % 2 == 0, datetime(2020, 1, 1 + i, 10, 30)]]
        (tmp_path / f"book{i}.xlsx").write_bytes(encode_workbook({"s": rows}, shared_strings=i % 2 == 0))
    expected = [(i, f"n{i}", i % 2 == 0, datetime(2020, 1, 1 + i, 10, 30)) for i in range(20)]
    with read_sheet(spark, f"{tmp_path}/*.xlsx", "s") as df:
        assert df.dtypes == [("id", "bigint"), ("name", "string"), ("flag", "boolean"), ("at", "timestamp")]
        assert sorted(df.withColumn("at", F.col("at").cast("timestamp_ntz")).collect()) == expected
        (staged,) = {f.rsplit("/sheet=", 1)[0] for f in df.inputFiles()}
    assert not path_exists(spark, staged)


def test_many_rows_arrive_in_order_numbers(spark):
    content = encode_workbook({"s": [["n"], *[[i] for i in range(12_345)]]})
    scanned = scan_sheets(as_frame(spark, content), ["s"])
    totals = scanned.agg(F.count("cells"), F.count("header"), F.min("row_no"), F.max("row_no")).first()
    assert tuple(totals) == (12_345, 1, 1, 12_346)


def test_a_broken_workbook_is_named_and_hurts_its_own_sheets_only(spark):
    good = encode_workbook({"s": [["x"], [1]]})
    rows = stage_sheets(as_frame(spark, b"not a zip", good), ["s", "t"])
    for sheet in ("s", "t"):
        with pytest.raises(ValueError, match="0.xlsx: BadZipFile"):
            sheet_frame(rows, sheet)
    with ZipFile(BytesIO(encode_workbook({"a": [["x"], [1]], "b": [["y"], [2]]}))) as old:
        parts = {n: old.read(n) for n in old.namelist()}
    first = sorted(n for n in parts if "worksheets" in n)[0]
    out = BytesIO()
    with ZipFile(out, "w") as new:
        for name, data in parts.items():
            new.writestr(name, data[: len(data) // 2] if name == first else data)
    rows = stage_sheets(as_frame(spark, out.getvalue()), ["a", "b"])
    assert sheet_frame(rows, "b").collect() == [(2,)]
    with pytest.raises(ValueError, match="ExpatError"):
        sheet_frame(rows, "a")


def test_a_failed_parse_is_remembered(spark, tmp_path):
    with sheet_sources(spark, f"{tmp_path}/none/*.xlsx", ["a", "b"]) as sources:
        told = []
        for sheet in ("a", "b"):
            with pytest.raises(Exception) as found:
                sources[sheet]()
            told.append(str(found.value))
    assert told[0] == told[1] and "PATH_NOT_FOUND" in told[0]


def test_sources_parse_the_workbooks_once_for_all_sheets(spark, tmp_path):
    path = tmp_path / "book.xlsx"
    path.write_bytes(encode_workbook({"a": [["x"], [1]], "b": [["y"], ["2020-01-05 00:00:00"]]}))
    with sheet_sources(spark, str(path), ["a", "b", "c"]) as sources:
        assert sources["a"]().collect() == [(1,)]
        path.unlink()
        assert sources["b"]().dtypes == [("y", "timestamp")]
        with pytest.raises(ValueError, match="no workbook"):
            sources["c"]()
        (staged,) = {f.rsplit("/sheet=", 1)[0] for f in sources["a"]().inputFiles()}
        assert path_exists(spark, staged)
    assert not path_exists(spark, staged)


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-2", None], "bigint"),
        (["1", "2.5"], "double"),
        (["1e3", ".5"], "string"),
        (["9223372036854775808"], "string"),
        (["9007199254740993", "1"], "bigint"),
        (["9007199254740993", "1.5"], "string"),
        (["00123", "+441234"], "string"),
        (["1.5", "1.50"], "string"),
        (["true", "false"], "boolean"),
        (["true", "FALSE"], "string"),
        (["Y", "N"], "string"),
        (["1d", "2f"], "string"),
        (["2020-01-02 00:00:00", "2020-01-02 03:04:05.500"], "timestamp"),
        (["2020-01-02", "2020-01-02 03:04:05"], "string"),
        (["2020-13-02"], "string"),
        (["12:30"], "string"),
        (["1", "true"], "string"),
        (["", "1"], "string"),
        ([None, None], "string"),
    ],
)
def test_inference(spark, values, kind):
    df = spark.createDataFrame([(v, 1) for v in values], "`a.b` string, n int").repartition(3)
    assert infer_types(df) == {"a.b": kind}
    assert dict(apply_types(df, infer_types(df)).dtypes) == {"a.b": kind, "n": "int"}


@pytest.mark.parametrize(
    "values, kind",
    [
        (["12345678.5", "0.0005", "2", "1.25"], "double"),
        (["-12345678901.25", "0.00001"], "double"),
        (["12345678.5", "1.0E7"], "string"),
        (["1.0E7", "1.5"], "double"),
        (["0.12345678901234567890"], "string"),
        (["012345678.5"], "string"),
        (["12345678.50"], "string"),
    ],
)
def test_plain_decimals_are_doubles(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert infer_types(df) == {"v": kind}
    typed = [r["v"] for r in apply_types(df, infer_types(df)).collect()]
    assert typed == (values if kind == "string" else [float(v) for v in values])


@pytest.mark.parametrize(
    "stored, kind",
    [
        (["12345678.5", "1.5"], "double"),
        (["0.0005", "1"], "double"),
        (["1E+20", "5.0000000000000001E-4", "1.1000000000000001", "1.50", ".5", "1e-05"], "double"),
        (["007", "2"], "bigint"),
        (["9007199254740993", "1"], "bigint"),
        (["9007199254740993", "1.5"], "string"),
        (["9007199254740992000", "1.5"], "double"),
        (["12345678901234567890"], "string"),
        (["1e999", "1"], "string"),
        (["1d", "1"], "string"),
    ],
)
def test_number_cells_are_typed_by_kind(spark, stored, kind):
    cells = "".join(f'<row><c><v>{v}</v></c><c t="inlineStr"><is><t>{v}</t></is></c></row>' for v in stored)
    head = '<row><c t="inlineStr"><is><t>n</t></is></c><c t="inlineStr"><is><t>t</t></is></c></row>'
    rows = stage_sheets(as_frame(spark, workbook_xml(head + cells)), ["Data"])
    frame = sheet_frame(rows, "Data")
    assert dict(frame.dtypes)["n"] == kind
    read = {"double": float, "bigint": int, "string": str}[kind]
    assert sorted(r["n"] for r in frame.collect()) == sorted(map(read, stored))
    assert sorted(r["n"] for r in sheet_frame(rows, "Data", infer=False).collect()) == sorted(stored)


def test_one_text_among_numbers_keeps_the_column_text(spark):
    books = [encode_workbook({"s": [["a"], [12345678.5]]}), encode_workbook({"s": [["b", "a"], [1, "00123"]]})]
    frame = sheet_frame(stage_sheets(as_frame(spark, *books), ["s"]), "s")
    assert sorted(r["a"] for r in frame.select("a").collect()) == ["00123", "12345678.5"]
    assert dict(frame.dtypes)["b"] == "bigint"


def test_a_larger_sheet_fits_the_table_stored_from_a_smaller_one(spark, sink):
    for values in ([1.5, 2.5], [12345678.5, 0.0005, 1e20]):
        book = encode_workbook({"s": [["v"], *[[v] for v in values]]})
        sink.save(sheet_frame(stage_sheets(as_frame(spark, book), ["s"]), "s"), "loads")
    assert sorted(r["v"] for r in spark.table(sink.name("loads")).collect()) == [0.0005, 1.5, 2.5, 12345678.5, 1e20]


def test_encoder_round_trips_dates_and_markup():
    content = encode_workbook({"q & a": [["x<y", "d"], ["a&b", date(2020, 2, 29)]]})
    assert list(Workbook(content).rows("Q & A")) == [(1, ["x<y", "d"]), (2, ["a&b", "2020-02-29 00:00:00"])]


ODD_VALUES = [
    "0", "-0", "+5", "007", "12345678901234567890", "9007199254740993", "-9223372036854775808", "9223372036854775807", "9223372036854775808",
    "1.0", "1.50", "-0.0", "0.0", "0.001", "0.0005", "12345678.5", "1.0E7", "1.0E-5", "1.5E300", "1e5", "1E5", "1.0E400", ".5", "5.", "-1.25",
    "123456.789", "9999999.0", "10000000.0", "0.12345678901234567", "1.7976931348623157E308", "4.9E-324", "1d", "NaN", "Infinity", "٣", "",
    " 1", "true", "TRUE", "false", "2020-01-02 03:04:05", "2020-01-02 03:04:05.500", "2020-01-02 03:04:05.5", "2020-02-30 00:00:00",
    "2021-03-28 02:30:00", "2021-03-28 03:30:00", "0001-01-01 00:00:00", "2020-01-02", "2020-01-02T03:04:05", "9" * 5000,
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "+02:00"])
def test_masks_of_the_parse_agree_with_those_of_text_frames(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    rng = random.Random(1)
    values = [v for v in ODD_VALUES if v != "4.9E-324"]  # printed with a digit more than it needs before Java 19
    values += [f"{rng.choice(['', '-'])}{rng.randrange(10 ** rng.randrange(1, 12))}.{rng.randrange(10 ** rng.randrange(1, 8))}" for _ in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "v string").select("v", inference.text_mask(F.col("v")).alias("mask"))
    expected = {r["v"]: r["mask"] for r in frame.collect()}
    assert {v: text_mask(v, moments_of(zone)) for v in values} == expected


def test_number_cells_hold_what_they_say():
    kinds = {v: narrowest(number_mask(v)) for v in ODD_VALUES}
    assert kinds["007"] == kinds["+5"] == kinds["-0"] == kinds["9007199254740993"] == "bigint"
    assert kinds[".5"] == kinds["5."] == kinds["1e5"] == kinds["4.9E-324"] == "double"
    assert kinds["1.0E400"] == kinds["NaN"] == kinds["12345678901234567890"] == kinds["true"] == kinds[""] == "string"


def test_column_masks_merge_like_one_pass_over_all_rows():
    rows = [(["1", "x", None], "n--"), (["2.5"], "n"), ([None, None, None, "true"], "----"), (["3", "y", None, "1"], "nn--")]
    whole = ColumnMasks()
    whole.add(rows)
    parts = []
    for row in rows:
        one = ColumnMasks()
        one.add([row])
        parts.append(one.masks + [None] * (4 - len(one.masks)))
    both = [reduce(and_, [m for m in column if m is not None], -1) for column in zip(*parts)]
    assert [-1 if m is None else m for m in whole.masks] == both
    assert [narrowest(m) for m in whole.masks] == ["double", "string", "string", "string"]


def test_typing_reads_summaries_only(spark, tmp_path):
    rows = stage_sheets(as_frame(spark, encode_workbook({"s": [["a", "b"], *[[i, f"t{i}"] for i in range(3000)]]})), ["s"], str(tmp_path / "staged"))
    for part in (tmp_path / "staged").glob("sheet=s/part=cells/*.parquet"):
        part.write_bytes(b"gone")
    frame = sheet_frame(rows, "s")
    assert frame.dtypes == [("a", "bigint"), ("b", "string")]


def test_shared_strings_are_parsed_once_for_all_sheets(monkeypatch):
    parsed = []
    real = Workbook._read_shared_texts
    monkeypatch.setattr(Workbook, "_read_shared_texts", lambda self: parsed.append(1) or real(self))
    content = encode_workbook({"a": [["x"], ["one"]], "b": [["y"], ["two"]], "c": [["z"], ["one"]]})
    batches = list(sheets._parse_workbook("p", content, ["a", "b", "c"], "UTC"))
    assert sum(b.num_rows for b in batches) == 6 and len(parsed) == 1


def test_files_read_by_ranges_give_the_same(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"book {i}.xlsx").write_bytes(encode_workbook({"a": [["n", "t"], *[[k, f"text {k % 7}"] for k in range(50 * i)]], "b": [["x"], [i]]}))
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    results = []
    for ranged in (False, True):
        with sheet_sources(spark, f"{tmp_path}/book*.xlsx", ["a", "b"], ranged=ranged) as sources:
            results.append([sorted(map(tuple, sources[s]().collect())) for s in ("a", "b")])
        with sheet_sources(spark, f"{tmp_path}/*.xlsx", ["a"], ranged=ranged) as sources, pytest.raises(ValueError, match="broken.xlsx: (BadZipFile|ArrowInvalid)"):
            sources["a"]()
    assert results[0] == results[1] and len(results[0][0]) == 150


LARGE = """
import resource, sys
from tablekit.sources.sheets import _parse_workbook
rows = 0
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for batch in _parse_workbook("file://" + sys.argv[1], None, ["Data"], "UTC"):
    rows += batch.num_rows
print(rows, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_a_workbook_of_300_mb_takes_a_fraction_of_its_size(pytestconfig, tmp_path):
    path = tmp_path / "large.xlsx"
    small = workbook_xml("<row><c t='inlineStr'><is><t>h</t></is></c></row>")
    row = f"<row><c t='inlineStr'><is><t>{random.Random(2).randbytes(50_000).hex()}</t></is></c><c><v>1.5</v></c></row>".encode()
    with ZipFile(BytesIO(small)) as old, ZipFile(path, "w") as new:
        for name in old.namelist():
            if "sheet1" not in name:
                new.writestr(name, old.read(name))
        with new.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
            sheet.write(f'<worksheet xmlns="{MAIN}"><sheetData><row><c><v>1</v></c></row>'.encode())
            for _ in range(3000):
                sheet.write(row)
            sheet.write(b"</sheetData></worksheet>")
    assert path.stat().st_size > 300_000_000
    done = subprocess.run([sys.executable, "-c", LARGE, str(path)], cwd=pytestconfig.rootpath, capture_output=True, text=True, timeout=300)
    rows, megabytes = map(int, done.stdout.split())
    assert rows == 3001 and megabytes < 120, megabytes


def split_by_header(spark, n_same, n_other):
    """Rows of one hot header and of some others, staged."""
    books = [encode_workbook({"s": [["k", "v"], *[[i, f"{i:04d}" * 50] for i in range(n_same)]]})]
    books += [encode_workbook({"s": [["v", "k", f"x{i}"], ["other", n_same + i, i]]}) for i in range(n_other)]
    return stage_sheets(as_frame(spark, *books), ["s"])


def pairs_of(frame):
    return sorted((int(r["k"]), r["v"]) for r in frame.collect())


@pytest.mark.parametrize("infer", [True, False])
def test_rows_of_one_header_are_not_shuffled_to_one_task(spark, conf, infer):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    frame = sheet_frame(split_by_header(spark, 300, 2), "s", infer=infer)
    plan = final_plan(frame)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert pairs_of(frame) == [(i, f"{i:04d}" * 50) for i in range(300)] + [(300, "other"), (301, "other")]


def test_many_headers_are_joined_with_hot_ones_split(spark, conf, monkeypatch):
    monkeypatch.setattr(sheets, "_SENT_POSITIONS", 0)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.files.maxPartitionBytes", "16k")
    conf("spark.sql.files.openCostInBytes", "1k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    body = split_by_header(spark, 3000, 30).unionAll(split_by_header(spark, 3000, 0))
    frame = sheet_frame(body, "s")
    assert "skew=true" in final_plan(frame)
    expected = [(i, f"{i:04d}" * 50) for i in range(3000)]
    assert pairs_of(frame) == sorted(2 * expected + [(3000 + i, "other") for i in range(30)])


def test_workbooks_are_made_by_more_tasks_from_more_rows(spark, monkeypatch, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 20_000, 1, cores).write.parquet(str(tmp_path / "t"))
    ids = spark.read.parquet(str(tmp_path / "t"))
    assert as_workbooks(ids, "s").rdd.getNumPartitions() == cores
    monkeypatch.setattr(fixtures, "TASK_BYTES", fixtures.input_bytes(ids) // (3 * cores))
    books = as_workbooks(ids, "s")
    assert books.rdd.getNumPartitions() >= 3 * cores
    assert sorted(r["id"] for r in sheet_frame(stage_sheets(books, ["s"]), "s").collect()) == [*range(20_000)]


def test_a_repeated_date_is_worked_out_once_and_few_are_kept(monkeypatch):
    calls = []
    monkeypatch.setattr(xlsx, "serial_to_text", lambda serial, from_1904: calls.append(serial) or str(serial))
    monkeypatch.setattr(xlsx, "_MOST_KEPT", 2)
    days = [datetime(2024, 1, d) for d in (1, 1, 2, 2, 3, 3, 1)]
    rows = rows_of(encode_workbook({"Data": [[d] for d in days]}))
    assert [float(cells[0]) - 45291 for _, cells in rows] == [1, 1, 2, 2, 3, 3, 1]
    assert calls == [45292, 45293, 45294, 45292]


def test_a_batch_of_cells_is_what_its_rows_are():
    block = [(2, ["a", None], "--"), (3, [], ""), (7, [None, "b", "c"], "---")]
    by_row = [(sheets.CELLS, "p", "s", number, -5, None, cells, None, None, None, None) for number, cells, _ in block]
    assert sheets._cells_batch("p", "s", -5, block).equals(sheets._record_batch(by_row))
