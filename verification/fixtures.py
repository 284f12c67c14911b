"""Dirty inputs derived from the test tables, for the queries and tests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, datetime
from io import BytesIO
from math import ceil
from uuid import uuid4
from xml.sax.saxutils import escape, quoteattr
from zipfile import ZIP_DEFLATED, ZipFile

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession

from tablekit.session import input_bytes

# SQL that Spark and DuckDB both run; {name} stands for a test table.
RAW_SQL = {
    "film": """
        SELECT p_partkey AS film_id, CONCAT('  ', p_name, ' ') AS title,
          CASE WHEN p_partkey % 11 = 0 THEN ' NULL ' WHEN p_partkey % 13 = 0 THEN 'n/a'
               ELSE CAST(1990 + p_partkey % 30 AS STRING) END AS release_year,
          p_size AS rental_duration,
          CASE WHEN p_partkey % 17 = 0 THEN '$4.99'
               ELSE CONCAT(CAST(p_size AS STRING), '.99') END AS rental_rate,
          p_size * 3 AS length,
          CASE WHEN p_partkey % 19 = 0 THEN ''
               ELSE CONCAT(CAST(p_size AS STRING), '.5') END AS replacement_cost,
          p_brand AS rating, p_type AS special_features,
          'NULL' AS unused_code,
          CASE WHEN p_partkey % 7 = 0 THEN '02/15/2006'
               ELSE '2006-02-15 04:34:33' END AS last_update
        FROM {part}""",
    "store": """
        SELECT s_suppkey AS store_id, CONCAT(s_name, '  ') AS store_name,
          CASE WHEN s_suppkey % 9 = 4 THEN 'NULL' ELSE '2006-02-15 04:57:12' END AS last_update
        FROM {supplier}""",
    "inventory": """
        SELECT o_orderkey AS inventory_id, o_custkey AS film_id, o_custkey % 120 AS store_id,
          CASE WHEN o_orderkey % 23 = 0 THEN 'bad' ELSE '2006-02-15 05:09:17' END AS last_update
        FROM {orders}""",
    "customer": """
        SELECT c_custkey AS customer_id, CONCAT(' ', c_mktsegment) AS first_name,
          CASE WHEN c_custkey % 10 = 3 THEN 'NULL' ELSE c_name END AS last_name,
          CONCAT('c', CAST(c_custkey AS STRING), '@example.org') AS email,
          c_nationkey % 2 AS active,
          CASE WHEN c_custkey % 29 = 0 THEN '2006-13-45' ELSE '2006-02-14 22:04:36' END AS create_date,
          CASE WHEN c_custkey % 31 = 0 THEN 'NULL' ELSE '2006-02-15 04:57:20' END AS last_update
        FROM {customer}""",
    "rental": """
        SELECT l_orderkey * 10 + l_linenumber AS rental_id, l_orderkey AS inventory_id,
          l_partkey AS customer_id, l_suppkey AS staff_id,
          CASE WHEN l_suppkey % 37 = 0 THEN 'unknown'
               ELSE CONCAT('200', CAST(l_linenumber % 7 AS STRING), '-05-2',
                           CAST(l_linenumber % 5 AS STRING), ' 22:53:30') END AS rental_date,
          CASE WHEN l_returnflag = 'N' THEN 'NULL' ELSE '2007-05-26 22:04:30' END AS return_date,
          CASE WHEN l_partkey % 41 = 0 THEN '' ELSE '2006-02-15 21:30:53' END AS last_update
        FROM {lineitem}""",
}
# Stored bytes, by Spark's estimate, of the rows that one task makes workbooks of.
TASK_BYTES = 1 << 20

TEST_TABLES = {
    "film": "part",
    "store": "supplier",
    "inventory": "orders",
    "customer": "customer",
    "rental": "lineitem",
}


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The dirty form of ``name``, one of the keys of ``RAW_SQL``."""
    source = TEST_TABLES[name]
    return spark.sql(RAW_SQL[name], **{source: given_table(spark, sf_dir, source)})


def as_workbooks(df: DataFrame, sheet: str, rows_per_file: int = 5000) -> DataFrame:
    """``df`` as ``(path, content)`` of workbooks with at most ``rows_per_file`` rows
    each. The rows are spread first, over the cores and, as they take long to encode and
    to parse, over as many more tasks as their size asks for."""
    header = df.columns
    cores = df.sparkSession.sparkContext.defaultParallelism
    df = df.repartition(max(cores, ceil(input_bytes(df) / TASK_BYTES)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows_per_file):
                columns = batch.slice(start, rows_per_file).to_pydict().values()
                content = encode_workbook({sheet: [header, *zip(*columns)]})
                yield pa.RecordBatch.from_pydict({"path": [f"{sheet}.xlsx"], "content": [content]})

    return df.mapInArrow(encode, "path string, content binary")


def write_workbooks(workbooks: DataFrame, folder: str) -> int:
    """Write ``(path, content)`` to files of ``folder``, made where the rows are; returns
    how many. Every task attempt has names of its own: run it once, without speculation."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                system, path = FileSystem.from_uri(f"{folder}/{uuid4().hex}.xlsx")
                system.create_dir(path.rpartition("/")[0], recursive=True)
                with system.open_output_stream(path) as file:
                    file.write(content.as_py())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    written = workbooks.select("content").mapInArrow(write, "n bigint")
    return sum(row["n"] for row in written.collect())


# Fixed parts of a minimal workbook; cell style 1 is a date with time.
_RELATIONSHIPS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_STYLES = (
    f'<styleSheet xmlns="{_MAIN}">'
    '<numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm:ss"/></numFmts>'
    '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>'
)


def encode_workbook(sheets: dict[str, Sequence[Sequence]], shared_strings: bool = True) -> bytes:
    """Workbook bytes with the given rows per sheet; None leaves a cell out."""
    texts: dict[str, int] = {}
    parts = {
        f"xl/worksheets/sheet{i}.xml": _sheet_xml(rows, texts if shared_strings else None)
        for i, rows in enumerate(sheets.values(), 1)
    }
    names = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, 1)
    )
    targets = "".join(
        f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
    )
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONSHIPS}"><sheets>{names}</sheets></workbook>'
    )
    parts["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f"{targets}</Relationships>"
    )
    parts["xl/styles.xml"] = _STYLES
    items = "".join(f"<si>{_text_xml(text)}</si>" for text in texts)
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{_MAIN}">{items}</sst>'
    return zip_parts(parts)


def zip_parts(parts: dict[str, str]) -> bytes:
    buffer = BytesIO()
    with ZipFile(buffer, "w", ZIP_DEFLATED) as archive:
        for name, xml in parts.items():
            archive.writestr(name, xml)
    return buffer.getvalue()


def _sheet_xml(rows: Sequence[Sequence], texts: dict[str, int] | None) -> str:
    lines = []
    letters = [_column_letters(c) for c in range(max(map(len, rows), default=0))]
    for r, row in enumerate(rows, 1):
        cells = "".join(
            _cell_xml(f"{column}{r}", value, texts)
            for column, value in zip(letters, row)
            if value is not None
        )
        lines.append(f'<row r="{r}">{cells}</row>')
    return f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def _cell_xml(reference: str, value: object, texts: dict[str, int] | None) -> str:
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    if isinstance(value, (date, datetime)):
        moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        serial = (moment - datetime(1899, 12, 30)).total_seconds() / 86_400
        return f'<c r="{reference}" s="1"><v>{serial!r}</v></c>'
    if texts is None:
        return f'<c r="{reference}" t="inlineStr"><is>{_text_xml(str(value))}</is></c>'
    return f'<c r="{reference}" t="s"><v>{texts.setdefault(str(value), len(texts))}</v></c>'


def _text_xml(text: str) -> str:
    return f'<t xml:space="preserve">{escape(text)}</t>'


def _column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters
