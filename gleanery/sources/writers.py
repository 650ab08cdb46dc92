"""Exports of listings: CSV, JSON Lines and spreadsheets.

The distributed writers leave folders of part files. The single-file writers have the rows, ordered
by id, put into text by the executors; the driver joins these parts into the file, as bytes, by a
buffer of fixed size. No row passes through it.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import attribute_column
from ..operators.reporting import scan
from ..schemas import ROW_COLUMNS
from .shared import shared_folder

IMAGE_SEPARATOR = " | "
_BASE = [c for c in ROW_COLUMNS if c != "attributes"]


#: A table of more attribute columns than this keeps its attributes as JSON.
MOST_COLUMNS = 2_000


def attribute_columns(listings: DataFrame) -> list[str] | None:
    """The sorted ``attr_`` columns of the attributes there are; None if they are more than ``MOST_COLUMNS``."""
    keys = listings.select(F.explode(F.map_keys("attributes")).alias("k")).select(attribute_column(F.col("k")).alias("c"))
    found = keys.distinct().limit(MOST_COLUMNS + 1).collect()
    return sorted(r["c"] for r in found) if len(found) <= MOST_COLUMNS else None


def flatten(listings: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Attributes as columns of their own; of keys that meet in one column the later wins. Attributes
    of too many names stay one JSON column."""
    columns = attribute_columns(listings) if columns is None else columns
    if columns is None:
        return plain(listings)
    renamed = F.transform(F.map_entries("attributes"), lambda e: F.struct(attribute_column(e["key"]).alias("k"), e["value"].alias("v")))
    out = listings.withColumns({"image_urls": F.array_join("image_urls", IMAGE_SEPARATOR), "_attrs": renamed})

    def last(column: str):
        return F.get(F.filter(F.reverse("_attrs"), lambda e: e["k"] == column), F.lit(0))["v"]

    return out.select(*_BASE, *[last(c).alias(c) for c in columns])


def plain(listings: DataFrame) -> DataFrame:
    """Attributes as one JSON column."""
    return listings.withColumns({"image_urls": F.array_join("image_urls", IMAGE_SEPARATOR), "attributes": F.to_json("attributes")}).select(*ROW_COLUMNS)


def _rows(listings: DataFrame, district: str | None, flat: bool) -> DataFrame:
    table = scan(listings, district)
    return flatten(table) if flat else plain(table)


def open_to_write(spark, path: str | Path):
    """The driver's output stream to a local path, or to the URL of any file system that Spark knows."""
    if "://" in str(path):
        target = spark._jvm.org.apache.hadoop.fs.Path(str(path))
        return target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    return spark._jvm.java.io.FileOutputStream(str(Path(path).absolute()))


_BUFFER = 1 << 20


def copy_bytes(spark, source, target) -> None:
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, target, _BUFFER, False)


def _append(rows: DataFrame, show: Callable[[list[str], list[list]], str], end: str, out) -> int:
    """Writes ``show`` of batches of rows, each followed by ``end``, to the driver's stream ``out``, in their order."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                shown = show(names, [c.to_pylist() for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array([shown], pa.string()), pa.array([batch.num_rows], pa.int64())], ["value", "n"])

    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession, "export")
    seen = Observation()
    texts = rows.mapInArrow(run, "value string, n long").observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    texts.select("value").write.option("lineSep", end).text(folder)
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [f.getPath() for f in files.listStatus(at) if f.getPath().getName().startswith("part-")]
    for part in sorted(parts, key=lambda p: (int(p.getName().split("-")[1]), p.getName())):
        source = files.open(part)
        try:
            copy_bytes(spark, source, out)
        finally:
            source.close()
    files.delete(at, True)
    return seen.get["n"]


def _cell(value):
    """Attributes hold JSON scalars; a quoted text is shown without its quotes."""
    if isinstance(value, str) and len(value) > 1 and value[0] == value[-1] == '"':
        try:
            return json.loads(value)
        except ValueError:
            return value
    return value


def _csv(lines) -> str:
    """Lines of a CSV file, the last one without its end."""
    out = io.StringIO()
    csv.writer(out).writerows(lines)
    return out.getvalue()[:-2]


def to_csv(listings: DataFrame, path: str | Path, flat: bool = True, district: str | None = None) -> int:
    """UTF-8 with a byte order mark; the header is there even without rows."""
    rows = _rows(listings, district, flat)

    def show(names: list[str], columns: list[list]) -> str:
        return _csv(["" if v is None else _cell(v) for v in row] for row in zip(*columns, strict=True))

    out = open_to_write(rows.sparkSession, path)
    try:
        out.write(bytearray(_csv([rows.columns]).encode("utf-8-sig") + b"\r\n"))
        return _append(rows, show, "\r\n", out)
    finally:
        out.close()


def _attributes(texts) -> dict:
    found = {}
    for k, v in dict(texts or {}).items():
        try:
            found[k] = json.loads(v)
        except ValueError:
            found[k] = v
    return found


def to_jsonl(listings: DataFrame, path: str | Path, district: str | None = None) -> int:
    """One object a line, nested values and non-ASCII kept, the id last."""
    order = [c for c in ROW_COLUMNS if c != "listing_id"] + ["listing_id"]

    def show(names: list[str], columns: list[list]) -> str:
        told = (dict(zip(names, row, strict=True)) for row in zip(*columns, strict=True))
        return "\n".join(json.dumps(r | {"attributes": _attributes(r["attributes"])}, ensure_ascii=False) for r in told)

    out = open_to_write(listings.sparkSession, path)
    try:
        return _append(scan(listings, district).select(*order), show, "\n", out)
    finally:
        out.close()


def _sheet_cell(value) -> str:
    value = _cell(value)
    if value is None or value == "":
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f"<c><v>{value!r}</v></c>"
    text = "".join(ch for ch in str(value) if ch in "\t\n\r" or ch >= " ")
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


SHEET = "xl/worksheets/sheet1.xml"


def to_excel(listings: DataFrame, path: str | Path, flat: bool = True, district: str | None = None) -> int:
    """One sheet with a frozen header row, written as Office Open XML."""
    rows = _rows(listings, district, flat)
    spark, ns = rows.sparkSession, "http://schemas.openxmlformats.org"

    def row(values) -> str:
        return "<row>" + "".join(map(_sheet_cell, values)) + "</row>"

    def show(names: list[str], columns: list[list]) -> str:
        return "".join(map(row, zip(*columns, strict=True)))

    z = spark._jvm.java.util.zip.ZipOutputStream(open_to_write(spark, path))

    def entry(name: str, text: str) -> None:
        z.putNextEntry(spark._jvm.java.util.zip.ZipEntry(name))
        z.write(bytearray(text.encode()))

    try:
        entry("[Content_Types].xml", f'<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        entry("_rels/.rels", f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        entry("xl/workbook.xml", f'<workbook xmlns="{ns}/spreadsheetml/2006/main" xmlns:r="{ns}/officeDocument/2006/relationships"><sheets><sheet name="Listings" sheetId="1" r:id="r1"/></sheets></workbook>')
        entry("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        entry(SHEET, f'<worksheet xmlns="{ns}/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><sheetData>' + row(rows.columns))
        n = _append(rows, show, "\n", z)
        z.write(bytearray(b"</sheetData></worksheet>"))
        return n
    finally:
        z.close()


#: Writers by file suffix.
WRITERS: dict[str, Callable] = {".csv": to_csv, ".jsonl": to_jsonl, ".json": to_jsonl, ".xlsx": to_excel, ".xlsm": to_excel}


def export(listings: DataFrame, path: str | Path, flat: bool = True, district: str | None = None) -> int:
    """Write by the path's suffix. An unknown suffix is a ValueError."""
    suffix = Path(path).suffix.lower()
    if suffix not in WRITERS:
        raise ValueError(f"unsupported output type {suffix!r}; use .csv, .jsonl or .xlsx")
    if WRITERS[suffix] is to_jsonl:
        return to_jsonl(listings, path, district)
    return WRITERS[suffix](listings, path, flat, district)


def export_all(listings: DataFrame, folder: str | Path, stem: str = "listings") -> dict[str, str]:
    """CSV and JSON Lines side by side."""
    out = {kind: f"{str(folder).rstrip('/')}/{stem}.{kind}" for kind in ("csv", "jsonl")}
    for path in out.values():
        export(listings, path)
    return out


def write_table(listings: DataFrame, path: str, by_district: bool = False) -> None:
    """A Parquet snapshot, optionally partitioned by district so that its filter prunes folders."""
    writer = listings.write.mode("overwrite")
    (writer.partitionBy("district") if by_district else writer).parquet(path)
