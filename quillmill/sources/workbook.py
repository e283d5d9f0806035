"""Workbooks (.xlsx) without a spreadsheet library: read and rendered by executors, packed by the driver.

Reading goes through Spark's binary files, so any store works. A workbook is
one file and is parsed in one task. Writing is for reports of a bounded size.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.sources.files import Files, scratch

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
MOST_REPORT_ROWS = 100_000
_UNWRITABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str]]:
    """Rows of a sheet (the first by default) as text; empty cells are empty."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        sheets = {s.get("name"): s.get(_LINK) for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[sheets[sheet] if sheet else next(iter(sheets.values()))]
        with z.open("xl/" + target.removeprefix("/xl/")) as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str] = []
                for c in row.iter(f"{_MAIN}c"):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [""] * (at + 1 - len(cells))
                    if c.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif (v := c.find(f"{_MAIN}v")) is not None and v.text is not None:
                        cells[at] = shared[int(v.text)] if c.get("t") == "s" else v.text
                yield cells
                row.clear()


def read_sheet(spark: SparkSession, path: str, columns: list[str], sheet: str | None = None) -> DataFrame:
    """The named columns of a sheet as text, with `_ord`, the row's number; a column that it lacks is empty."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows = sheet_rows(bytes(data), sheet)
                header = next(rows, [])
                places = [header.index(c) if c in header else None for c in columns]
                held = [[i, *["" if p is None or p >= len(r) else r[p] for p in places]] for i, r in enumerate(rows)]
                yield pd.DataFrame(held, columns=["_ord", *columns])

    schema = "_ord long, " + ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, schema)


def read_records(spark: SparkSession, path: str, schema: str, sheet: str | None = None) -> DataFrame:
    """A sheet's columns by name and type ("id long, name string"), with `_ord`; a cell that is not of its type is null."""
    fields = StructType.fromDDL(schema)
    rows = read_sheet(spark, path, [f.name for f in fields], sheet)
    return rows.select("_ord", *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])


@dataclass
class Sheet:
    """A sheet to be written: its header, its columns' widths, and its rows as XML, in parts."""

    header: list[str]
    widths: list[int]
    body: Iterable[bytes]


def _row(values: Iterable, style: int = 0) -> str:
    """A row of text cells in a style; null is empty. Control characters, which XML cannot hold, are left out."""
    mark = f' s="{style}"' if style else ""
    return "<row>" + "".join(f'<c t="inlineStr"{mark}><is><t xml:space="preserve">{escape(_UNWRITABLE.sub("", "" if v is None else str(v)))}</t></is></c>' for v in values) + "</row>"


def package(sheets: dict[str, Sheet], fills: dict[str, str] | None = None) -> bytes:
    """A workbook of sheets: bold header, frozen, widths, and a style for each fill from number 2 on."""
    fills = fills or {}
    styles = ["FFD9E1F2", *fills.values()]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        n = range(1, len(sheets) + 1)
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in n) + "</Types>")
        z.writestr("_rels/.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(s[:31])}" sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(n, sheets))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_LINK[1:-3]}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + f'<Relationship Id="rId{len(sheets) + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>')
        fill_xml = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in styles)
        xfs = '<xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/>' + "".join(f'<xf fillId="{i + 3}" applyFill="1"/>' for i in range(len(fills)))
        z.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet xmlns="{_MAIN[1:-1]}"><fonts><font/><font><b/></font></fonts><fills><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fill_xml}</fills><borders><border/></borders><cellStyleXfs><xf/></cellStyleXfs><cellXfs>{xfs}</cellXfs></styleSheet>')
        for i, sheet in zip(n, sheets.values()):
            cols = "".join(f'<col min="{j + 1}" max="{j + 1}" width="{w}" customWidth="1"/>' for j, w in enumerate(sheet.widths))
            with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as f:
                f.write(f'<?xml version="1.0"?><worksheet xmlns="{_MAIN[1:-1]}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>{f"<cols>{cols}</cols>" if cols else ""}<sheetData>{_row(sheet.header, 1)}'.encode())
                for part in sheet.body:
                    f.write(part)
                f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def workbook_bytes(sheets: dict[str, tuple[list[str], list[list]]], fills: dict[str, str] | None = None, fill_by: str | None = None, widest: int = 60) -> bytes:
    """A workbook of {sheet: (header, rows)} that are here already; rows are filled by a column's value."""
    style = {k: j + 2 for j, k in enumerate(fills or {})}
    made = {}
    for name, (header, rows) in sheets.items():
        by = header.index(fill_by) if fill_by in header else None
        body = ["".join(_row(r, style.get(str(r[by]), 0) if by is not None else 0) for r in rows).encode()]
        made[name] = Sheet(header, [min(widest, 2 + max([len(str(h)), *(len(str(r[j])) for r in rows)])) for j, h in enumerate(header)], body)
    return package(made, fills)


def write_workbook(spark: SparkSession, views: dict[str, DataFrame], path: str, only_filled: tuple[str, ...] = (), most: int = MOST_REPORT_ROWS, fills: dict[str, str] | None = None, fill_by: str | None = None, widest: int = 60) -> list[str]:
    """A sheet for each view, rows in its order; those in only_filled are left out if empty.

    Tasks write the rows' XML, and the driver packs these files into one, which
    takes its place when it is whole. A workbook is one file, so a view of over
    `most` rows is refused: such tables are written by write_views.
    """
    files, style, aside, sheets = Files(spark), {k: j + 2 for j, k in enumerate(fills or {})}, scratch(spark), {}
    try:
        for i, (name, df) in enumerate(views.items()):
            kept_rows = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
            sizes = [F.max(F.length(F.coalesce(F.col(f"`{c}`"), F.lit("None")))).alias(f"w{j}") for j, c in enumerate(df.columns)]
            found = kept_rows.agg(F.count("*").alias("n"), *sizes).first()
            if found.n > most:
                raise ValueError(f"{name} has over {most} rows: too many for a report")
            if not found.n and name in only_filled:
                continue
            by = df.columns.index(fill_by) if fill_by in df.columns else None

            def rendered(batches: Iterator[pd.DataFrame], by: int | None = by) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    yield pd.DataFrame({"value": [_row((None if pd.isna(v) else v for v in r), 0 if by is None else style.get(r[by], 0)) for r in batch.itertuples(index=False, name=None)]})

            kept_rows.mapInPandas(rendered, "value string").write.text(f"{aside}/{i}")
            parts = [f"{aside}/{i}/{n}" for n in files.names(f"{aside}/{i}") if n.startswith("part-")]
            widths = [min(widest, 2 + max(len(c), w or 0)) for c, w in zip(df.columns, found[1:])]
            sheets[name] = Sheet(df.columns, widths, map(files.read, parts))
        files.write(path, package(sheets, fills))
    finally:
        files.delete(aside)
    return list(sheets)


def ids_of(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column)).distinct()


def sheet_styles(data: bytes, sheet: str | None = None) -> dict:
    """What a sheet looks like: whether its header is bold and its first row frozen, columns' widths, and each row's fill colour (None without one)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book, links, styles = (ET.fromstring(z.read(f"xl/{n}")) for n in ("workbook.xml", "_rels/workbook.xml.rels", "styles.xml"))
        names = {s.get("name"): s.get(_LINK) for s in book.iter(f"{_MAIN}sheet")}
        target = {x.get("Id"): x.get("Target") for x in links}[names[sheet] if sheet else next(iter(names.values()))]
        root = ET.fromstring(z.read("xl/" + target.removeprefix("/xl/")))
    fills = [c.get("rgb") if (c := f.find(f".//{_MAIN}fgColor")) is not None else None for f in styles.find(f"{_MAIN}fills")]
    bold = [f.find(f"{_MAIN}b") is not None for f in styles.find(f"{_MAIN}fonts")]
    forms = [(bold[int(x.get("fontId", 0))], fills[int(x.get("fillId", 0))]) for x in styles.find(f"{_MAIN}cellXfs")]
    rows = [[forms[int(c.get("s", 0))] for c in row.iter(f"{_MAIN}c")] for row in root.iter(f"{_MAIN}row")]
    pane = root.find(f".//{_MAIN}pane")
    return {
        "bold": all(b for b, _ in rows[0]) if rows else False, "frozen": pane is not None and pane.get("state") == "frozen" and pane.get("ySplit") == "1",
        "widths": [float(c.get("width")) for c in root.iter(f"{_MAIN}col")], "fills": [r[0][1] if r else None for r in rows[1:]],
    }


def row_fills(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(_ord, fill) of a sheet's rows below the header, with whether it is bold and frozen."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                found = sheet_styles(bytes(data), sheet)
                yield pd.DataFrame({"_ord": range(len(found["fills"])), "fill": found["fills"], "bold": found["bold"], "frozen": found["frozen"]})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, "_ord long, fill string, bold boolean, frozen boolean")
