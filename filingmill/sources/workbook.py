"""A minimal XLSX writer and reader over the standard library, and an HTML summary.

One report's hand-off file is written from the driver, row by row; ``books`` reads and writes many
workbooks at once, each in a task of its own, by the same functions.
"""

from __future__ import annotations

import html
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path
from typing import IO
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession

from filingmill.operators.review import SHEETS, read_corrections
from filingmill.sources.schemas import ALLOWED

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
# The colours of validation statuses.
STATUS_COLOURS = {"failed": "FF9999", "blocked_unit_unknown": "FFCC99", "blocked_extractor_conflict": "CC99FF", "requires_manual_review": "FFFF99", "verified_with_rounding": "99CCFF", "verified": "99FF99"}
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def column_name(n: int) -> str:
    """A, B, …, Z, AA, … for 0, 1, …"""
    out = ""
    while n >= 0:
        out, n = chr(65 + n % 26) + out, n // 26 - 1
    return out


def _row(number: int, values: Iterable) -> str:
    cells = "".join(f'<c r="{column_name(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(_legal(str(v)))}</t></is></c>' for i, v in enumerate(values) if v is not None)
    return f'<row r="{number}">{cells}</row>'


def _legal(text: str) -> str:
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)


def _sheet(columns: list[str], rows: Iterable, choices: dict[int, tuple[str, ...]], coloured: Sequence[int]) -> Iterator[str]:
    yield f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><sheetData>'
    yield _row(1, columns)
    for n, r in enumerate(rows, 2):
        yield _row(n, r)
    yield "</sheetData>"
    for c in coloured:
        name = column_name(c)
        rules = "".join(f'<cfRule type="cellIs" dxfId="{k}" priority="{k + 1}" operator="equal"><formula>"{status}"</formula></cfRule>' for k, status in enumerate(STATUS_COLOURS))
        yield f'<conditionalFormatting sqref="{name}2:{name}1048576">{rules}</conditionalFormatting>'
    if choices:
        yield f'<dataValidations count="{len(choices)}">'
        for c, allowed in choices.items():
            name = column_name(c)
            yield f'<dataValidation type="list" allowBlank="1" sqref="{name}2:{name}1048576"><formula1>"{",".join(allowed)}"</formula1></dataValidation>'
        yield "</dataValidations>"
    yield "</worksheet>"


def _styles() -> str:
    fills = "".join(f'<dxf><fill><patternFill><bgColor rgb="FF{colour}"/></patternFill></fill></dxf>' for colour in STATUS_COLOURS.values())
    plain = '<fonts count="1"><font/></fonts><fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="1"><xf/></cellXfs>'
    return f'{_HEAD}<styleSheet xmlns="{_MAIN}">{plain}<dxfs count="{len(STATUS_COLOURS)}">{fills}</dxfs></styleSheet>'


def write_workbook(path: str | Path, sheets: dict[str, DataFrame]) -> None:
    """Write the sheets of a report in their fixed order; parent folders are made."""
    write_sheets(path, {s: sheets[s] for s in SHEETS if s in sheets})


def write_sheets(path: str | Path, sheets: dict[str, DataFrame]) -> None:
    """Write frames as sheets in the given order; statuses have their colours, correction actions a list to choose from."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("wb") as out:
        write_book(out, ((n, df.columns, df.toLocalIterator()) for n, df in sheets.items()))


def write_book(out: IO[bytes], sheets: Iterable[tuple[str, Sequence[str], Iterable]]) -> None:
    """Write (name, columns, rows) of the sheets one after another; one row is in memory at a time."""
    names = []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, (name, columns, rows) in enumerate(sheets, 1):
            names.append(name)
            choices = {columns.index("correction_action"): ALLOWED["correction_action"]} if "correction_action" in columns else {}
            coloured = [k for k, c in enumerate(columns) if c in ("status", "validation_status")]
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as sheet:
                for piece in _sheet(list(columns), rows, choices, coloured):
                    sheet.write(piece.encode())
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/styles.xml", _styles())
        listed = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        links += f'<Relationship Id="rId{len(names) + 1}" Type="{_REL}/styles" Target="styles.xml"/>'
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')


def _place(reference: str) -> int:
    """The column index of a cell reference such as AB7."""
    at = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        at = at * 26 + ord(letter) - 64
    return at - 1


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_MAIN}}}t"))


def sheet_rows(file: str | Path | IO[bytes], sheet: str) -> Iterator[list[str | None]]:
    """The rows of a sheet as texts, gaps null, one in memory at a time. An absent sheet raises ValueError."""
    with zipfile.ZipFile(file) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        found = [s.get(f"{{{_REL}}}id") for s in book.iter(f"{{{_MAIN}}}sheet") if s.get("name") == sheet]
        if not found:
            raise ValueError(f"the workbook has no sheet {sheet}")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_texts(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{{{_MAIN}}}si")]
        target = links[found[0]].lstrip("/")
        with z.open(target if target.startswith("xl/") else f"xl/{target}") as part:
            for _, row in ET.iterparse(part):
                if row.tag != f"{{{_MAIN}}}row":
                    continue
                held: dict[int, str | None] = {}
                for c in row.iter(f"{{{_MAIN}}}c"):
                    at = _place(c.get("r", "A"))
                    if c.get("t") == "inlineStr":
                        held[at] = _texts(c)
                    else:
                        v = c.find(f"{{{_MAIN}}}v")
                        held[at] = None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                row.clear()
                yield [held.get(i) for i in range(max(held, default=-1) + 1)]


def read_sheet(path: str | Path, sheet: str) -> list[list[str | None]]:
    """All rows of a sheet as texts, gaps null."""
    return list(sheet_rows(path, sheet))


def corrections_of(spark: SparkSession, path: str | Path) -> DataFrame:
    """The corrections sheet of a workbook, with the numbers of its rows; no other sheet is read."""
    rows = read_sheet(path, "corrections")
    head = [str(c) for c in rows[0]] if rows else []
    schema = ", ".join(["row_number int", *[f"`{c}` string" for c in head]])
    body = [(n, *[*r, *[None] * (len(head) - len(r))][: len(head)]) for n, r in enumerate(rows[1:], 2)]
    return read_corrections(spark.createDataFrame(body, schema))


def metadata_of(path: str | Path) -> dict[str, str]:
    return {r[0]: r[1] if len(r) > 1 else None for r in read_sheet(path, "_metadata")[1:] if r}


def html_summary(path: str | Path, title: str, frames: dict[str, DataFrame]) -> None:
    """A page with a table per frame, every row of it, written row by row."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("w", encoding="utf-8") as out:
        out.write(f"<!DOCTYPE html><meta charset='utf-8'>\n<h1>{html.escape(title)}</h1>\n")
        for name, df in frames.items():
            head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
            out.write(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>\n")
            for r in df.toLocalIterator():
                out.write("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>\n")
            out.write("</table>\n")
