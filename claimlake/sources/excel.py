"""Excel workbook scan (SRC-4): every sheet of every ``.xlsx`` file, one JSON
object per data row, as a distributed job (one workbook per task).

No spreadsheet library is available, so the Office Open XML parts are read
with the standard library (``zipfile`` + ``xml.etree``).  Legacy ``.xls`` is
not supported.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.sources.landing import below, unique_names

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL = re.compile(r"([A-Z]+)(\d+)")
OUT_SCHEMA = "path string, sheet_name string, file_row_number long, raw_data string"


def _col_index(ref: str) -> int:
    letters = _CELL.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    try:
        root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    except KeyError:
        return []
    out = []
    for si in root.findall("m:si", _NS):
        out.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
    return out


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
    out = []
    for s in wb.find("m:sheets", _NS).findall("m:sheet", _NS):
        rid = s.get(f"{{{_NS['r']}}}id")
        t = target.get(rid, "")
        path = t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join("xl", t))
        out.append((s.get("name"), path))
    return out


def _cell_value(c, shared: list[str]) -> str | None:
    t = c.get("t")
    if t == "inlineStr":
        return "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
    v = c.find("m:v", _NS)
    if v is None or v.text is None:
        return None
    if t == "s":
        return shared[int(v.text)]
    if t == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    return v.text


def parse_workbook(path: str, content: bytes):
    """Yield (path, sheet, row number, JSON object) for each data row."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = _shared_strings(z)
        for name, part in _sheets(z):
            root = ET.fromstring(z.read(part))
            rows = []
            for r in root.iter(f"{{{_NS['m']}}}row"):
                vals = {}
                for c in r.findall("m:c", _NS):
                    vals[_col_index(c.get("r"))] = _cell_value(c, shared)
                rows.append((int(r.get("r")), vals))
            if not rows:
                continue
            rows.sort()
            head = rows[0][1]
            # cells beyond the header and repeated header names keep keys of their own
            width = max((max(v) + 1 for _, v in rows if v), default=0)
            names = unique_names([head.get(i) or "" for i in range(width)])
            for n, (_rn, vals) in enumerate(rows[1:], start=1):
                obj = {names[i]: vals.get(i) or None for i in range(width)}
                yield path, name, n, json.dumps(obj, ensure_ascii=False, separators=(",", ":"))


def _parse_batches(it):
    for pdf in it:
        out = []
        for p, content in zip(pdf["path"], pdf["content"]):
            out.extend(parse_workbook(p, bytes(content)))
        yield pd.DataFrame(out, columns=["path", "sheet_name", "file_row_number", "raw_data"])


def read_landing_excel(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every workbook sheet; key = (tpa, file, sheet, row number)."""
    root = root.rstrip("/")
    b = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
              .filter(F.lower("path").endswith(".xlsx")).select(F.col("_metadata.file_path").alias("path"), "content"))
    rows = b.mapInPandas(_parse_batches, OUT_SCHEMA)
    rel = below(spark, F.col("path"), root)
    tpa = F.when(F.instr(rel, "/") > 0, F.split_part(rel, F.lit("/"), F.lit(1)))
    return rows.select(tpa.alias("tpa"), rel.alias("file_name"), "sheet_name", "file_row_number",
                       F.lit("EXCEL").alias("file_type"), "raw_data")


def write_test_workbook(path: str, sheets: dict[str, list[list]]) -> None:
    """Minimal .xlsx writer for fixtures (inline strings and numbers)."""
    def cell_ref(ci, ri):
        s = ""
        ci += 1
        while ci:
            ci, rem = divmod(ci - 1, 26)
            s = chr(65 + rem) + s
        return f"{s}{ri}"

    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="xml" ContentType="application/xml"/></Types>')
        sheets_xml = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml",
                   f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>{sheets_xml}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml" '
                       f'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet"/>'
                       for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_NS["rel"]}">{rels}</Relationships>')
        for i, (_n, rows) in enumerate(sheets.items()):
            body = []
            for ri, row in enumerate(rows, start=1):
                cells = []
                for ci, v in enumerate(row):
                    ref = cell_ref(ci, ri)
                    if v is None:
                        continue
                    if isinstance(v, (int, float)):
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
                body.append(f'<row r="{ri}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(body)}</sheetData></worksheet>')
