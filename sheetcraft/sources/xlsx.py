"""Minimal Office Open XML spreadsheet codec (stdlib zipfile + XML), used
inside Spark tasks: one workbook per call, streamed row by row.

Cells are returned as ``(tag, text)`` pairs: ``s`` string, ``n`` number (text
as stored), ``b`` boolean (``true``/``false``), ``d`` date-time (ISO text,
from a number with a date style), ``e`` error; ``None`` for an empty cell.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree as ET

NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
_M = "{%s}" % NS_MAIN
_C = f"{_M}c"
_ROW = f"{_M}row"
_IS = f"{_M}is"
_T = f"{_M}t"
_V = f"{_M}v"

# Built-in number formats that show dates or times (ECMA-376 18.8.30).
_DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
_EPOCH_1900 = dt.datetime(1899, 12, 30)
_EPOCH_1904 = dt.datetime(1904, 1, 1)


# --- sheet catalogs -----------------------------------------------------------


def _elements(data: bytes, part: str, name: str):
    """Elements of one local name in a part of the package, in order."""
    with zipfile.ZipFile(io.BytesIO(data)) as package, package.open(part) as raw:
        for _, element in ET.iterparse(raw):
            if element.tag.rpartition("}")[2] == name:
                yield element


def workbook_part_titles(data: bytes) -> list[str]:
    """Sheet names, in workbook order, of the workbook part."""
    return [sheet.attrib["name"] for sheet in _elements(data, "xl/workbook.xml", "sheet")]


def property_titles(data: bytes) -> list[str]:
    """Part titles that the document properties list (binary and macro books)."""
    return [leaf.text or "" for parts in _elements(data, "docProps/app.xml", "TitlesOfParts") for leaf in parts.iter() if not len(leaf)]


TITLES = {".xlsx": workbook_part_titles, ".xlsm": property_titles, ".xlsb": property_titles}


def sheet_names(path: str, data: bytes) -> list[str]:
    read = TITLES.get(posixpath.splitext(path)[1].lower())
    if read is None:
        raise NotImplementedError(f"no sheet titles in {path}: not one of {', '.join(TITLES)}")
    return read(data)


# --- reading ---------------------------------------------------------------------


_COLS: dict[str, int] = {}


def _col_index(ref: str) -> int:
    """0-based column of a cell reference such as ``AB12`` (cached by letters)."""
    letters = ref.rstrip("0123456789$")
    idx = _COLS.get(letters)
    if idx is None:
        n = 0
        for ch in letters.upper():
            if "A" <= ch <= "Z":
                n = n * 26 + (ord(ch) - 64)
        idx = _COLS[letters] = n - 1
    return idx


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()
    return bool(re.search(r"[dmyhs]", code)) and "general" not in code


def _date_styles(zf: zipfile.ZipFile) -> set[int]:
    try:
        root = ET.fromstring(zf.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    fmts = root.find(f"{_M}numFmts")
    if fmts is not None:
        for f in fmts.findall(f"{_M}numFmt"):
            custom[int(f.get("numFmtId"))] = f.get("formatCode", "")
    out = set()
    xfs = root.find(f"{_M}cellXfs")
    if xfs is not None:
        for i, xf in enumerate(xfs.findall(f"{_M}xf")):
            fid = int(xf.get("numFmtId", "0"))
            if fid in _DATE_FORMAT_IDS or (fid in custom and _is_date_format(custom[fid])):
                out.add(i)
    return out


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    try:
        data = zf.read("xl/sharedStrings.xml")
    except KeyError:
        return []
    root = ET.fromstring(data)
    return ["".join(t.text or "" for t in si.iter(f"{_M}t")) for si in root.findall(f"{_M}si")]


def _sheet_targets(zf: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    pr = wb.find(f"{_M}workbookPr")
    date1904 = pr is not None and pr.get("date1904") in ("1", "true")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall(f"{{{NS_PKG_REL}}}Relationship")}
    out = []
    sheets = wb.find(f"{_M}sheets")
    for s in sheets.findall(f"{_M}sheet") if sheets is not None else []:
        t = target.get(s.get(f"{{{NS_REL}}}id"), "")
        t = t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join("xl", t))
        out.append((s.get("name"), t))
    return out, date1904


def _serial_to_iso(text: str, date1904: bool) -> str:
    serial = float(text)
    base = _EPOCH_1904 if date1904 else _EPOCH_1900
    value = base + dt.timedelta(days=serial)
    value = value.replace(microsecond=round(value.microsecond / 1000) * 1000 % 1000000)
    return value.isoformat(sep=" ")


_ROOT_TAG = re.compile(rb"<(?:\w+:)?worksheet\b[^>]*>")
_NS_DECL = re.compile(rb'xmlns(?::[\w.-]+)?\s*=\s*"[^"]*"')
_SHEETDATA = re.compile(rb"<((?:\w+:)?)sheetData\b[^>]*?(/?)>")
_READ = 1 << 18  # small trees: a third faster than 4 MB, and less memory


def _row_elements(fh) -> Iterator[ET.Element]:
    """Row elements of a sheet part, parsed chunk by chunk: each chunk ends at
    a row boundary and is parsed by one C-level ``fromstring`` call inside a
    wrapper that re-declares the worksheet's namespaces (bounded memory)."""
    buf = b""
    eof = False

    def fill() -> bool:
        nonlocal buf, eof
        chunk = fh.read(_READ)
        if not chunk:
            eof = True
            return False
        buf += chunk
        return True

    while not eof and not _ROOT_TAG.search(buf):
        fill()
    root = _ROOT_TAG.search(buf)
    if root is None:
        return
    decls = b" ".join(_NS_DECL.findall(root.group(0)))
    while not eof and not _SHEETDATA.search(buf, root.end()):
        fill()
    sd = _SHEETDATA.search(buf, root.end())
    if sd is None or sd.group(2) == b"/":
        return
    prefix = sd.group(1)
    close_row = b"</" + prefix + b"row>"
    close_data = b"</" + prefix + b"sheetData>"
    buf = buf[sd.end():]
    head = b"<w " + decls + b">"
    while True:
        end_data = buf.find(close_data)
        if end_data >= 0:
            block, done = buf[:end_data], True
        else:
            cut = buf.rfind(close_row)
            if cut < 0 or len(buf) - cut < _READ // 2 and not eof:
                if fill():
                    continue
                cut = buf.rfind(close_row)
            if cut < 0:
                block, done = buf, True
            else:
                cut += len(close_row)
                block, buf, done = buf[:cut], buf[cut:], False
        if block.strip():
            for row in ET.fromstring(head + block + b"</w>"):
                yield row
        if done:
            return


def read_workbook(data: bytes, wanted: set[int] | set[str] | None = None) -> Iterator[tuple[int, str, int, list]]:
    """Yield ``(sheet_pos, sheet, row_index, cells)`` for the wanted sheets
    (positions or names; None = all), streaming each sheet's rows."""
    with zipfile.ZipFile(io.BytesIO(data)) as zf:
        sheets, date1904 = _sheet_targets(zf)
        if wanted is not None:
            names = {n for n, _ in sheets}
            missing = [w for w in wanted if not (w in names or (isinstance(w, int) and 0 <= w < len(sheets)))]
            if missing:
                raise ValueError(f"Worksheet(s) {missing!r} not found")
        strings = None
        dates = _date_styles(zf)
        for pos, (name, target) in enumerate(sheets):
            if wanted is not None and pos not in wanted and name not in wanted:
                continue
            if strings is None:
                strings = _shared_strings(zf)
            with zf.open(target) as fh:
                last = -1
                for el in _row_elements(fh):
                    if el.tag != _ROW:
                        continue
                    cells: list = []
                    for c in el:
                        if c.tag != _C:
                            continue
                        ref = c.get("r")
                        idx = _col_index(ref) if ref else len(cells)
                        while len(cells) < idx:
                            cells.append(None)
                        cells.append(_cell(c, strings, dates, date1904))
                    while cells and cells[-1] is None:
                        cells.pop()
                    r = el.get("r")
                    last = int(r) - 1 if r else last + 1
                    yield pos, name, last, cells


def _cell(c, strings: list[str], dates: set[int], date1904: bool):
    t = c.get("t", "n")
    if t == "inlineStr":
        is_ = c.find(_IS)
        if is_ is None:
            return None
        if len(is_) == 1 and is_[0].tag == _T:
            return ("s", is_[0].text or "")
        return ("s", "".join(x.text or "" for x in is_.iter(_T)))
    v = c.find(_V)
    if v is None or v.text is None:
        return None
    text = v.text
    if t == "s":
        return ("s", strings[int(text)])
    if t == "str":
        return ("s", text)
    if t == "b":
        return ("b", "true" if text.strip() in ("1", "true") else "false")
    if t == "e":
        return ("e", text)
    if t == "d":
        return ("d", text.replace("T", " "))
    if int(c.get("s", "0")) in dates:
        return ("d", _serial_to_iso(text, date1904))
    return ("n", text)


# --- writing --------------------------------------------------------------------


_REFUSED = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_TEXT_SPECIAL = re.compile("[&<>\r\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _esc_text(s: str) -> str:
    """Escape for element text; what XML 1.0 cannot hold raises.  A carriage
    return is written as a reference, or parsers would make it a line feed."""
    if not _TEXT_SPECIAL.search(s):
        return s
    if bad := _REFUSED.search(s):
        raise ValueError(f"a workbook cannot hold character {bad[0]!r}")
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace("\r", "&#13;")


def _esc(s: str) -> str:
    """Escape for an attribute value."""
    return _esc_text(s).replace('"', "&quot;")


def _col_name(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell_xml(ref: str, v) -> str:
    if v is None:
        return ""
    if type(v) is str:
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_esc_text(v)}</t></is></c>'
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        if isinstance(v, float) and v != v:
            return ""
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    if isinstance(v, dt.date):
        if not isinstance(v, dt.datetime):
            v = dt.datetime(v.year, v.month, v.day)
        serial = (v.replace(tzinfo=None) - _EPOCH_1900).total_seconds() / 86400.0
        return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_esc_text(str(v))}</t></is></c>'


_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/styles.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
    '<Override PartName="/docProps/app.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.extended-properties+xml"/>'
    "{sheets}</Types>"
)
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    f'<styleSheet xmlns="{NS_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm:ss"/>'
    "</numFmts><fonts count=\"1\"><font/></fonts><fills count=\"1\"><fill/></fills><borders count=\"1\"><border/>"
    '</borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0"/>'
    '<xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>'
)


_HELD = 1 << 16  # characters of rows compressed at once


class WorkbookWriter:
    """Stream rows into an xlsx file, one sheet at a time (bounded memory)."""

    def __init__(self, fh) -> None:
        self._zf = zipfile.ZipFile(fh, "w", compression=zipfile.ZIP_DEFLATED)
        self._names: list[str] = []
        self._sheet = None
        self._row = 0
        self._letters: list[str] = []
        self._rows: list[str] = []  # not yet compressed
        self._held = 0

    def start_sheet(self, name: str) -> None:
        self._end_sheet()
        self._names.append(name)
        self._sheet = self._zf.open(f"xl/worksheets/sheet{len(self._names)}.xml", "w")
        self._sheet.write(
            (f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{NS_MAIN}"><sheetData>').encode()
        )
        self._row = 0

    def write_row(self, values: Iterable) -> None:
        self._row += 1
        r = self._row
        values = list(values)
        while len(self._letters) < len(values):
            self._letters.append(_col_name(len(self._letters)))
        letters = self._letters
        body = "".join(_cell_xml(f"{letters[i]}{r}", v) for i, v in enumerate(values) if v is not None)
        self._rows.append(f'<row r="{r}">{body}</row>')
        self._held += len(body)
        if self._held >= _HELD:
            self._flush()

    def _flush(self) -> None:
        self._sheet.write("".join(self._rows).encode())
        self._rows, self._held = [], 0

    def _end_sheet(self) -> None:
        if self._sheet is not None:
            self._flush()
            self._sheet.write(b"</sheetData></worksheet>")
            self._sheet.close()
            self._sheet = None

    def close(self) -> None:
        self._end_sheet()
        n = len(self._names)
        sheet_types = "".join(
            f'<Override PartName="/xl/worksheets/sheet{i}.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            for i in range(1, n + 1)
        )
        self._zf.writestr("[Content_Types].xml", _CONTENT_TYPES.replace("{sheets}", sheet_types))
        self._zf.writestr(
            "_rels/.rels",
            f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{NS_PKG_REL}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'officeDocument" Target="xl/workbook.xml"/><Relationship Id="rId2" Type="http://schemas.openxmlformats.org'
            '/officeDocument/2006/relationships/extended-properties" Target="docProps/app.xml"/></Relationships>',
        )
        sheets = "".join(
            f'<sheet name="{_esc(nm)}" sheetId="{i}" r:id="rId{i}"/>' for i, nm in enumerate(self._names, 1)
        )
        self._zf.writestr(
            "xl/workbook.xml",
            f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><workbook xmlns="{NS_MAIN}" '
            f'xmlns:r="{NS_REL}"><sheets>{sheets}</sheets></workbook>',
        )
        rels = "".join(
            f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            f'worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, n + 1)
        )
        rels += (
            f'<Relationship Id="rId{n + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
            'relationships/styles" Target="styles.xml"/>'
        )
        self._zf.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{NS_PKG_REL}">'
            f"{rels}</Relationships>",
        )
        self._zf.writestr("xl/styles.xml", _STYLES)
        titles = "".join(f"<vt:lpstr>{_esc(nm)}</vt:lpstr>" for nm in self._names)
        self._zf.writestr(
            "docProps/app.xml",
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Properties xmlns='
            '"http://schemas.openxmlformats.org/officeDocument/2006/extended-properties" xmlns:vt='
            '"http://schemas.openxmlformats.org/officeDocument/2006/docPropsVTypes"><TitlesOfParts>'
            f'<vt:vector size="{n}" baseType="lpstr">{titles}</vt:vector></TitlesOfParts></Properties>',
        )
        self._zf.close()
