"""Workbook codec, scan, sink, catalog and header inference."""

import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from sheetcraft.operators import headers as H
from sheetcraft.session import local_path, scratch_dir
from sheetcraft.sources import workbooks as W
from sheetcraft.sources import xlsx


def _book(sheets):
    buf = io.BytesIO()
    w = xlsx.WorkbookWriter(buf)
    for name, rows in sheets:
        w.start_sheet(name)
        for r in rows:
            w.write_row(r)
    w.close()
    return buf.getvalue()


def test_codec_round_trip_types():
    when = dt.datetime(2024, 1, 2, 15, 4)
    data = _book([("S & <1>", [["a", "b", "c", "d"], [1, 2.5, True, when], [None, "x", False, None]]), ("two", [["z"]])])
    assert xlsx.workbook_part_titles(data) == ["S & <1>", "two"]
    assert xlsx.property_titles(data) == ["S & <1>", "two"]
    rows = list(xlsx.read_workbook(data, {0}))
    assert rows[1][3] == [("n", "1"), ("n", "2.5"), ("b", "true"), ("d", "2024-01-02 15:04:00")]
    assert rows[2][3] == [None, ("s", "x"), ("b", "false")]
    assert [r[1] for r in xlsx.read_workbook(data, {"two"})] == ["two"]


def test_shared_strings_and_unsupported_suffix():
    data = _book([("s", [["h"], ["v"]])])
    with pytest.raises(NotImplementedError):
        xlsx.sheet_names("x.ods", data)
    # rewrite as shared strings
    zin = zipfile.ZipFile(io.BytesIO(data))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as zout:
        for item in zin.infolist():
            body = zin.read(item.filename)
            if item.filename == "xl/worksheets/sheet1.xml":
                body = body.replace(b't="inlineStr"><is><t xml:space="preserve">h</t></is>', b't="s"><v>0</v>')
            zout.writestr(item, body)
        zout.writestr(
            "xl/sharedStrings.xml",
            '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><r><t>h</t></r><r><t>i</t></r></si></sst>',
        )
    rows = list(xlsx.read_workbook(out.getvalue()))
    assert rows[0][3] == [("s", "hi")]


def test_pandas_names():
    assert W.pandas_names(["a", "a", None, "a", "b"]) == ["a", "a.1", "Unnamed: 2", "a.2", "b"]


def test_scan_sink_round_trip_and_catalog(spark):
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    out = scratch_dir(spark, "t-nation")
    man = W.write_workbooks(nation.repartition(2), out, rows_per_file=10).collect()
    assert sum(r["rows"] for r in man) == 25
    assert W.list_workbooks(spark, out).count() == len(man)
    t = W.to_table(W.scan_workbooks(spark, out))
    assert dict(t.dtypes) == {"n_nationkey": "bigint", "n_name": "string", "n_regionkey": "bigint"}
    assert t.exceptAll(nation.select([F.col(c).cast(t.schema[c].dataType) for c in t.columns])).count() == 0
    cat = W.sheet_catalog(spark, out).collect()
    assert {r["sheet"] for r in cat} == {"Sheet1"}


def test_scan_reject_mode_and_exclude(spark):
    out = scratch_dir(spark, "t-bad")
    base = local_path(out)
    with open(os.path.join(base, "good.xlsx"), "wb") as fh:
        fh.write(_book([("s", [["h"], [1]])]))
    with open(os.path.join(base, "bad.xlsx"), "wb") as fh:
        fh.write(b"nope")
    files = spark.read.format("binaryFile").load(out)
    rows = W.scan_files(files, 0, errors="reject").collect()
    assert {(os.path.basename(r["path"]), r["_row"]) for r in rows} == {("good.xlsx", 0), ("good.xlsx", 1), ("bad.xlsx", -1)}
    assert W.scan_workbooks(spark, out, exclude=["bad.xlsx"]).count() == 2
    with pytest.raises(Exception):
        W.scan_workbooks(spark, out).collect()
    cat = W.sheet_catalog(spark, out, on_error="reject").collect()
    assert any(r["error"] for r in cat)


def _sheet_files(spark, name, books):
    out = scratch_dir(spark, name)
    for i, rows in enumerate(books):
        with open(os.path.join(local_path(out), f"b{i}.xlsx"), "wb") as fh:
            fh.write(_book([("s", rows)]))
    return W.scan_workbooks(spark, out)


def test_header_inference_two_levels(spark):
    names = ["Depot"] + [f"Zone {z}" for z in ("north", "south") for _ in range(3)]
    parts = ["crates", "pallets", "drums"] * 2
    data = [[f"depot {i}", *range(i, i + 6)] for i in range(3)]
    t = H.infer_header_table(_sheet_files(spark, "t-depots", [[names, ["Depot", *parts], *data]]))
    assert t.columns == ["Depot", "Zone north", "Zone south"]
    assert t.schema["Zone south"].dataType.simpleString() == "struct<crates:bigint,pallets:bigint,drums:bigint>"
    row = t.filter(F.col("Depot") == "depot 2").first()
    assert t.count() == 3 and row["Zone south"]["pallets"] == 6
    from sheetcraft.operators.reshape import unstack_groups

    long = unstack_groups(t, ["Depot"], group_col="Zone")
    assert long.count() == 6 and long.columns == ["Depot", "Zone", "crates", "pallets", "drums"]


def test_headers_of_one_top_row_and_other_sub_rows(spark):
    top = ["id", "Infant", "Infant"]
    one = [top, [None, "Rate", "Capacity"], ["a", 1.5, 2]]
    two = [top, [None, "Capacity", "Rate"], ["b", 3, 10.5]]
    rows = {r["id"]: r["Infant"].asDict() for r in H.infer_header_table(_sheet_files(spark, "t-two", [one, two])).collect()}
    assert rows == {"a": {"Rate": 1.5, "Capacity": 2}, "b": {"Rate": 10.5, "Capacity": 3}}


def test_a_hundred_header_rows(spark):
    book = [["id", "g", "g"]] + [[None, f"l{i}", f"m{i}"] for i in range(100)] + [["x", 1, 2]]
    row = H.infer_header_table(_sheet_files(spark, "t-deep", [book])).first()
    assert row["id"] == "x" and sorted(row["g"].asDict().values()) == [1, 2]


def test_many_layouts_are_one_scan(spark):
    books = [[["id", f"only {i}", "n"], [f"r{i}", i, 2**53 + 1]] for i in range(50)]
    t = W.to_table(_sheet_files(spark, "t-many", books))
    assert t.columns[0] == "id" and len(t.columns) == 52 and t.count() == 50
    assert t.filter("id = 'r7'").select("only 7", "n").first() == (7, 2**53 + 1)
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("path#") and plan.count("MapInArrow") <= 2  # the cells and the names of the layouts


def test_what_a_workbook_cannot_hold_raises():
    assert xlsx._esc_text("a\rb<") == "a&#13;b&lt;"
    with pytest.raises(ValueError):
        xlsx._esc_text("e\x01f")


def test_header_spec_rules():
    s = H.infer_spec(["a", "b"], [["1", "2"]])
    assert s.unchanged and s.header_rows == 0
    s = H.infer_spec(["id", "x", "x.1"], [["1", "2", "3"]])
    assert s.keys == [0] and not s.unchanged
    s = H.infer_spec(["id", "g", "g.1"], [[None, "m1", None], ["7", "1", "2"]])
    assert s.header_rows == 1 and s.levels[2] == ["g", "g"]  # a blank is filled from the cell above
    s = H.infer_spec(["id", "g"], [["id", "x"]] * 3)
    assert s.header_rows == 3
    s = H.infer_spec(["v.5", "w"], [["1", "2"]], pattern=r"\.(\d+)$", repl=lambda m: "_" + m.group(1))
    assert s.names == ["v_5", "w"]


def test_null_tokens(spark):
    out = scratch_dir(spark, "t-tokens")
    with open(os.path.join(local_path(out), "n.xlsx"), "wb") as fh:
        fh.write(_book([("s", [["a", "b"], ["NA", 1], ["x", "null"], ["N/A", 3]])]))
    t = W.to_table(W.scan_workbooks(spark, out))
    rows = sorted(t.collect(), key=lambda r: str(r["a"]))
    assert [r["a"] for r in rows] == [None, None, "x"]
    assert dict(t.dtypes)["b"] == "bigint"  # "null" text is not a value, the rest are integers
    keep = W.to_table(W.scan_workbooks(spark, out), null_tokens=False)
    assert dict(keep.dtypes)["b"] == "string" and keep.filter("a = 'NA'").count() == 1


def _excel_like(date1904: bool = False) -> bytes:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    pr = '<workbookPr date1904="1"/>' if date1904 else "<workbookPr/>"
    files = {
        "[Content_Types].xml": "<Types/>",
        "xl/workbook.xml": f'<workbook {ns} {rel}>{pr}<sheets><sheet name="Data &amp; More" sheetId="1" r:id="rId7"/>'
        "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId7" Type="worksheet" Target="/xl/worksheets/data.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {ns}><numFmts count="1"><numFmt numFmtId="170" formatCode="[$-409]d\\-mmm\\-yy;@"/>'
        '</numFmts><cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="4"/></cellXfs>'
        "</styleSheet>",
        "xl/sharedStrings.xml": f'<sst {ns} count="3"><si><t>name</t></si><si><r><rPr><b/></rPr><t>Bo</t></r>'
        '<r><t xml:space="preserve">ld &amp; x</t></r></si><si><t>when</t></si></sst>',
        "xl/worksheets/data.xml": f"<worksheet {ns}><sheetData>"
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>2</v></c><c r="C1" t="inlineStr"><is><t>amount</t></is></c>'
        '<c r="D1" t="inlineStr"><is><t>flag</t></is></c></row>'
        '<row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3" s="1"><v>45292</v></c><c r="C3" s="3"><v>1234.5</v></c>'
        '<c r="D3" t="b"><v>1</v></c></row>'
        '<row r="4"><c r="A4" t="str"><f>UPPER("q")</f><v>Q</v></c><c r="B4" s="2"><v>45293.5</v></c>'
        '<c r="C4" t="e"><v>#DIV/0!</v></c><c r="D4" t="b"><v>0</v></c></row>'
        "</sheetData></worksheet>",
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for k, v in files.items():
            zf.writestr(k, v)
    return buf.getvalue()


def test_excel_written_workbook():
    data = _excel_like()
    assert xlsx.workbook_part_titles(data) == ["Data & More"]
    rows = list(xlsx.read_workbook(data))
    assert [r[2] for r in rows] == [0, 2, 3]  # the blank sheet row 2 is absent
    assert rows[1][3] == [("s", "Bold & x"), ("d", "2024-01-01 00:00:00"), ("n", "1234.5"), ("b", "true")]
    assert rows[2][3] == [("s", "Q"), ("d", "2024-01-02 12:00:00"), ("e", "#DIV/0!"), ("b", "false")]
    rows1904 = list(xlsx.read_workbook(_excel_like(date1904=True)))
    assert rows1904[1][3][1] == ("d", "2028-01-02 00:00:00")  # 1462 days later


def test_excel_written_workbook_table(spark):
    out = scratch_dir(spark, "t-excel")
    with open(os.path.join(local_path(out), "e.xlsx"), "wb") as fh:
        fh.write(_excel_like())
    t = W.to_table(W.scan_workbooks(spark, out))
    assert dict(t.dtypes) == {"name": "string", "when": "timestamp_ntz", "amount": "string", "flag": "boolean"}
    got = sorted(t.collect(), key=lambda r: r["name"])
    assert got[0]["when"] == dt.datetime(2024, 1, 1) and got[0]["flag"] is True


def test_missing_sheet_raises():
    data = _book([("only", [["a"], [1]])])
    with pytest.raises(ValueError):
        list(xlsx.read_workbook(data, {"other"}))
    with pytest.raises(ValueError):
        list(xlsx.read_workbook(data, {3}))
    assert len(list(xlsx.read_workbook(data, {0, "only"}))) == 2


def _prefixed_book(rows_xml: str, self_closing: bool = False) -> bytes:
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    files = {
        "xl/workbook.xml": f'<x:workbook xmlns:x="{main}" xmlns:r="{rel}"><x:sheets>'
        '<x:sheet name="P" sheetId="1" r:id="rId1"/></x:sheets></x:workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<x:worksheet xmlns:x="{main}" '
        'xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006" '
        'xmlns:x14ac="http://schemas.microsoft.com/office/spreadsheetml/2009/9/ac" mc:Ignorable="x14ac">'
        '<x:dimension ref="A1:B9"/>'
        + ("<x:sheetData/>" if self_closing else f"<x:sheetData>{rows_xml}</x:sheetData>")
        + '<x:mergeCells count="0"/></x:worksheet>',
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for k, v in files.items():
            zf.writestr(k, v)
    return buf.getvalue()


def test_prefixed_xml_self_closing_rows_and_chunks(monkeypatch):
    rows = "".join(
        f'<x:row r="{i}" x14ac:dyDescent="0.25"><x:c r="A{i}" t="inlineStr"><x:is><x:t>v{i}</x:t></x:is></x:c>'
        f'<x:c r="C{i}"><x:v>{i}</x:v></x:c></x:row>' + (f'<x:row r="{i}0" spans="1:2"/>' if i % 3 == 0 else "")
        for i in range(1, 40)
    )
    data = _prefixed_book(rows)
    want = list(xlsx.read_workbook(data))
    monkeypatch.setattr(xlsx, "_READ", 64)  # force many row-boundary cuts
    got = list(xlsx.read_workbook(data))
    assert got == want
    assert got[0][3] == [("s", "v1"), None, ("n", "1")]
    assert [r[2] for r in got][:4] == [0, 1, 2, 29]  # self-closing row 30 after row 3
    assert list(xlsx.read_workbook(_prefixed_book(""))) == []
    assert list(xlsx.read_workbook(_prefixed_book("", self_closing=True))) == []


def test_custom_inferrer(spark):
    out = scratch_dir(spark, "t-infer")
    with open(os.path.join(local_path(out), "c.xlsx"), "wb") as fh:
        fh.write(_book([("s", [["id", "g", "g"], ["id", "m1", "m2"], [1, 2, 3]])]))
    cells = W.scan_workbooks(spark, out)
    default = H.infer_header_table(cells)
    assert default.columns == ["id", "g"]
    # a rule that never sees header rows keeps the first row as data and
    # makes the once-occurring names the keys
    flat = H.infer_header_table(cells, inferrer=lambda names, rows: H.infer_spec(names, []))
    assert set(flat.columns) == {"id", "g", "g.1"} and flat.count() == 2


def test_mixed_column_booleans_print_like_python(spark):
    out = scratch_dir(spark, "t-mixed")
    with open(os.path.join(local_path(out), "m.xlsx"), "wb") as fh:
        fh.write(_book([("s", [["a"], [True], ["x"], [2], [False]])]))
    t = W.to_table(W.scan_workbooks(spark, out))
    assert sorted(r["a"] for r in t.collect()) == ["2", "False", "True", "x"]
