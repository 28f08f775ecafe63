"""Steps whose tasks must not take the whole input: plans as on a cluster,
where only tables of known small size are broadcast."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from sheetcraft.operators import referrals as R
from sheetcraft.sources import workbooks as W
from sheetcraft.sources import xlsx
from sheetcraft.sources.files import materialize
from sheetcraft.sources.refresh import WorkbookRefresher
from sheetcraft.session import scratch_dir

from .test_plans import _final_plan


@contextmanager
def _broadcast_up_to(spark, size):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _rows(spark, n):
    text = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, n, 1, 4).select("id", text.alias("name"), F.when(F.col("id") % 3 == 0, F.col("id") / 2).alias("half"))


def _cells(spark, n, name):
    out = scratch_dir(spark, name)
    W.write_workbooks(_rows(spark, n), out, rows_per_file=500).write.format("noop").mode("overwrite").save()
    return out


def test_cells_of_one_layout_are_not_dealt_to_one_task(spark):
    cells = materialize(W.scan_workbooks(spark, _cells(spark, 4000, "t-growth")), "t-growth-cells")
    with _broadcast_up_to(spark, "20k"):
        t = W.to_table(cells)
        assert "hashpartitioning(layout" not in _final_plan(t)
        assert t.exceptAll(_rows(spark, 4000)).count() == 0 and t.count() == 4000


def test_live_cells_are_not_shuffled(spark):
    src = _cells(spark, 1000, "t-growth-live")
    r = WorkbookRefresher(spark, src, scratch_dir(spark, "t-growth-target"))
    assert r.refresh().count() == 1000
    with _broadcast_up_to(spark, "-1"):
        cells = r._live_cells(r.manifest())
        assert "hashpartitioning(src" not in _final_plan(cells) and cells.count() == 1004


def test_columns_by_place_in_sheets_of_other_order(spark):
    cell = lambda t, v: (t, str(v))
    rows = []
    for path, head, one in (("a", ["x", "y", ""], [1, 2.5, "q"]), ("b", ["y", "z"], [None, "True"]), ("c", ["z", "x"], ["nan", 3])):
        for line, values in enumerate((head, one)):
            cells = [None if v is None else cell("s" if isinstance(v, str) else "n", v) for v in values]
            rows.append((path, None, 0, "s", line, line, path, cells, None))
    t = W.to_table(spark.createDataFrame(rows, W.SCAN_SCHEMA))
    assert t.dtypes == [("x", "bigint"), ("y", "double"), ("Unnamed: 2", "string"), ("z", "string")]
    assert sorted(map(tuple, t.collect()), key=str) == [(1, 2.5, "q", None), (3, None, None, None), (None, None, None, "True")]


def test_a_note_is_parsed_once(spark):
    notes = ['{"Filters":[{"a":1},{"a":NaN}]}', '{"Filters":[]}', '{"Filters":[1]} and more', None, "x", '{"Filters":{}}']
    df = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], f"id int, {R.NOTES} string")
    df = df.withColumn(R.NOTES, F.concat(F.col(R.NOTES), F.lit(" ")))
    out = R.explode_filters(df, values=True, position="at")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(R.NOTES) and plan.count("parseJson") + plan.count("try_parse_json") == 1, plan
    assert sorted(map(tuple, out.select("id", "at", F.to_json(R.NOTES)).collect())) == [(0, 0, '{"a":1}'), (0, 1, '{"a":null}')]


def test_long_sheets_keep_their_rows(spark):
    import io

    rows = [[f"{i} " + "é<&" * 40, i, None, i % 2 == 0] for i in range(4000)]
    raw = io.BytesIO()
    w = xlsx.WorkbookWriter(raw)
    for sheet in ("one", "two", "none"):
        w.start_sheet(sheet)
        for row in rows if sheet != "none" else ():
            w.write_row(row)
    w.close()
    found = list(xlsx.read_workbook(raw.getvalue()))
    want = [[("s", a), ("n", str(b)), None, ("b", str(d).lower())] for a, b, _, d in rows]
    assert [f[3] for f in found] == want * 2 and [f[2] for f in found] == list(range(4000)) * 2
