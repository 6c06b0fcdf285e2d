"""Element trees, workbooks, page cursors and seen keys: odd input, failures and repeated runs."""

import datetime
import glob
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from recordloom.runtime import ship
from recordloom.sources import pages, tree, workbook
from recordloom.streaming import cursor, incremental


def names(html):
    return [e.text() for e in tree.found(tree.parse(html), {"n": 'h1[itemprop="name"]'})["n"]]


def test_broken_markup_loses_no_text():
    for inner, want in (("Ana <b>Soto</b> Vega", "Ana Soto Vega"), ("Ana<br/>Soto", "Ana Soto"), ("Ana<br>Soto", "Ana Soto"), ("A<wbr>na", "Ana"), ("Ana</p> Soto", "Ana Soto"),
                        ("Ana <script>x</script>&amp; B", "Ana & B"), ("Ana <i>So<b>to</i> Vega", "Ana Soto Vega"), ("<img src=x>Ana", "Ana"), ("", "")):
        assert names(f'<p>a<h1 class=x itemprop="name">{inner}</h1>rest') == [want], inner
    assert names(None) == names("") == names("<h1>Ana") == []
    assert names('<h1 itemprop=name>Ana') == ["Ana"]
    deep = "<div>" * 20_000 + '<h1 itemprop="name">x</h1>'
    assert names(deep) == ["x"]
    cells = tree.found(tree.parse("<table><tr><td>a<td>b<tr><td>c</table>"), {"r": "tr", "d": "tr > td"})
    assert [e.text() for e in cells["d"]] == ["a", "b", "c"] and len(cells["r"]) == 2


def test_selectors():
    root = tree.parse('<div id=a class="x y"><p class=y><a href="https://s/b?c" data-k="v w">1</a></p></div><a href="/b">2</a><p class=xy>3</p>')
    for selector, want in ((".y a", ["1"]), ("div > a", []), ("p > a", ["1"]), ("#a a[href^='https:']", ["1"]), ("a[href$=b]", ["2"]), ("a[href*='/b']", ["1", "2"]), ('[data-k="v w"]', ["1"]),
                           (".x.y p", ["1"]), ("p.y, a", ["1", "1", "2"]), ("*[class=xy]", ["3"]), ("a[data-k]", ["1"])):
        assert [e.text() for e in tree.found(root, {"s": selector})["s"]] == want, selector
    for wrong in ("a:hover", "a + b", ">", "a[", "a ~ b"):
        with pytest.raises(ValueError):
            tree.compiled(wrong)


def test_scopes():
    found = tree.scopes(tree.parse('<b itemprop=lost>x</b><div itemscope itemtype=T><b itemprop="a b"> 1 </b><div itemprop=c itemscope><i itemprop=d>2</i><meta itemprop=d content=3></div><b itemprop=a>4</b></div>'))
    assert found == [{"kind": "T", "parent": None, "prop": "", "values": {"a": ["1", "4"], "b": ["1"]}}, {"kind": "", "parent": 0, "prop": "c", "values": {"d": ["2", "3"]}}]


def test_page_functions_on_nothing(spark):
    ship(spark)
    df = spark.createDataFrame([(None,), ("",), ("<html>",), ("x" * 2_000_000,)], "h string")
    got = df.select(pages.profile_record()("h").alias("a"), pages.address_cards()("h").alias("b"), pages.search_hits()("h")["hits"].alias("c"), pages.microdata()("h")["records"].alias("d"), pages.listing_records("h").alias("e")).collect()
    for r in got:
        assert r["a"] is None and r["b"]["phones"] == [] and r["b"]["specialties"] is None and r["c"] == r["d"] == r["e"] == []


def test_listed_services():
    assert pages.default_service('[{"name": "a"}, {"name": "b", "priceMin": 5.0, "isDefaultServiceForHighlight": true}]') == (5, "b")
    for raw in ("", "[]", "{}", "[1]", "x", None):
        assert pages.default_service(raw) == (None, "")


def book(path, sheet, strings=(), name="Hoja", styles=""):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://r"><sheets><sheet name="{name}" sheetId="1" r:id="r7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r7" Target="/xl/other/s.xml"/></Relationships>')
        z.writestr("xl/other/s.xml", f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>')
        if strings:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si>{s}</si>" for s in strings) + "</sst>")
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="200" formatCode="dd/mm/yy"/><numFmt numFmtId="201" formatCode="0 &quot;days&quot;"/></numFmts><cellXfs>{styles}</cellXfs></styleSheet>')


def test_workbooks_of_others(spark, tmp_path):
    ship(spark)
    strings = ["<t>Nombre</t>", "<r><t>Ana </t></r><r><t>Soto</t></r><rPh><t>no</t></rPh>", "<t>Correo</t>"]
    sheet = ('<row r="1"><c r="A1" t="inlineStr"><is><t>Listing</t></is></c></row><row r="3"><c r="B3" t="s"><v>0</v></c><c r="D3" t="s"><v>2</v></c><c r="E3" t="s"><v>0</v></c></row>'
             '<row r="5"><c r="B5" t="s"><v>1</v></c><c r="D5" t="str"><v>a@b.c</v></c><c r="E5" t="b"><v>1</v></c><c r="F5"><v>7</v></c><c r="AA5"><v>1.5</v></c></row>'
             '<row r="6"><c r="B6" s="1"><v>45352</v></c><c r="C6" s="2"><v>2</v></c><c r="D6" t="e"><v>#N/A</v></c><c r="E6" s="3"><v>0.5</v></c></row><row r="7"/>')
    os.mkdir(tmp_path / "in")
    book(tmp_path / "in" / "a.xlsx", sheet, strings, styles='<xf/><xf numFmtId="200"/><xf numFmtId="201"/><xf numFmtId="22"/>')
    (tmp_path / "in" / "note.txt").write_text("no workbook")
    rows = {r["row"]: r["cells"] for r in workbook.read_workbooks(spark, f"file://{tmp_path}/in", headerHolds="correo").collect()}
    assert rows == {5: {"column 1": "", "nombre": "Ana Soto", "column 3": "", "correo": "a@b.c", "column 6": "7", **{f"column {k}": "" for k in range(7, 27)}, "column 27": "1.5"},
                    6: {"column 1": "", "nombre": "2024-03-01", "column 3": "2", "correo": ""}}
    assert workbook.read_workbooks(spark, f"file://{tmp_path}/in/a.xlsx").where("row = 5").first()["cells"]["listing"] == ""
    assert workbook.read_workbooks(spark, f"file://{tmp_path}/in", headerHolds="missing").count() == 0
    os.mkdir(tmp_path / "none")
    assert workbook.read_workbooks(spark, f"file://{tmp_path}/none").count() == 0


def test_workbook_types_and_swap(spark, tmp_path):
    ship(spark)
    at = datetime.datetime(2024, 2, 29, 13, 5, 7, 250000)
    odd = ["a", " two  spaces ", "<&>\"'", "line\nbreak", "\x01\x1f_x0041_", "日本", "", None, "=1+1", "00123"]
    rows = [("s" if k % 2 else "t", k, v, k / 4 if k else None, k % 3 == 0, at if k else None, at.date()) for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "sheet string, n long, v string, d double, b boolean, at timestamp_ntz, day date")
    target = f"file://{tmp_path}/out"
    for _ in range(2):  # the second takes the first one's place
        workbook.write_workbooks(df, target, "sheet", ["n"], 3)
    assert sorted(os.listdir(tmp_path)) == ["out"] and not [f for f in os.listdir(tmp_path / "out") if not f.endswith(".xlsx")]
    got = {int(r["cells"]["n"]): (r["sheet"], r["cells"]) for r in workbook.read_workbooks(spark, target).collect()}
    assert len(got) == len(odd)
    for sheet, n, v, d, b, t, day in rows:
        s, c = got[n]
        assert (s, c["v"], c["b"]) == (sheet, v or "", str(b).lower())
        assert c["d"] == ("" if d is None else str(int(d)) if d.is_integer() else repr(d)) and c["at"] == ("" if t is None else "2024-02-29 13:05:07.250") and c["day"] == "2024-02-29"
    try:
        import openpyxl
    except ImportError:
        pass
    else:
        assert openpyxl.load_workbook(glob.glob(f"{tmp_path}/out/*.xlsx")[0])
    with pytest.raises(Exception):  # rows of a sheet that do not stand together: nothing is left of the attempt, the target is as before
        spark.dataSource.register(workbook.Workbook)
        df.coalesce(1).sort("n").write.format("workbook").mode("overwrite").save(target)
    assert sorted(os.listdir(tmp_path)) == ["out"] and workbook.read_workbooks(spark, target).count() == len(odd)
    workbook.write_workbooks(df.where("n < 3"), target, "sheet", ["n"], mode="append")
    assert workbook.read_workbooks(spark, target).count() == len(odd) + 3 and sorted(os.listdir(tmp_path)) == ["out"]
    workbook.write_workbooks(df.limit(0), f"file://{tmp_path}/empty", "sheet", ["n"])
    assert workbook.read_workbooks(spark, f"file://{tmp_path}/empty").count() == 0


def test_full_sheets_go_on(spark, tmp_path, monkeypatch):
    writer = workbook.Writer({"path": f"file://{tmp_path}/w"}, spark.range(1).selectExpr("id", "'x' as sheet").schema, True)
    monkeypatch.setattr(workbook, "MOST_ROWS", 4)

    class Here:
        get = staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())

    monkeypatch.setattr(workbook, "TaskContext", Here)
    name = "a very long [name] of a sheet that is cut"
    writer.commit([writer.write(iter([{"id": k, "sheet": name} for k in range(8)])), None])
    with open(glob.glob(f"{tmp_path}/w/*.xlsx")[0], "rb") as f:
        sheets = workbook.Sheets(f)
        assert [len(list(sheets.rows(s))) for s in sheets.member] == [4, 4, 3] and [len(s) for s in sheets.member] == [31, 31, 31] and all(s.endswith(f"({k})") for k, s in list(enumerate(sheets.member, 1))[1:])
    rows = spark.createDataFrame([("w", "Panama (2)", 2, {"a": "x"}), ("w", "Other", 2, {"a": "y"}), ("w", "Panama", 3, {"b": ""})], workbook.SCHEMA)
    got = workbook.by_sheet(rows, {"one": ("b", "a"), "two": ("c",)}, {"Panama": {"country": "PA"}}).orderBy("row").collect()
    assert [(r["sheet"], r["one"], r["two"], r["country"]) for r in got] == [("Panama", "x", "", "PA"), ("Panama", "", "", "PA")]


def snapshots(spark, path, rows):
    spark.createDataFrame(rows, "source string, page long, total long, n long, body string").write.mode("append").parquet(path)


def page(source, k, n=2, total=100):
    return (source, k, total, n, json.dumps([f"{source}{k}.{i}" for i in range(n)]))


def test_cursor(spark, tmp_path):
    ship(spark)
    path, out, place, sources = (f"file://{tmp_path}/{x}" for x in ("pages", "out", "checkpoint")), None, None, ["a", "b", "c"]
    path, out, place = path
    snapshots(spark, path, [page("a", k) for k in range(1, 4)] + [page("a", 4, 0)] + [page("b", k, total=5) for k in range(1, 8)] + [page("c", k, total=0) for k in (1, 2, 4)])
    shape = lambda df: df.select("source", "page", F.explode(F.from_json("body", "array<string>")).alias("v"))
    run = lambda budget: cursor.run_once(shape(cursor.page_stream(spark, path, place, sources, budget, 2)), out, place)
    run(2)
    assert cursor.position(place, sources) == {"a": {"next": 3, "total": 50, "complete": False}, "b": {"next": 1, "total": 0, "complete": False}, "c": {"next": 1, "total": 0, "complete": False}}

    def broken(df):
        return df.select(F.raise_error(F.lit("stop")).alias("v"))

    with pytest.raises(Exception):  # stopped half way; what was planned is taken up again
        cursor.run_once(broken(cursor.page_stream(spark, path, place, sources, 3, 2)), out, place)
    run(3)
    at = cursor.position(place, sources)
    assert at["a"]["complete"] and at["a"]["next"] == 4 and at["b"]["next"] == 3  # an empty page takes nothing from the budget
    assert cursor.run_all(spark, path, out, place, sources, shape, 3, 2) >= 1
    at = cursor.position(place, sources)
    assert at["b"] == {"next": 4, "total": 3, "complete": True} and at["c"] == {"next": 3, "total": 0, "complete": False}  # five records are three pages; page 3 is not there
    snapshots(spark, path, [page("c", 3), page("c", 5, 0)])
    cursor.run_all(spark, path, out, place, sources, shape, 3, 2)
    assert all(s["complete"] for s in cursor.position(place, sources).values())
    got = [r["v"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted([f"{s}{k}.{i}" for s, last in (("a", 3), ("b", 3), ("c", 4)) for k in range(1, last + 1) for i in range(2)])
    assert cursor.run_all(spark, path, out, place, sources, shape, 3, 2) == 0


def feed(spark, path, rows):
    spark.createDataFrame(rows, "k string, n long").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("k string, n long").parquet(path)


def test_seen_keys(spark, tmp_path):
    ship(spark)
    base = f"file://{tmp_path}"
    spark.createDataFrame([("old", 1), (None, 2)], "k string, n long").write.parquet(f"{base}/target")
    read = lambda: sorted(map(tuple, incremental.read_appended(spark, f"{base}/target").collect()), key=str)
    incremental.append_new(feed(spark, f"{base}/in", [("old", 5), ("a", 9), ("a", 7), ("b", None), ("b", 3), (None, 8)]), ["k"], "n", f"{base}/target", f"{base}/cp")
    assert read() == sorted([("old", 1), (None, 2), ("a", 7), ("b", 3)], key=str)
    incremental.append_new(feed(spark, f"{base}/in", [("a", 1), ("c", 2)]), ["k"], "n", f"{base}/target", f"{base}/cp")
    incremental.append_new(feed(spark, f"{base}/in", [("c", 1)]), ["k"], "n", f"{base}/target", f"{base}/cp")
    assert read() == sorted([("old", 1), (None, 2), ("a", 7), ("b", 3), ("c", 2)], key=str)


def test_seen_keys_of_many_batches(spark, tmp_path):
    """Against a plain loop: a run of several batches, keys of two columns with nulls, equal and missing orders, an empty batch."""
    draw, schema = random.Random(7), "a string, b long, n double, note string"
    batches = [[(draw.choice((None, "x", "y")), draw.choice((None, *range(8))), draw.choice((None, 0.5, 1.0, 2.0)), "held" if not k else f"{k}") for _ in range(25)] if k != 2 else [] for k in range(5)]
    base, held = f"file://{tmp_path}", {r[:2]: r for r in batches[0]}
    spark.createDataFrame([*held.values()], schema).write.parquet(f"{base}/target/part=1")
    for k, rows in enumerate(batches[1:], 1):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/batch{k}")
        for at in glob.glob(f"{tmp_path}/batch{k}/*.parquet"):
            os.makedirs(f"{tmp_path}/in", exist_ok=True)
            os.rename(at, f"{tmp_path}/in/{k}.parquet")
            os.utime(f"{tmp_path}/in/{k}.parquet", (k * 1000, k * 1000))
        found = {}
        for r in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0)):
            found.setdefault(r[:2], r)
        held = {**found, **held}
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    for _ in range(2):
        incremental.append_new(stream, ["a", "b"], "n", f"{base}/target", f"{base}/cp")
    got = [r[:4] for r in map(tuple, incremental.read_appended(spark, f"{base}/target").select("a", "b", "n", "note").collect())]
    assert sorted(got, key=str) == sorted(held.values(), key=str)


def test_known_keys_outlast_a_failed_run(spark, tmp_path):
    """The keys that the target held are not taken for new ones when the first run is repeated after a failure."""
    ship(spark)
    base = f"file://{tmp_path}"
    spark.createDataFrame([("old", 1)], "k string, n long").write.parquet(f"{base}/target")
    stream = feed(spark, f"{base}/in", [("old", 5), ("a", 9)])
    with pytest.raises(Exception, match="not today"):
        incremental.append_new(stream.withColumn("n", F.when(F.col("k") == "a", F.raise_error(F.lit("not today")).cast("long")).otherwise(F.col("n"))), ["k"], "n", f"{base}/target", f"{base}/cp")
    incremental.append_new(stream, ["k"], "n", f"{base}/target", f"{base}/cp")
    assert sorted(map(tuple, incremental.read_appended(spark, f"{base}/target").collect())) == [("a", 9), ("old", 1)]


def test_seen_keys_are_forgotten(spark, tmp_path):
    base = f"file://{tmp_path}"
    for day, keys in ((1, "aab"), (2, "ac"), (9, "d"), (10, "a")):  # the watermark passes with the batch after
        spark.createDataFrame([(k, datetime.datetime(2024, 1, day)) for k in keys], "k string, at timestamp").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("k string, at timestamp").parquet(f"{base}/in")
        incremental.drain(incremental.seen_once(stream, ["k"], "at", "2 days"), f"{base}/target", f"{base}/cp")
    assert sorted(r["k"] for r in spark.read.parquet(f"{base}/target").collect()) == ["a", "a", "b", "c", "d"]
