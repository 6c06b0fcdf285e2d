"""Tables with headers anywhere, directories in running text, reports."""

import os

from pyspark.sql import functions as F

from recordloom.operators import consolidating
from recordloom.sources import files, tabular

ROLES = {"name": [("apellidos",), ("nombre",)], "mail": [("correo",)], "unit": [("unidad", "medica")]}
POSTS, CITIES = [(r"^MEDICO/A GENERAL\b", "GENERAL"), (r"^MEDICO/A", "OTHER")], ["Quito", "San Lorenzo"]


def put(folder, name, body, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_bytes(body.encode(encoding))


def rows(spark, folder, **how):
    got = tabular.read_tabular(spark, f"file://{folder}", "correo", ROLES, ("name", "mail"), **how).collect()
    return sorted((os.path.basename(r["file"]), r["name"], r["mail"], r["unit"]) for r in got)


def test_headers_anywhere(spark, tmp_path):
    d = tmp_path / "in"
    put(d, "a.csv", '﻿CORREO,Nombre,"Unidad, Médica"\r\na@b,"Soto, ""Ana""",U1\r\n\r\nc@d,Vega\r\n')
    put(d, "b.csv", "Listado;;\n;;\nNombre completo;Apellidos;Correo;Unidad\nx;Soto;e@f;no role\n;;;\n")
    put(d, "c.csv", "\n" * 20 + "Nombre|Correo\nlate|g@h\n")
    put(d, "d.csv", "Correo\tTel\nno@name\t1\n")
    put(d, "e.csv", "")
    put(d, "f.csv", "Nombre,Correo")
    put(d / "deep", "g.csv", "Nombre\tCorreo\nAna, B\tq;r@s\n")
    want = [("a.csv", 'Soto, "Ana"', "a@b", "U1"), ("a.csv", "Vega", "c@d", ""), ("b.csv", "", "", ""), ("b.csv", "Soto", "e@f", ""), ("g.csv", "Ana, B", "q;r@s", "")]
    assert rows(spark, d) == want
    assert rows(spark, d, within=30) == sorted(want + [("c.csv", "late", "g@h", "")])


def test_large_files_are_split(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "note\nNombre,Correo\n" + "".join(f"n{k},m{k}@x\n" for k in range(20_000)))
    put(tmp_path / "in", "b.csv", "Correo;Nombre\nz@x;z\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = rows(spark, tmp_path / "in")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 20_001 and len(set(got)) == 20_001 and ("b.csv", "z", "z@x", "") in got


def test_closed_by(spark):
    df = spark.createDataFrame([("a x1 b x2 c",), ("none",), ("",), (None,), ("x1x2",)], "t string")
    got = [[tuple(p) for p in r[0] or []] for r in df.select(tabular.closed_by(F.coalesce("t", F.lit("")), r"x(\d)")).collect()]
    assert got == [[("a ", "x1"), (" b ", "x2")], [], [], [], [("", "x1"), ("", "x2")]]


def test_directory_text(spark):
    body = ("No. Apellidos y Nombres x\ny Correo Electrónico institucional 1 SOTO VEGA\nANA MÉDICO/A GENERAL UNIT QUITO 022345678 ana@x.gob\n2 MORA LUIS médico/a x San  Lorenzo (593) 02 234 5678 l.m@y.ec"
            " 3 NO PHONE MEDICO/A GENERAL QUITO n@y.ec 4 NO CITY MEDICO/A GENERAL LOJA 022345678 c@y.ec 5 NO POST NURSE QUITO 022345678 p@y.ec 6 LAST MEDICO/A GENERAL QUITO 022345678")
    df = spark.createDataFrame([(1, body), (2, None), (3, ""), (4, "words " * 50_000)], "id long, body string").withColumn("name", F.lit("clash"))
    got = sorted(tuple(r) for r in tabular.directory_text(df, ["id"], "body", POSTS, CITIES).collect())
    assert got == [(1, "Mora Luis", "OTHER", "San Lorenzo", "02 234 5678", "l.m@y.ec"), (1, "Soto Vega Ana", "GENERAL", "Quito", "022345678", "ana@x.gob.ec")]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "y", None), ("b", None, 3), (None, "z", 1)], "g string, v string, n long")
    got = {r["g"]: r for r in consolidating.group_report(df, ["g"], {"big": F.col("n") > 1}, {"vs": "v"}, 2).collect()}
    assert {k: (r["n"], r["big"], r["goal"], r["gap"], r["vs"]) for k, r in got.items()} == {"a": (3, 1, 2, 0, "y: 2, x: 1"), "b": (1, 1, 2, 1, ""), None: (1, 0, 2, 1, "z: 1")}
    inputs = spark.createDataFrame([(1, "A", "care"), (2, "B", None), (3, "C", "x"), (4, "D", "other")], "id long, name string, category string")
    matches = spark.createDataFrame([(1, "AA", ["Heart care"], 0.81249, "/a", 7), (2, "BB", ["z"], 0.9, "/b", 8), (4, "DD", ["y"], 1.0, "/d", 9)], "id long, canonical string, categories array<string>, score double, path string, oid long")
    out = [tuple(r)[1:] for r in consolidating.verification_report(inputs, matches, "id").orderBy("id").collect()]
    assert out == [("A", "care", True, "AA", "Heart care", "true", 0.812, "/a", "7", ""), ("B", "", True, "BB", "z", "", 0.9, "/b", "8", ""), ("C", "x", False, "", "", "", 0.0, "", "", "no match of 0.75 or more"), ("D", "other", True, "DD", "y", "false", 1.0, "/d", "9", "")]
    files.report(spark.createDataFrame([("b", 1.5), ("a", 2.0)], "metric string, value double"), f"file://{tmp_path}/report")
    assert [r["value"] for r in spark.read.text(f"file://{tmp_path}/report").collect()] == ['{"a":2.0,"b":1.5}']
    for _ in range(2):
        files.append(df, f"file://{tmp_path}/log")
    assert spark.read.json(f"file://{tmp_path}/log").count() == 10
    files.write_sheets({"s": df}, f"file://{tmp_path}/sheets")
    files.write_sheets({"s": df.limit(1)}, f"file://{tmp_path}/sheets")
    assert spark.read.parquet(f"file://{tmp_path}/sheets/s").count() == 1 and os.listdir(tmp_path / "sheets") == ["s"]
