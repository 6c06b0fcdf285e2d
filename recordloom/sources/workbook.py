"""Spreadsheet workbooks as a data source of Spark: a partition a sheet to read, a workbook a task to write.

    spark.dataSource.register(Workbook)
    spark.read.format("workbook").load(folder_or_file)
    df.write.format("workbook").mode("overwrite").save(folder)

A workbook is a zip of XML files; both are read and written as streams, so a task holds one batch of rows and, to read,
the workbook's shared strings.  Files are reached through Arrow's file systems, by URI; the folder must be one that all
executors share.
"""

from __future__ import annotations

import io
import os
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from xml.etree.ElementTree import iterparse
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Rows of a sheet, and days from which serial dates count: fixed by the format.  Number formats built in that are dates.
MOST_ROWS, DAY_ZERO = 1_048_576, datetime(1899, 12, 30)
DATES = {*range(14, 23), *range(45, 48)}
#: Styles that the writer uses, by place: plain, timestamp, date.
PLAIN, STAMP, DAY = 0, 1, 2
SCHEMA = "workbook string, sheet string, row long, cells map<string,string>"


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a URI, or of a path of the machine, and the path in it."""
    return fs.FileSystem.from_uri(uri if re.match(r"[\w+.-]+:", uri) else f"file://{os.path.abspath(uri)}")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _number(text: str) -> str:
    """A stored number as text: whole ones without a point, others with no more digits than tell them apart."""
    try:
        x = float(text)
    except ValueError:
        return text
    return str(int(x)) if x.is_integer() and abs(x) < 1e15 else repr(x)


def _moment(text: str) -> str:
    """A serial date as ISO text; only the date where it has no time of day."""
    try:
        at = DAY_ZERO + timedelta(milliseconds=round(float(text) * 86_400_000))
    except (ValueError, OverflowError):
        return text
    return at.isoformat(" ", "milliseconds" if at.microsecond else "seconds") if at.time() != datetime.min.time() else at.date().isoformat()


def _is_date(code: str) -> bool:
    return bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower())))


class Sheets:
    """An open workbook: names of its sheets in order, and the rows of one."""

    def __init__(self, file):
        self.zip = zipfile.ZipFile(file)
        book, rels = self._all("xl/workbook.xml", "sheet"), self._all("xl/_rels/workbook.xml.rels", "Relationship")
        target = {r["Id"]: r["Target"] for r in rels}
        place = lambda t: t.lstrip("/") if t.startswith("/") else posixpath.normpath(f"xl/{t}")
        self.member = {s["name"]: place(target[s["id"]]) for s in book if s.get("id") in target}

    def _all(self, member: str, tag: str) -> list[dict[str, str]]:
        """The attributes of every element of a tag in a small member; none if the workbook has no such member."""
        if member not in self.zip.namelist():
            return []
        with self.zip.open(member) as f:
            return [{_local(k): v for k, v in e.attrib.items()} for _, e in iterparse(f) if _local(e.tag) == tag]

    def strings(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.zip.namelist():
            return []
        out = []
        with self.zip.open("xl/sharedStrings.xml") as f:
            for _, e in iterparse(f):
                if _local(e.tag) == "si":
                    out.append(_written(e))
                    e.clear()
        return out

    def date_styles(self) -> set[int]:
        """Places of the cell formats that show a date."""
        if "xl/styles.xml" not in self.zip.namelist():
            return set()
        custom = {int(n["numFmtId"]) for n in self._all("xl/styles.xml", "numFmt") if _is_date(n.get("formatCode", ""))}
        formats: list[int] = []
        with self.zip.open("xl/styles.xml") as f:
            for _, e in iterparse(f):
                if _local(e.tag) == "cellXfs":
                    formats = [int(x.get("numFmtId", 0)) for x in e]
        return {k for k, n in enumerate(formats) if n in custom or n in DATES}

    def rows(self, sheet: str) -> Iterator[list[str]]:
        """The rows of a sheet as text, blank ones within it too; empty and faulty cells are empty strings."""
        strings, dates, last = self.strings(), self.date_styles(), 0
        with self.zip.open(self.member[sheet]) as f:
            holder = None
            for event, e in iterparse(f, events=("start", "end")):
                tag = _local(e.tag)
                if event == "start":
                    holder = e if tag == "sheetData" else holder
                    continue
                if tag != "row":
                    continue
                number = int(e.get("r") or last + 1)
                for _ in range(last + 1, min(number, MOST_ROWS)):
                    yield []
                last, out = number, []
                for c in e:
                    at = _column(c.get("r")) if c.get("r") else len(out)
                    out += [""] * (at - len(out)) + [self._value(c, strings, dates)]
                yield out
                if holder is not None:
                    holder.clear()  # rows that were read are not kept

    @staticmethod
    def _value(c, strings: list[str], dates: set[int]) -> str:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            return _written(c)
        v = next((x.text or "" for x in c if _local(x.tag) == "v"), "")
        if kind == "s":
            return strings[int(v)] if v.isdigit() and int(v) < len(strings) else ""
        if kind == "e":
            return ""
        if kind == "b":
            return "true" if v == "1" else "false"
        if kind == "n" and v:
            return _moment(v) if int(c.get("s", 0)) in dates else _number(v)
        return v


def _written(e) -> str:
    """The text of a string item: of all its runs, without phonetic hints."""
    out, rest = [], [e]
    while rest:
        x = rest.pop()
        if _local(x.tag) == "t":
            out.append(x.text or "")
        elif _local(x.tag) != "rPh":
            rest += list(x)[::-1]
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), "".join(out))


@dataclass
class SheetPartition(InputPartition):
    uri: str
    sheet: str


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.only = options["path"], options.get("sheet")
        self.word, self.within = options.get("headerholds", "").lower(), int(options.get("headerwithin", 15))

    def partitions(self) -> list[SheetPartition]:
        store, path = store_of(self.path)
        if store.get_file_info(path).type == fs.FileType.Directory:
            files = [f.path for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.extension == "xlsx" and not f.base_name.startswith(("~", "."))]
        else:
            files = [path]
        out = []
        for file in sorted(files):
            with store.open_input_file(file) as f:
                out += [SheetPartition(file, s) for s in Sheets(f).member if self.only in (None, s)]
        return out or [SheetPartition("", "")]

    def read(self, partition: SheetPartition) -> Iterator[pa.RecordBatch]:
        if not partition.uri:
            return
        store, _ = store_of(self.path)
        with store.open_input_file(partition.uri) as f:
            head, batch, seen = None, [], 0
            for number, cells in enumerate(Sheets(f).rows(partition.sheet), 1):
                if head is None:
                    seen += 1
                    if not self.word and any(cells) or self.word and self.word in " ".join(cells).lower():
                        head = [c.strip().lower() for c in cells]
                    elif self.word and seen >= self.within:
                        return  # no header: a sheet of something else
                    continue
                if any(cells):
                    named = {}
                    for k, c in enumerate(cells):
                        named.setdefault(head[k] if k < len(head) and head[k] else f"column {k + 1}", c)
                    batch.append((posixpath.basename(partition.uri), partition.sheet, number, list(named.items())))
                if len(batch) == 1000:
                    yield _batch(batch)
                    batch = []
            if batch:
                yield _batch(batch)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["workbook", "sheet", "row", "cells"])


@dataclass
class Written(WriterCommitMessage):
    name: str


_STYLES = (
    '<styleSheet xmlns="{m}"><numFmts count="2"><numFmt numFmtId="170" formatCode="yyyy-mm-dd hh:mm:ss.000"/><numFmt numFmtId="171" formatCode="yyyy-mm-dd"/></numFmts>'
    '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf/><xf numFmtId="170" applyNumberFormat="1"/><xf numFmtId="171" applyNumberFormat="1"/></cellXfs></styleSheet>'
)
_MAIN, _REL, _PACKAGE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _cell(v) -> str:
    if v is None or v == "":
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, Decimal)) and abs(v) < 10**15 or isinstance(v, float) and abs(v) < float("inf"):
        return f"<c><v>{v!r}</v></c>" if not isinstance(v, Decimal) else f"<c><v>{v}</v></c>"
    if isinstance(v, datetime):
        return f'<c s="{STAMP}"><v>{(v.replace(tzinfo=None) - DAY_ZERO) / timedelta(days=1)!r}</v></c>'
    if isinstance(v, date):
        return f'<c s="{DAY}"><v>{(datetime(v.year, v.month, v.day) - DAY_ZERO).days}</v></c>'
    text = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", str(v))
    text = re.sub(r"[\x00-\x08\x0b-\x1f￾￿]", lambda m: f"_x{ord(m[0]):04X}_", text)
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


class Writer(DataSourceWriter):
    """Each task writes one workbook into a folder beside the target; commit() swaps the folder in, or in append mode moves the
    workbooks to those that are there, and abort() removes it."""

    def __init__(self, options: dict, schema, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.by, self.names = options.get("sheetcolumn", "sheet"), schema.fieldNames()
        store, path = store_of(self.path)
        self.adds = not overwrite and store.get_file_info(path).type == fs.FileType.Directory
        self.staging = posixpath.join(posixpath.dirname(path), f".{posixpath.basename(path)}-{uuid.uuid4().hex}")
        if store.get_file_info(path).type == fs.FileType.File and not overwrite:
            raise ValueError(f"{self.path} is a file; rows are added to a folder of workbooks")
        store.create_dir(self.staging, recursive=True)

    def write(self, rows) -> Written:
        """Rows come sorted by sheet; a sheet that is full goes on in another, named "name (2)" and so on."""
        store, _ = store_of(self.path)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.xlsx"
        columns = [n for n in self.names if n != self.by]
        header = "".join(map(_cell, columns))
        sheets: list[str] = []
        with store.open_output_stream(f"{self.staging}/{name}") as raw, zipfile.ZipFile(io.BufferedWriter(_Stream(raw)), "w", zipfile.ZIP_DEFLATED) as book:
            now, out, used, part = None, None, 0, 1
            for row in rows:
                sheet = str(row[self.by] if row[self.by] not in (None, "") else "Sheet")
                if out is None or sheet != now or used == MOST_ROWS:
                    part = part + 1 if sheet == now else 1
                    if out is not None:
                        out.write(b"</sheetData></worksheet>")
                        out.close()
                    title = re.sub(r"[\[\]:*?/\\]", " ", sheet)[: 31 - (len(f" ({part})") if part > 1 else 0)] + (f" ({part})" if part > 1 else "")
                    if title in sheets:
                        raise ValueError(f"rows of the sheet {title!r} do not stand together")
                    sheets.append(title)
                    out = book.open(f"xl/worksheets/sheet{len(sheets)}.xml", "w", force_zip64=True)
                    out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData><row>{header}</row>'.encode())
                    now, used = sheet, 1
                out.write(("<row>" + "".join(_cell(row[c]) for c in columns) + "</row>").encode())
                used += 1
            if out is None:
                return Written("")
            out.write(b"</sheetData></worksheet>")
            out.close()
            self._rest(book, sheets)
        return Written(name)

    @staticmethod
    def _rest(book: zipfile.ZipFile, sheets: list[str]) -> None:
        """What a workbook has beside its sheets."""
        n = range(1, len(sheets) + 1)
        book.writestr("xl/styles.xml", _STYLES.replace("{m}", _MAIN))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>' + "".join(f'<sheet name={quoteattr(s)} sheetId="{k}" r:id="rId{k}"/>' for k, s in zip(n, sheets)) + "</sheets></workbook>")
        rels = "".join(f'<Relationship Id="rId{k}" Type="{_REL}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in n)
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{rels}<Relationship Id="rId0" Type="{_REL}/styles" Target="styles.xml"/></Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_KIND}.worksheet+xml"/>' for k in n)
        book.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/>'
                      f'<Override PartName="/xl/styles.xml" ContentType="{_KIND}.styles+xml"/>{kinds}</Types>')  # fmt: skip

    def commit(self, messages: list[Written | None]) -> None:
        """Workbooks of tasks that did not count go; then the folder takes the target's place, which is put aside until it has."""
        store, path = store_of(self.path)
        kept = {m.name for m in messages if m}
        for f in store.get_file_info(fs.FileSelector(self.staging)):
            if f.base_name not in kept:
                store.delete_file(f.path)
            elif self.adds:
                store.move(f.path, posixpath.join(path, f.base_name))
        if self.adds:
            store.delete_dir(self.staging)
            return
        aside = f"{self.staging}-before"
        there = store.get_file_info(path).type != fs.FileType.NotFound
        if there:
            store.move(path, aside)
        try:
            store.move(self.staging, path)
        except OSError:
            if there:
                store.move(aside, path)
            raise
        if there:
            (store.delete_dir if store.get_file_info(aside).type == fs.FileType.Directory else store.delete_file)(aside)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = store_of(self.path)
        store.delete_dir(self.staging)


class _Stream(io.RawIOBase):
    """An Arrow output stream as a file that zips can be written to; it cannot be wound back, and zips do without."""

    def __init__(self, raw):
        self.raw = raw

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.raw.write(bytes(data))
        return len(data)


class Workbook(DataSource):
    """Options: path, a workbook or a folder of them; sheet, the only one to read; headerHolds, a word by which the header is
    found among the first headerWithin (15) rows, the first row that is not blank without it; sheetColumn to write."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer({k.lower(): v for k, v in self.options.items()}, schema, overwrite)


def read_workbooks(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(workbook, sheet, row, cells) of every row that is not blank; cells by header in lower case, all text.

    A header that comes twice counts once, the first; cells without a header are "column n".  Sheets without a header
    give no rows, and so does a folder without workbooks."""
    spark.dataSource.register(Workbook)
    return spark.read.format("workbook").options(**options).load(path)


def write_workbooks(df: DataFrame, folder: str, sheet: str, order: list[str], files: int = 1, mode: str = "overwrite") -> None:
    """A folder of at most ``files`` workbooks with a sheet for each value of a column, rows in ``order``; swapped in whole, or with
    the mode append added to what is there.

    Numbers, booleans, dates and timestamps stay such; null is an empty cell; all else is text."""
    df.sparkSession.dataSource.register(Workbook)
    dealt = df.repartitionByRange(files, sheet, *order).sortWithinPartitions(sheet, *order)
    dealt.write.format("workbook").mode(mode).option("sheetColumn", sheet).save(folder)


def by_sheet(rows: DataFrame, roles: dict[str, tuple[str, ...]], sheets: dict[str, dict[str, str]]) -> DataFrame:
    """Rows of configured sheets with a column for each role (its first header that a row has, else empty) and one for each of a
    sheet's settings; sheets without settings are left out.  Parts of a sheet that was full count as the sheet."""
    name = F.regexp_replace("sheet", r" \(\d+\)$", "")
    settings = sorted({k for s in sheets.values() for k in s})
    config = F.create_map(*[x for s, c in sheets.items() for x in (F.lit(s), F.struct(*[F.lit(c.get(k)).alias(k) for k in settings]))])
    bound = rows.withColumn("sheet", name).withColumn("_rl_config", F.try_element_at(config, F.col("sheet"))).where("_rl_config is not null")
    value = lambda names: F.coalesce(*[F.try_element_at(F.col("cells"), F.lit(n)) for n in names], F.lit(""))
    return bound.select("workbook", "sheet", "row", *[value(names).alias(r) for r, names in roles.items()], *[F.col(f"_rl_config.{k}").alias(k) for k in settings])
