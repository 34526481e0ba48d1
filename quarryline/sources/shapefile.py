"""Polygon shapefiles as a Python data source, "shapefile": one partition for each .shp file when reading, one file for
each partition when writing. Paths are in any store that pyarrow reaches; written files are whole before they get their
final names, in the commit."""

from __future__ import annotations

import math
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import ArrayType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ..session import ship

POINT = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
GEOMETRY = ArrayType(ArrayType(POINT))
# The attribute table of a result layer, name and width.
LAYER_TEXT = {"Class": 5, "Sensor": 10, "Date": 10, "Time": 10, "CatalogID": 20}
POLYGON = 5


#: Columns of a read table that no file has.
OWN = ("geometry", "prj", "file", "_fid")


def open_store(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), urlparse(path).path) if urlparse(path).scheme in ("", "file") else fs.FileSystem.from_uri(path)


def _bytes(store, path: str) -> bytes:
    with store.open_input_stream(path) as f:
        return f.read()


def _head(store, path: str) -> bytes:
    """The description of the columns alone."""
    with store.open_input_stream(path) as f:
        first = f.read(32)
        return first + f.read(struct.unpack("<H", first[8:10])[0] - 32)


def fields_of(dbf: bytes) -> list[tuple[str, str, int, int]]:
    """(name, kind, width, decimals) of the table's columns."""
    out, at = [], 32
    while dbf[at] != 0x0D:
        name = dbf[at : at + 11].split(b"\0")[0].decode("latin-1")
        out.append((name, chr(dbf[at + 11]), dbf[at + 16], dbf[at + 17]))
        at += 32
    return out


def rings_of(shp: bytes) -> Iterator[list[list[tuple[float, float]]]]:
    """The rings of each record; a null shape has none."""
    at = 100
    while at + 8 <= len(shp):
        size = struct.unpack(">i", shp[at + 4 : at + 8])[0] * 2
        body = shp[at + 8 : at + 8 + size]
        at += 8 + size
        if struct.unpack("<i", body[:4])[0] % 10 != POLYGON:
            yield []
            continue
        parts, points = struct.unpack("<2i", body[36:44])
        starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
        xy = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
        flat = list(zip(xy[::2], xy[1::2]))
        yield [flat[a:b] for a, b in zip(starts, starts[1:])]


def records_of(dbf: bytes) -> Iterator[list | None]:
    """The values of each record; None for one that is marked as deleted."""
    count, head, size = struct.unpack("<IHH", dbf[4:12])
    columns = fields_of(dbf)
    for k in range(count):
        at, row = head + k * size + 1, []
        if dbf[at - 1 : at] == b"*":
            yield None
            continue
        for _, kind, width, decimals in columns:
            raw = dbf[at : at + width].decode("utf-8", "replace").strip(" \0")
            at += width
            row.append((float(raw) if decimals else int(raw)) if kind in "NF" and raw else None if kind in "NF" else raw)
        yield row


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str, names: list[str]):
        self.root, self.names = path, names

    def partitions(self) -> list[_File]:
        return [_File(p) for p in files(self.root)]

    def read(self, partition: _File) -> Iterator[tuple]:
        store, _ = open_store(self.root)
        table = _bytes(store, partition.path[:-4] + ".dbf")
        own, prj = [c[0] for c in fields_of(table)], projection(store, partition.path)
        for fid, (rings, values) in enumerate(zip(rings_of(_bytes(store, partition.path)), records_of(table))):
            if values is not None:
                named = dict(zip(own, values))
                yield ([[Row(x=x, y=y) for x, y in ring] for ring in rings], *[named.get(n) for n in self.names], prj, partition.path, fid)


def projection(store, path: str) -> str | None:
    """The text of the .prj file beside a .shp file."""
    from pyarrow import fs

    beside = path[:-4] + ".prj"
    return _bytes(store, beside).decode("utf-8", "replace").strip() if store.get_file_info(beside).type == fs.FileType.File else None


def files(root: str, folder: str = "") -> list[str]:
    """The .shp files below a folder, or the file itself, in the order of their names; with `folder`, only those in a
    folder whose name has it."""
    from pyarrow import fs

    store, path = open_store(root)
    if path.endswith(".shp"):
        return [path]
    found = store.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted(f.path for f in found if f.path.endswith(".shp") and "/." not in f.path and folder in f.path.rsplit("/", 2)[-2])


def _header(size: int, box: list[float]) -> bytes:
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i", 1000, POLYGON) + struct.pack("<8d", *box, 0, 0, 0, 0)


def encode(rows: list[tuple[list, list]], columns: list[tuple[str, str, int, int]]) -> dict[str, bytes]:
    """The .shp, .shx and .dbf bytes of (rings, values) rows. Rings are closed if they are not."""
    shapes, index, at, box = [], [], 100, [float("inf"), float("inf"), float("-inf"), float("-inf")]
    for n, (rings, _) in enumerate(rows, 1):
        rings = [[(p["x"], p["y"]) for p in ring] for ring in rings or []]
        rings = [ring if ring[0] == ring[-1] else [*ring, ring[0]] for ring in rings if ring]
        if rings:
            xs, ys = [x for r in rings for x, _ in r], [y for r in rings for _, y in r]
            own = [min(xs), min(ys), max(xs), max(ys)]
            box = [min(box[0], own[0]), min(box[1], own[1]), max(box[2], own[2]), max(box[3], own[3])]
            starts, total = [], 0
            for r in rings:
                starts.append(total)
                total += len(r)
            body = struct.pack("<i4d2i", POLYGON, *own, len(rings), total) + struct.pack(f"<{len(starts)}i", *starts)
            body += b"".join(struct.pack("<2d", x, y) for r in rings for x, y in r)
        else:
            body = struct.pack("<i", 0)
        shapes.append(struct.pack(">2i", n, len(body) // 2) + body)
        index.append(struct.pack(">2i", at // 2, len(body) // 2))
        at += 8 + len(body)
    box = box if rows and box[0] <= box[2] else [0.0] * 4
    width = 1 + sum(c[2] for c in columns)
    table = struct.pack("<4BIHH20x", 3, 100, 1, 1, len(rows), 33 + 32 * len(columns), width)
    for name, kind, size, decimals in columns:
        table += struct.pack("<11sc4xBB14x", name.encode("latin-1")[:10], kind.encode(), size, decimals)
    table += b"\r"
    for _, values in rows:
        table += b" "
        for (_, kind, size, decimals), v in zip(columns, values):
            text = "" if v is None else f"{v:.{decimals}f}" if kind == "N" else str(v)
            raw = text.encode()
            if len(raw) > size:
                raise ValueError(f"{text!r} does not fit in {size} bytes")
            table += raw.rjust(size) if kind == "N" else raw.ljust(size)
    return {"shp": _header(at, box) + b"".join(shapes), "shx": _header(100 + 8 * len(rows), box) + b"".join(index), "dbf": table + b"\x1a"}


class _Message(WriterCommitMessage):
    def __init__(self, staged: list[tuple[str, str, list[str]]]):
        self.staged = staged


def _column(field: StructField, values: list) -> tuple[str, str, int, int]:
    """(name, kind, width, decimals) of a column that holds all the values whole."""
    if isinstance(field.dataType, (LongType, IntegerType, ShortType, ByteType)):
        return field.name, "N", max([18, *[len(str(v)) for v in values if v is not None]]), 0
    if isinstance(field.dataType, (DoubleType, FloatType)):
        if any(v is not None and not math.isfinite(v) for v in values):
            raise ValueError(f"{field.name} has a number that is not finite")
        wide = max([20, *[len(f"{v:.3f}") for v in values if v is not None]])
        if wide > 254:
            raise ValueError(f"{field.name} has a number of more than 254 digits")
        return field.name, "N", wide, 3
    wide = max([LAYER_TEXT.get(field.name, 1), *[len(str(v).encode()) for v in values if v is not None]])
    if wide > 254:
        raise ValueError(f"{field.name} has a text of {wide} bytes; a shapefile holds 254")
    return field.name, "C", wide, 0


def file_name(values: list) -> str:
    """The place of a file by its values, all but the last of which are folders. Null is `null`."""
    return "/".join(re.sub(r"[/\\\0]|^\.+", "_", "null" if v is None else str(v)) or "_" for v in values)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, schema: StructType, wkt: str | None, by: str | None = None, overwrite: bool = False):
        self.root, self.schema, self.wkt, self.overwrite = path, schema, wkt, overwrite
        self.by = [c.strip() for c in by.split(",")] if by else []
        names = [f.name for f in schema if f.name not in OWN]
        missing = [c for c in self.by if c not in schema.fieldNames()]
        long = [n for n in names if len(n.encode()) > 10]
        if missing or long:
            raise ValueError(f"no column {missing}" if missing else f"a shapefile's column names have 10 bytes at most: {long}; rename them")
        if len({n.lower() for n in names}) < len(names):
            raise ValueError("column names differ in more than case")

    def write(self, rows: Iterator[Row]) -> _Message:
        fields = [f for f in self.schema if f.name not in OWN]
        groups: dict[str, list] = {}
        texts: dict[str, set[str]] = {}
        for r in rows:
            own = file_name([r[c] for c in self.by]) if self.by else ""
            groups.setdefault(own, []).append((r["geometry"], [r[f.name] for f in fields]))
            if "prj" in self.schema.fieldNames() and r["prj"]:
                texts.setdefault(own, set()).add(r["prj"])
        store, folder = open_store(self.root)
        store.create_dir(folder, recursive=True)
        staged = []
        for group, found in groups.items():
            parts = encode(found, [_column(f, [v[k] for _, v in found]) for k, f in enumerate(fields)])
            if len(texts.get(group, ())) > 1:
                raise ValueError(f"rows of {group or 'a file'} have several coordinate systems; align them, or write them apart")
            wkt = self.wkt or next(iter(texts.get(group, ())), None)
            if wkt:
                parts["prj"] = wkt.encode()
            own = uuid.uuid4().hex
            for kind, data in parts.items():
                with store.open_output_stream(f"{folder}/.{own}.{kind}") as out:
                    out.write(data)
            staged.append((own, group or f"part-{own}", list(parts)))
        return _Message(staged)

    def commit(self, messages: list[_Message | None]) -> None:
        """Every staged file gets a name of its own: the first of a value the value's, further ones, of rows that lay in
        other partitions or runs, the same with a number. With overwrite the files from before go when the new ones are
        there."""
        from pyarrow import fs

        store, folder = open_store(self.root)
        store.create_dir(folder, recursive=True)
        found = store.get_file_info(fs.FileSelector(folder, recursive=True))
        before = {f.path for f in found if f.is_file and not f.base_name.startswith(".") and f.extension in ("shp", "shx", "dbf", "prj")}
        new, taken = set(), set() if self.overwrite else {f.rsplit(".", 1)[0] for f in before}
        for own, name, kinds in (x for m in messages if m for x in m.staged):
            target, n = f"{folder}/{name}", 1
            while target in taken:
                n += 1
                target = f"{folder}/{name}-{n}"
            taken.add(target)
            if "/" in name:
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
            for kind in kinds:
                store.move(f"{folder}/.{own}.{kind}", f"{target}.{kind}")
                new.add(f"{target}.{kind}")
        if self.overwrite:
            for path in before - new:
                store.delete_file(path)

    def abort(self, messages: list[_Message | None]) -> None:
        store, folder = open_store(self.root)
        for own, _, kinds in (x for m in messages if m for x in m.staged):
            for kind in kinds:
                store.delete_file(f"{folder}/.{own}.{kind}")


class ShapefileSource(DataSource):
    """spark.read.format("shapefile").load(path); df.write.format("shapefile").option("wkt", ...).save(path).

    Reading gives the columns of all files by name, null where a file lacks one, then prj, the text of the coordinate
    system (null without one), file and _fid, the place in the
    file; records marked as deleted are left out. Writing makes columns as wide as their values need, and fails for a
    text of more than 254 bytes or a column name of more than 10; doubles are rounded to 3 decimals, as a result layer
    has them. The .prj file has the option wkt, or else the text in a column prj. mode("overwrite") deletes the shapefiles that were in the folder. option("by", "area,country,name") makes files
    by the values of columns, the last the file's name, the others its folders. Rows of a value that lie in several
    partitions give several files, numbered; split_by brings them together."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> StructType:
        store, _ = open_store(self.options["path"])
        found = files(self.options["path"])
        kinds: dict[str, int] = {}
        for path in found:
            for n, k, _, d in fields_of(_head(store, path[:-4] + ".dbf")):
                kinds[n] = max(kinds.get(n, 0), 2 if k not in "NF" else 1 if d else 0)
        types = (LongType(), DoubleType(), StringType())
        return StructType([StructField("geometry", GEOMETRY), *[StructField(n, types[k]) for n, k in kinds.items()], *[StructField(n, StringType()) for n in OWN[1:3]], StructField("_fid", LongType())])

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"], [f.name for f in schema if f.name not in OWN])

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], schema, self.options.get("wkt"), self.options.get("by"), overwrite)


def split_by(rows: DataFrame, path: str, by: list[str], wkt: str | None = None, mode: str = "append") -> None:
    """One shapefile for each combination of values: layers of footprints by area, country, grid cell and name."""
    register(rows.sparkSession)
    out = rows.repartition(*by).write.format("shapefile").mode(mode).option("by", ",".join(by))
    (out.option("wkt", wkt) if wkt else out).save(path)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ShapefileSource)
