"""Arrays in ``.npy`` files as a Spark data source.

``spark.read.format("npy")`` reads a file, or a folder of files, that each
hold one two-dimensional array of numbers in row order. The header tells where
the rows begin and how wide they are, so a file is cut into ranges of whole
rows and every task reads the bytes of its own range. Columns are named by the
option ``columns`` (default ``c0, c1, …``); ``rangeBytes`` is the size of a range.

``write_npy`` writes one file per task. A task counts its rows by writing them
behind a header of fixed length, which is filled in at the end; files appear
under their names when the job commits.

Paths are folders that driver and executors share, or URIs that
``pyarrow.fs`` reaches.
"""

from __future__ import annotations

import ast
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from simpairs.session import ship_package

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
HEADER = 128
#: Fixed value: the first bytes of the file format.
MAGIC = b"\x93NUMPY"
TYPES = {"i1": "tinyint", "i2": "smallint", "i4": "int", "i8": "long", "f4": "float", "f8": "double", "u1": "smallint",
         "u2": "int", "u4": "long"}


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:"):]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Header:
    """Where the rows of a file begin, how many there are, and their numbers."""

    offset: int
    rows: int
    width: int
    dtype: str

    @classmethod
    def read(cls, fs: pafs.FileSystem, name: str) -> Header:
        with fs.open_input_file(name) as f:
            start = f.read(10)
            if start[:6] != MAGIC:
                raise ValueError(f"{name} is no .npy file")
            if start[6] == 1:
                length, at = struct.unpack("<H", start[8:10])[0], 10
            else:
                length, at = struct.unpack("<I", start[8:10] + f.read(2))[0], 12
            info = ast.literal_eval(f.read(length).decode("latin-1"))
        dtype, shape = np.dtype(info["descr"]), info["shape"]
        if dtype.str[1:] not in TYPES or len(shape) not in (1, 2) or (info["fortran_order"] and len(shape) == 2 and 1 not in shape):
            raise ValueError(f"{name} holds {info}: rows of plain numbers, in row order, can be read")
        return cls(at + length, shape[0], shape[1] if len(shape) == 2 else 1, dtype.str)


@dataclass
class Rows(InputPartition):
    name: str
    dtype: str
    width: int
    offset: int
    rows: int


def _files(path: str) -> tuple[pafs.FileSystem, list[str]]:
    fs, name = _file_system(path)
    info = fs.get_file_info(name)
    if info.type == pafs.FileType.File:
        return fs, [name]
    if info.type != pafs.FileType.Directory:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pafs.FileSelector(name))
    return fs, sorted(f.path for f in found if f.path.endswith(".npy") and not f.base_name.startswith(("_", ".")))


class NpyReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.options = schema, options

    def partitions(self):
        fs, names = _files(self.options["path"])
        most = int(self.options.get("rangebytes", RANGE_BYTES))
        out = []
        for name in names:
            h = Header.read(fs, name)
            if h.width != len(self.schema.fields):
                raise ValueError(f"{name} has rows of {h.width} numbers, not {len(self.schema.fields)}")
            wide = h.width * np.dtype(h.dtype).itemsize
            step = max(1, most // wide)
            out += [Rows(name, h.dtype, h.width, h.offset + at * wide, min(step, h.rows - at)) for at in range(0, h.rows, step)]
        return out or [Rows("", "<i8", len(self.schema.fields), 0, 0)]

    def read(self, partition: Rows):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        if not partition.rows:
            return
        fs, _ = _file_system(self.options["path"])
        dtype = np.dtype(partition.dtype)
        step = max(1, BLOCK_BYTES // (partition.width * dtype.itemsize))
        with fs.open_input_file(partition.name) as f:
            f.seek(partition.offset)
            for at in range(0, partition.rows, step):
                n = min(step, partition.rows - at) * partition.width
                data = f.read(n * dtype.itemsize)
                if len(data) < n * dtype.itemsize:
                    raise ValueError(f"{partition.name} ends before its rows do")
                block = np.frombuffer(data, dtype).reshape(-1, partition.width)
                columns = [np.ascontiguousarray(block[:, i]).astype(dtype.newbyteorder("=")) for i in range(partition.width)]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(t.type) for c, t in zip(columns, schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, schema, options):
        self.options, self.width = options, len(schema.fields)
        self.dtype = options.get("dtype", "<f8")
        if np.dtype(self.dtype).str[1:] not in TYPES:
            raise ValueError(f"dtype = {self.dtype!r}: one of {', '.join(TYPES)}")

    def write(self, iterator):
        from uuid import uuid4

        from pyspark import TaskContext

        fs, folder = _file_system(self.options["path"])
        fs.create_dir(folder, recursive=True)
        number = TaskContext.get().partitionId()
        own = uuid4().hex
        body = f"{folder}/_body-{own}"
        rows = 0
        with fs.open_output_stream(body) as f:
            for batch in iterator:
                block = np.empty((batch.num_rows, self.width), np.dtype(self.dtype))
                for i, column in enumerate(batch.columns):
                    if column.null_count and np.dtype(self.dtype).kind != "f":
                        raise ValueError("an array of whole numbers has no place for nulls")
                    block[:, i] = column.to_numpy(zero_copy_only=False)
                f.write(block.tobytes())
                rows += batch.num_rows
        text = repr({"descr": np.dtype(self.dtype).str, "fortran_order": False, "shape": (rows, self.width)}).encode("latin-1")
        text += b" " * (HEADER - 11 - len(text)) + b"\n"
        done = f"{folder}/_done-{own}"
        with fs.open_output_stream(done) as out, fs.open_input_stream(body) as f:
            out.write(MAGIC + b"\x01\x00" + struct.pack("<H", len(text)) + text)
            while block := f.read(BLOCK_BYTES):
                out.write(block)
        fs.delete_file(body)
        return Written(done, f"{folder}/part-{number:05d}.npy")

    def commit(self, messages):
        fs, folder = _file_system(self.options["path"])
        for m in messages:
            if m is not None:
                fs.move(m.temporary, m.final)

    def abort(self, messages):
        fs, folder = _file_system(self.options["path"])
        for m in messages:
            if m is not None:
                fs.delete_file(m.temporary)


class NpyDataSource(DataSource):
    """``format("npy")``: arrays of numbers, a row of the array a row of the table."""

    @classmethod
    def name(cls):
        return "npy"

    def schema(self):
        fs, names = _files(self.options["path"])
        if not names:
            raise FileNotFoundError(f"no .npy file below {self.options['path']}")
        h = Header.read(fs, names[0])
        named = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()] or [f"c{i}" for i in range(h.width)]
        if len(named) != h.width:
            raise ValueError(f"{len(named)} names for rows of {h.width} numbers")
        return ", ".join(f"`{c}` {TYPES[np.dtype(h.dtype).str[1:]]}" for c in named)

    def reader(self, schema):
        return NpyReader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite):
        return NpyWriter(schema, {k.lower(): v for k, v in self.options.items()})


def with_npy(spark: SparkSession) -> SparkSession:
    """The session with the data source registered."""
    ship_package(spark)
    spark.dataSource.register(NpyDataSource)
    return spark


def write_npy(df: DataFrame, path: str, dtype: str = "<f8") -> None:
    """Write numeric columns as ``.npy`` files below ``path``, one per task.

    All columns get one number type. Nulls become NaN in an array of floats
    and fail the job in one of whole numbers.
    """
    with_npy(df.sparkSession)
    df.write.format("npy").mode("append").option("dtype", dtype).save(path)
