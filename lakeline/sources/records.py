"""A record store as a Spark data source: windowed extracts and batched loads.

``spark.read.format("lakeline_records")`` and ``df.write.format(...)`` go
through Spark's Python data source interface, as a client of a paging service
or a database would, with no server: the store is a folder of Parquet parts
and, under ``_lists``, of finished lists of them.

- Reading: one partition a part.  Filters on columns are pushed: parts whose
  least and greatest values rule a filter out aren't planned, the others
  filter their rows as they read.  Columns that aren't selected aren't read.
- Writing: each task writes its parts and reports them; only the driver's
  commit puts them on a list, so a failed task or job leaves no rows (abort
  removes its parts).  Option ``batch`` names a load: committing it again takes
  the place of its first commit, so a retried batch counts once.  Mode
  ``overwrite`` replaces the whole store.

Paths are read with pyarrow's file systems (local folders, S3, GCS, HDFS).
Two writers must not commit at the same time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "lakeline_records"
PART_ROWS = 200_000     # rows of a part, about


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _lists(store: pafs.FileSystem, root: str) -> list[str]:
    found = store.get_file_info(pafs.FileSelector(f"{root}/_lists", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".json"))


def parts(path: str) -> list[dict]:
    """The parts of the newest list: file, batch, rows, least and greatest values."""
    store, root = _place(path)
    known = _lists(store, root)
    if not known:
        return []
    with store.open_input_stream(known[-1]) as f:
        return json.loads(f.read())


def _plain(v):
    """A value as JSON keeps it, in the same order."""
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v if isinstance(v, (int, float, str, bool)) and v == v else None


_OPS = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Part(InputPartition):
    file: str


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema, self.tests = path, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = {f.name: f.dataType for f in self.schema.fields}
        for f in filters:
            simple = type(f) in _OPS and len(f.attribute) == 1 and isinstance(f.value, (int, float, str, dt.datetime, dt.date)) and \
                not isinstance(kinds[f.attribute[0]], (T.TimestampType, T.DecimalType))
            # Parts are ruled out by any such test; rows of floating columns are
            # left to Spark, for which NaN is a value like others, the greatest.
            exact = simple and not isinstance(kinds[f.attribute[0]], (T.FloatType, T.DoubleType))
            if simple:
                self.tests.append((f.attribute[0], _OPS[type(f)], f.value, exact))
            if not exact:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Part(p["file"]) for p in parts(self.path) if all(_may_hold(p["ends"].get(c), op, _plain(v)) for c, op, v, _ in self.tests)]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark asks once where there is no part
            return
        store, root = _place(self.path)
        wanted = to_arrow_schema(self.schema)
        tests = [(pc.field(c), op, pa.scalar(v, type=wanted.field(c).type)) for c, op, v, exact in self.tests if exact]
        keep = None
        for c, op, v in tests:
            one = {"==": c == v, ">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v}[op]
            keep = one if keep is None else keep & one
        with store.open_input_file(f"{root}/{partition.file}") as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=wanted.names):
                rows = pa.Table.from_batches([batch])
                rows = rows.filter(keep) if keep is not None else rows
                yield from rows.select(wanted.names).cast(wanted).to_batches()


def _may_hold(ends: list | None, op: str, v) -> bool:
    """Whether values from ends[0] to ends[1] can pass the test."""
    if not ends or v is None or ends[0] is None:
        return ends is None or v is None  # no values at all pass no test
    lo, hi = ends
    if type(lo) is not type(v) and not (isinstance(lo, (int, float)) and isinstance(v, (int, float))):
        return True
    return {"==": lo <= v <= hi, ">": hi > v, ">=": hi >= v, "<": lo < v, "<=": lo <= v}[op]


@dataclass
class Written(WriterCommitMessage):
    parts: list


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str, overwrite: bool):
        self.path, self.batch, self.overwrite = path, batch, overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _place(self.path)
        store.create_dir(f"{root}/data", recursive=True)
        out, held, rows = [], [], 0
        for b in iterator:
            held.append(b)
            rows += b.num_rows
            if rows >= PART_ROWS:
                out.append(self._part(store, root, held))
                held, rows = [], 0
        if rows:
            out.append(self._part(store, root, held))
        return Written(out)

    def _part(self, store: pafs.FileSystem, root: str, batches: list[pa.RecordBatch]) -> dict:
        rows, ends = pa.Table.from_batches(batches), {}
        for name in rows.column_names:
            kind = rows.schema.field(name).type
            if pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_string(kind) or pa.types.is_date(kind) or \
                    (pa.types.is_timestamp(kind) and kind.tz is None):
                if pa.types.is_floating(kind) and pc.any(pc.is_nan(rows[name])).as_py():
                    continue  # NaN has no place between least and greatest
                e = pc.min_max(rows[name]).as_py()
                ends[name] = [_plain(e["min"]), _plain(e["max"])]
        file = f"data/{self.job}-{uuid.uuid4().hex[:12]}.parquet"
        with store.open_output_stream(f"{root}/{file}") as f:
            pq.write_table(rows, f)
        return {"file": file, "batch": self.batch, "rows": rows.num_rows, "ends": ends}

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _place(self.path)
        new = [p for m in messages if m for p in m.parts]
        old = [] if self.overwrite else [p for p in parts(self.path) if p["batch"] != self.batch]
        store.create_dir(f"{root}/_lists", recursive=True)
        number = len(_lists(store, root)) + 1
        draft = f"{root}/_lists/draft-{self.job}"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps(old + new).encode())
        store.move(draft, f"{root}/_lists/{number:09d}.json")

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _place(self.path)
        found = store.get_file_info(pafs.FileSelector(f"{root}/data", allow_not_found=True))
        for f in found:
            if f.base_name.startswith(self.job):
                store.delete_file(f.path)


class Records(DataSource):
    """Options: path, batch (when writing).  A schema is asked for."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("read with .schema(...): the store holds what its writers gave it")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return Reader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options.get("batch", uuid.uuid4().hex), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to this session, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Records)


def append(df: DataFrame, path: str, batch: str, mode: str = "append") -> None:
    """Load ``df`` as the batch ``batch``: whole or not at all, and once."""
    df.write.format(FORMAT).option("path", path).option("batch", batch).mode(mode).save()


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.format(FORMAT).schema(schema).option("path", path).load()
