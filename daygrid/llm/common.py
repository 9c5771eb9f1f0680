"""What the operators of this folder share: scratch tables, table access, batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_own_scratch: tempfile.TemporaryDirectory | None = None
#: Scratch tables that this process wrote and did not delete.
_written: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share.

    ``spark.checkpoint.dir`` names the folder. Only a single-process local master
    without the setting, as in tests, gets a temporary one.
    """
    global _own_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if _own_scratch is None:
            _own_scratch = tempfile.TemporaryDirectory(prefix="daygrid-llm-")
        named = _own_scratch.name
    path = f"{named.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Writes ``frame`` to the shared folder and returns the written table (cuts lineage)."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def scratch_tables() -> list[str]:
    """Scratch tables that are there, in the order they were written."""
    return list(_written)


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Deletes scratch tables by Spark's own file system access, all of this process if none are
    named. Frames that read them can't be run any more: call it once results are written."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in scratch_tables() if paths is None else paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        if path in _written:
            _written.remove(path)


def staged_in_place_of(frame: DataFrame, label: str, mark: int) -> DataFrame:
    """``staged``, after which the scratch tables written since ``mark`` tables are deleted."""
    made = staged(frame, label)
    drop_scratch(frame.sparkSession, scratch_tables()[mark:-1])
    return made


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_row(
    frame: DataFrame, schema: str, make: Callable[[pa.RecordBatch], dict[str, object]]
) -> DataFrame:
    """Maps Arrow batches, ``ROWS`` rows at most at a time, to batches of ``schema``. Spark
    bounds a batch by rows and bytes (``spark.sql.execution.arrow.maxBytesPerBatch``).

    ``make`` gets a batch and returns a list or array for every output column.
    """
    fields = frame.sparkSession.createDataFrame([], schema).schema.fields
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(field.dataType) for field in fields]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                made = make(batch.slice(start, ROWS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[n], type=t) for n, t in zip(names, types, strict=True)], names
                )

    return frame.mapInArrow(run, schema)


def per_batch(
    frame: DataFrame, schema: str, make: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int
) -> DataFrame:
    """Maps Arrow batches, ``rows`` rows at most at a time, to batches of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield make(batch.slice(start, rows))

    return frame.mapInArrow(run, schema)


def free_names(frame: DataFrame, *stems: str) -> list[str]:
    """Column names made from ``stems`` that ``frame`` does not have."""
    taken = {name.lower() for name in frame.columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        out.append(stem)
    return out


#: Rows that a Python step holds as objects at a time; bounds memory, drops nothing.
ROWS = 256


class WordCache(dict):
    """Results by word. Computes what is missing and starts anew beyond ``limit`` entries."""

    def __init__(self, compute: Callable[[str], object], limit: int = 300_000):
        super().__init__()
        self.compute = compute
        self.limit = limit

    def __missing__(self, word: str) -> object:
        if len(self) >= self.limit:
            self.clear()
        made = self.compute(word)
        if len(word) <= 64:  # long ones hardly come again
            self[word] = made
        return made
