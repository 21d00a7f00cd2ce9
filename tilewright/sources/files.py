"""Very many small directories with a file each, written by the tasks that hold their rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How Spark names the directory of a null, and what it escapes in others.
_NULL, _ESCAPED = "__HIVE_DEFAULT_PARTITION__", r"([\x01-\x1F\x7F\"#%'*/:=?\\\\{\[\]^])"


def partition_name(key: str) -> Column:
    """The directory ``key=value`` that Spark gives the rows of a partition value."""
    text = F.col(key).cast("string")
    parts = F.split(F.regexp_replace(text, _ESCAPED, "\x00$1\x00"), "\x00")  # every second one is escaped
    named = F.transform(
        parts, lambda p, i: F.when(i % 2 == 1, F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(p)), 2, "0"))).otherwise(p)
    )
    value = F.when(text == "", F.lit(_NULL)).otherwise(F.array_join(named, ""))
    return F.concat(F.lit(f"{key}="), F.coalesce(value, F.lit(_NULL)))


class _Text:
    """Lines of one column; a null is an empty line, as Spark writes it."""

    ending = "txt"

    def __init__(self, sink, schema: pa.Schema):
        self.sink = sink

    def write_batch(self, rows: pa.RecordBatch) -> None:
        lines = rows.column(0).fill_null("").to_pylist()
        self.sink.write(("\n".join(lines) + "\n").encode())

    def close(self) -> None:
        pass


class _Parquet(pq.ParquetWriter):
    """Files of a few rows are mostly footer: no ranges of texts, dictionaries or second schema are kept in them."""

    ending = "parquet"

    def __init__(self, sink, schema: pa.Schema):
        ranged = [f.name for f in schema if pa.types.is_primitive(f.type)]
        super().__init__(
            sink, schema, compression="zstd", use_dictionary=False, write_statistics=ranged, store_schema=False
        )


def write_directories(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """Rows to a new file of ``<path>/<directory>``, by their column ``directory``.

    ``rows`` have to be dealt and sorted by ``directory``. A partitioned write of Spark makes each directory
    several times over and moves it, with a process per step on plain disks; here a file is
    written once, batch by batch, and gets its name when it is whole. A task that is run
    again writes the same names.
    """
    opened, run = {"parquet": _Parquet, "text": _Text}[form], uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        files, base = fs.FileSystem.from_uri(path)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name, sink, writer, done = None, None, None, 0

        def finish():
            if writer is not None:
                writer.close()
                sink.close()
                place = f"{base}/{name}"
                files.move(f"{place}/.{run}-{attempt}", f"{place}/part-{part:05d}-{run}.{opened.ending}")

        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("directory")
            names = batch.column(at).to_numpy(zero_copy_only=False)
            kept = pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i != at], schema=batch.schema.remove(at)
            )
            begins = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            for begin, end in zip(begins, [*begins[1:], len(names)]):
                if names[begin] != name:
                    finish()
                    name, done = names[begin], done + 1
                    files.create_dir(f"{base}/{name}", recursive=True)
                    sink = files.open_output_stream(f"{base}/{name}/.{run}-{attempt}")
                    writer = opened(sink, kept.schema)
                writer.write_batch(kept.slice(begin, end - begin))
        finish()
        yield pa.record_batch({"done": pa.array([done], pa.int64())})

    rows.mapInArrow(write, "done long").agg(F.sum("done")).first()
