"""A sink that writes each row as a text file of its own name.

    named.register(spark)
    df.select("name", "value").write.format("named_text").mode("overwrite").save(folder)

Tasks write into a folder of their own attempt and rename each file when all are
written, so a file is either whole or absent, whatever executors are lost: a repeated
attempt replaces files of the same name by the same bytes. Nothing but a count per task
goes to the driver, which marks the end of the job by an empty ``_SUCCESS``.

``overwrite`` empties the folder first; ``append`` replaces files of the same names and
keeps others. A NULL value is an empty file. A name that is NULL, empty, has a ``/`` or
begins with ``.`` or ``_`` fails the job, as does one that a task meets twice; use
:func:`write_named` where names may repeat over the whole table. The folder must be on
storage that all executors share and that pyarrow opens (``file:``, ``hdfs:``, ``s3:``,
``gs:``, ``abfs:``).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STAGED, DONE = "_attempts", "_SUCCESS"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it; ``file:/a`` and ``file:///a`` are the local path ``/a``."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), folder
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(folder)


@dataclass
class Written(WriterCommitMessage):
    files: int


class NamedTextWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder.rstrip("/"), uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Written:
        store, root = opened(self.folder)
        attempt = f"{root}/{STAGED}/{self.job}/{uuid.uuid4().hex}"
        names: set[str] = set()
        try:
            for name, value in rows:
                if not name or "/" in name or name[0] in "._":
                    raise ValueError(f"{name!r} is no name of a file")
                if name in names:
                    raise ValueError(f"two rows are named {name!r}")
                if not names:
                    store.create_dir(attempt)
                names.add(name)
                with store.open_output_stream(f"{attempt}/{name}") as out:
                    out.write((value or "").encode("utf-8", "surrogatepass"))
            for name in names:
                _replace(store, f"{attempt}/{name}", f"{root}/{name}")
        finally:
            if names:
                store.delete_dir(attempt)
        return Written(len(names))

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.folder)
        self._clear(store, root)
        store.create_dir(root)
        store.open_output_stream(f"{root}/{DONE}").close()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*opened(self.folder))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        """Removes what attempts of this job left; other jobs keep theirs."""
        for folder in (f"{root}/{STAGED}/{self.job}", f"{root}/{STAGED}"):
            left = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            if folder.endswith(self.job) or not left:
                if store.get_file_info(folder).type == fs.FileType.Directory:
                    store.delete_dir(folder)


def _replace(store: fs.FileSystem, source: str, target: str) -> None:
    """Renames over an older file; some stores refuse that, so it is deleted first there."""
    try:
        store.move(source, target)
    except OSError:
        if store.get_file_info(target).type != fs.FileType.File:
            raise
        store.delete_file(target)
        store.move(source, target)


class NamedText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_text"

    def writer(self, schema: StructType, overwrite: bool) -> NamedTextWriter:
        if [(f.name, f.dataType) for f in schema] != [("name", StringType()), ("value", StringType())]:
            raise ValueError("named_text writes the columns (name string, value string)")
        folder = self.options["path"]
        if overwrite:
            store, root = opened(folder)
            store.delete_dir_contents(root, missing_dir_ok=True)
        return NamedTextWriter(folder)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedText)


def write_named(df: DataFrame, folder: str, name: Column, value: Column) -> None:
    """Writes ``value`` of each row to the file ``name`` of a folder, which is emptied first.

    Names that repeat are counted before anything is written and raise a ValueError.
    Neither texts nor rows are shuffled, only names.
    """
    register(df.sparkSession)
    rows = df.select(name.alias("name"), value.alias("value"))
    twice = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name").head(3)
    if twice:
        raise ValueError(f"names that repeat: {[r['name'] for r in twice]}")
    rows.write.format("named_text").mode("overwrite").save(folder)
