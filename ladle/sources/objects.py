"""Landed batches as named objects: one `<source>/<first>-<last>.json` per batch, written all or none.

A Python data source does the writing. A task writes its objects below a hidden staging folder of the job; when all
tasks are done they are moved to their names, replacing objects of the same name, and a job that fails takes its staging
folder away. So a reader sees no half-written object and none of an attempt that was lost or repeated, and the target keeps
its content until the very end. An attempt that fails, or finds its job ended, clears what it staged; one that is killed outright
may leave it, out of sight. Moving is one call per object from the driver: packed files (`write_batches`) are the
form for very many batches.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ladle.session import ship_package

FORMAT = "named_objects"
#: Objects moved or deleted at once.
AT_ONCE = 16
# Readers of folders skip names with a leading underscore.
_STAGING = "_staging"
# Stands in the staging folder of a job until the job ends.
_RUNNING = "_running"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


def _in_parallel(step, paths) -> None:
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for _ in pool.map(step, paths):
            pass


def _files(store: fs.FileSystem, folder: str) -> list[str]:
    chosen = fs.FileSelector(folder, recursive=True, allow_not_found=True)
    return [f.path for f in store.get_file_info(chosen) if f.type == fs.FileType.File]


def _drop(store: fs.FileSystem, folder: str) -> None:
    if store.get_file_info(folder).type == fs.FileType.Directory:
        store.delete_dir(folder)


@dataclass
class Staged(WriterCommitMessage):
    """The staging folder of one successful attempt."""

    folder: str


class ObjectWriter(DataSourceWriter):
    """Rows `name, body` -> objects. `truncate` empties the target when the job commits, not before."""

    def __init__(self, path: str, truncate: bool):
        self.path, self.truncate = path, truncate
        self.job = f"{_STAGING}/{uuid.uuid4().hex}"
        store, root = file_system(path)
        store.create_dir(f"{root}/{self.job}", recursive=True)
        store.open_output_stream(f"{root}/{self.job}/{_RUNNING}").close()

    def write(self, iterator: Iterator) -> Staged:
        store, root = file_system(self.path)
        folder = f"{root}/{self.job}/{uuid.uuid4().hex}"
        try:
            self._stage(store, folder, iterator)
            if store.get_file_info(f"{root}/{self.job}/{_RUNNING}").type != fs.FileType.File:
                raise RuntimeError("the job has ended")
        except BaseException:
            _drop(store, folder)
            raise
        return Staged(folder)

    def _stage(self, store: fs.FileSystem, folder: str, iterator: Iterator) -> None:
        made = set()
        for row in iterator:
            target = f"{folder}/{row['name']}"
            parent = target.rpartition("/")[0]
            if parent not in made:
                store.create_dir(parent, recursive=True)
                made.add(parent)
            with store.open_output_stream(target) as out:
                out.write((row["body"] or "").encode())

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = file_system(self.path)
        if self.truncate:
            staging = f"{root}/{_STAGING}/"
            _in_parallel(store.delete_file, [f for f in _files(store, root) if not f.startswith(staging)])
        for message in messages:
            if message is None:
                continue
            names = [f.removeprefix(message.folder + "/") for f in _files(store, message.folder)]
            for parent in {name.rpartition("/")[0] for name in names}:
                store.create_dir(f"{root}/{parent}", recursive=True)
            _in_parallel(lambda name: store.move(f"{message.folder}/{name}", f"{root}/{name}"), names)
        self._clear(store, root)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        _drop(store, f"{root}/{self.job}")
        staging = f"{root}/{_STAGING}"
        # Other jobs may be staging here.
        if store.get_file_info(staging).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(staging)):
            store.delete_dir(staging)


class NamedObjects(DataSource):
    """Write-only format `named_objects`: columns `name, body`, option `path`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        if schema.fieldNames() != ["name", "body"]:
            raise ValueError(f"columns name, body are written, not {schema.fieldNames()}")
        return ObjectWriter(self.options["path"], overwrite)


def write_objects(batches: DataFrame, path: str, source: str, clean: bool = False) -> None:
    """Write `batches(batch_key, body)` as `path/<source>/<batch_key>.json`; `clean` empties the target first."""
    if not source or "/" in source or source.startswith(("_", ".", "source=")):
        raise ValueError(f"{source!r} is no folder of landed objects")
    spark = batches.sparkSession
    ship_package(spark)
    spark.dataSource.register(NamedObjects)
    name = F.concat(F.lit(f"{source}/"), F.col("batch_key"), F.lit(".json"))
    (batches.select(name.alias("name"), "body").write.format(FORMAT)
            .mode("overwrite" if clean else "append").save(path if "://" in path else file_system(path)[1]))
