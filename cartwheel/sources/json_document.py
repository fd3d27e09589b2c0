"""One JSON document from rows: a batch sink of the Data Source API (A2).

``df.write.format("json_document").mode("overwrite").save(path)`` takes rows (path, value) and publishes one file with
sorted keys, an indent of two blanks and a newline at the end.  A dotted path makes nested objects
(``validation.f1``).  The tasks hand their entries to the commit, which writes a temporary file beside the destination and
renames it: readers see the old document or the new one.  Aborted or failed writes leave the old document and no
temporary file.  A path given twice, or once as a value and once as an object, is an error.

A report has one entry per metric, so the document fits the driver by nature.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "json_document"


def nested(entries: list[tuple[str, object]]) -> dict:
    """Dotted paths → nested objects."""
    out: dict = {}
    for path, value in entries:
        *parents, last = path.split(".")
        at = out
        for p in parents:
            at = at.setdefault(p, {})
            if not isinstance(at, dict):
                raise ValueError(f"{path!r} goes through a value")
        if last in at:
            raise ValueError(f"{path!r} is given twice")
        at[last] = value
    return out


def rendered(document: dict) -> str:
    return json.dumps(document, indent=2, sort_keys=True) + "\n"


def _place(path: str):
    """(file system, path in it); a plain path is local."""
    from pyarrow import fs

    path = path.removeprefix("file://").removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


@dataclass
class Entries(WriterCommitMessage):
    values: list


class JsonDocumentWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.temporary = f"{path}.{uuid.uuid4().hex}.tmp"

    def write(self, rows: Iterator) -> Entries:
        return Entries([(r["path"], r["value"]) for r in rows])

    def commit(self, messages: list[Entries | None]) -> None:
        from pyarrow import fs

        entries = [e for m in messages if m is not None for e in m.values]
        text = rendered(nested(entries)).encode()  # an error here leaves everything as it was
        store, path = _place(self.path)
        _, temporary = _place(self.temporary)
        if not self.overwrite and store.get_file_info(path).type != fs.FileType.NotFound:
            raise FileExistsError(self.path)
        parent = path.rpartition("/")[0]
        if parent:
            store.create_dir(parent, recursive=True)
        with store.open_output_stream(temporary) as out:
            out.write(text)
        store.move(temporary, path)

    def abort(self, messages: list[Entries | None]) -> None:
        from pyarrow import fs

        store, temporary = _place(self.temporary)
        if store.get_file_info(temporary).type != fs.FileType.NotFound:
            store.delete_file(temporary)


class JsonDocument(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> JsonDocumentWriter:
        if [f.name for f in schema.fields] != ["path", "value"]:
            raise ValueError("a JSON document is written from the columns path, value")
        return JsonDocumentWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session; its classes travel by value, so that tasks need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(JsonDocument)
