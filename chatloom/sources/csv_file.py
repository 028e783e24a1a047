"""One CSV file written by many tasks, in the dialect of Python's ``csv``: whole or not at all.

Each task writes the rows of its partition to a part file beside the target, on a file system that
all machines reach through Arrow; when all have, the parts are joined in the order of the partitions.
"""

from __future__ import annotations

import csv
import io
import json
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.formats import json_cell
from ..storage import arrow_url


def cell(value: Any) -> Any:
    """Lists and records as JSON, null as nothing. Records of a value and its number are pairs."""

    def plain(v: Any) -> Any:
        if isinstance(v, Row):
            fields = v.asDict()
            return [plain(x) for x in fields.values()] if list(fields) == ["value", "n"] else {k: plain(x) for k, x in fields.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return "" if value is None else json_cell(plain(value)) if isinstance(value, (list, Row)) else value


@dataclass
class _Part(WriterCommitMessage):
    partition: int
    path: str
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, url: str, names: list[str]) -> None:
        self.url, self.names, self.run = url, names, uuid.uuid4().hex

    def _target(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.url)

    def write(self, rows: Iterator[Row]) -> _Part:
        files, target = self._target()
        partition, n, path = TaskContext.get().partitionId(), 0, f"{target}.{self.run}.{uuid.uuid4().hex}.part"
        with io.TextIOWrapper(files.open_output_stream(path), encoding="utf-8", newline="") as f:
            out = csv.writer(f)
            for n, row in enumerate(rows, 1):
                out.writerow([cell(v) for v in row])
        return _Part(partition, path, n)

    def commit(self, messages: list[_Part | None]) -> None:
        files, target = self._target()
        head = io.StringIO(newline="")
        csv.writer(head).writerow(self.names)
        whole = f"{target}.{self.run}.whole"
        with files.open_output_stream(whole) as f:
            f.write(head.getvalue().encode())
            for m in sorted((m for m in messages if m), key=lambda m: m.partition):
                with files.open_input_stream(m.path) as part:
                    shutil.copyfileobj(part, f, 1 << 20)
        files.move(whole, target)
        self.abort(messages)

    def abort(self, messages: list[_Part | None]) -> None:
        """Parts of tasks that failed or ran twice go too."""
        files, target = self._target()
        for found in files.get_file_info(fs.FileSelector(target.rpartition("/")[0])):
            if found.path.startswith(f"{target}.{self.run}."):
                files.delete_file(found.path)


class CsvFile(DataSource):
    """Options: ``path``, and ``header``, a JSON list of the columns' names in the file."""

    @classmethod
    def name(cls) -> str:
        return "chat_csv"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], json.loads(self.options["header"]))


def write(df: DataFrame, path: str | Path, header: tuple[str, ...]) -> int:
    """``df`` in the order of its partitions and their rows as one file; the header is there without rows too. How many rows it has."""
    url = arrow_url(df.sparkSession, str(path))
    files, target = fs.FileSystem.from_uri(url)
    files.create_dir(target.rpartition("/")[0])
    df.sparkSession.dataSource.register(CsvFile)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("chat_csv").options(path=url, header=json_cell(list(header))).mode("append").save()
    return seen.get["n"]
