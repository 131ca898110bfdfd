"""Notifications of an inbox as a streaming source with offsets of its own (Python Data Source API).

The offset is the number of the last micro-batch of inserts that was told. Inserts lie in a folder for each micro-batch and,
below it, each queue; a folder counts once it is complete. So a reader of some queues lists and opens their files only, each
queue of a trigger is a partition of its own, and ``batchesPerTrigger`` bounds what a trigger gets. The driver handles
offsets and names of files; executors read them.

    notifications.register(spark)
    spark.readStream.format("millrace_notifications").option("path", inbox.path).option("queues", "mail,sms").load()

Options: path (a file system that Arrow knows), queues (by commas; all if absent), batchesPerTrigger (all that is there if
absent), reader (a name; with a bound, the place is kept under it in the inbox, as Spark doesn't tell a source where a
restarted query goes on before it asks for more).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "millrace_notifications"


class _Files(InputPartition):
    def __init__(self, queue: str, files: list[str]):
        self.queue, self.files = queue, files


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.queues = set(options["queues"].split(",")) if options.get("queues") else None
        self.most = int(options["batchesPerTrigger"]) if options.get("batchesPerTrigger") else None
        self.reader, self.at = options.get("reader"), None

    def _fs(self):
        from pyarrow import fs

        uri = self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}"
        return fs.FileSystem.from_uri(uri)

    def _listed(self, folder: str) -> list:
        from pyarrow import fs

        system, base = self._fs()
        return system.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True))

    def _complete(self, after: int) -> list[int]:
        numbers = sorted(int(f.base_name.removeprefix("batch=")) for f in self._listed("notify") if f.base_name.startswith("batch="))
        found = []
        for n in (n for n in numbers if n > after):
            if not any(f.base_name == "_SUCCESS" for f in self._listed(f"notify/batch={n}")):
                break  # it is being written; later ones wait for it
            found.append(n)
            if len(found) == self.most:
                break
        return found

    def _place(self) -> int:
        system, base = self._fs()
        try:
            with system.open_input_stream(f"{base}/readers/{self.reader}.json") as f:
                return json.loads(f.read())["batch"]
        except FileNotFoundError:
            return -1

    def initialOffset(self) -> dict:
        return {"batch": -1}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._place() if self.reader else -1
        found = self._complete(self.at)
        return {"batch": found[-1] if found else self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = max(end["batch"], -1 if self.at is None else self.at)
        files: dict[str, list[str]] = {}
        for n in range(start["batch"] + 1, end["batch"] + 1):
            for folder in self._listed(f"notify/batch={n}"):
                queue = unquote(folder.base_name.removeprefix("job_type="))
                if folder.base_name.startswith("job_type=") and (self.queues is None or queue in self.queues):
                    files.setdefault(queue, []).extend(f.path for f in self._listed(f"notify/batch={n}/{folder.base_name}") if f.base_name.startswith("part-"))
        return [_Files(queue, sorted(paths)) for queue, paths in sorted(files.items())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        system, _ = self._fs()
        for path in partition.files:
            with system.open_input_stream(path) as f:
                for line in f.read().decode().splitlines():
                    yield partition.queue, json.loads(line)["ids"]

    def commit(self, end: dict) -> None:
        if self.reader and end["batch"] >= 0:
            system, base = self._fs()
            system.create_dir(f"{base}/readers", recursive=True)
            with system.open_output_stream(f"{base}/readers/{self.reader}.json") as f:
                f.write(json.dumps(end).encode())


class NotificationSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "job_type string, ids array<string>"

    def streamReader(self, schema) -> _Reader:
        if self.options.get("batchesPerTrigger") and not self.options.get("reader"):
            raise ValueError("a reader with batchesPerTrigger needs a name (option reader)")
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the source known to a session; its code goes along to executors that lack this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(NotificationSource)
