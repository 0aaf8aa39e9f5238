"""``mailbox`` table source: mail files of a folder as rows, batch or stream.

Options: ``path`` (folder of ``.eml`` files, shared by the executors), ``host``,
``user`` and ``password`` are required as for a mail server; ``port`` is
optional. Columns are picked by their declared names, in any case.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

REQUIRED = ("path", "host", "user", "password")
KNOWN = (*REQUIRED, "port")
FILES_PER_TASK = 64


class MailFiles(InputPartition):
    def __init__(self, paths):
        self.paths = paths


def _field(message, name: str):
    from email.utils import parsedate_to_datetime

    kind = name.upper()
    if kind == "SUBJECT":
        return message["Subject"]
    if kind == "SENT":
        return parsedate_to_datetime(message["Date"]) if message["Date"] else None
    # The last hop's stamp follows the final semicolon of the first header.
    hop = message["Received"]
    return parsedate_to_datetime(hop.rsplit(";", 1)[1].strip()) if hop and ";" in hop else None


def _rows(paths, names):
    from email import policy
    from email.parser import BytesHeaderParser

    parser = BytesHeaderParser(policy=policy.default)
    for p in paths:
        with open(p, "rb") as f:
            m = parser.parse(f)
        yield tuple(_field(m, n) for n in names)


def _listing(path: str) -> list[str]:
    return sorted(e.path for e in os.scandir(path) if e.name.endswith(".eml"))


def _tasks(paths):
    return [MailFiles(paths[i:i + FILES_PER_TASK]) for i in range(0, len(paths), FILES_PER_TASK)] or [MailFiles([])]


class MailReader(DataSourceReader):
    def __init__(self, path: str, names):
        self.path, self.names = path, names

    def partitions(self):
        return _tasks(_listing(self.path))

    def read(self, partition):
        return _rows(partition.paths, self.names)


class MailStream(DataSourceStreamReader):
    """Offsets are file names, so new mail must sort after what was read."""

    def __init__(self, path: str, names):
        self.path, self.names = path, names

    def initialOffset(self):
        return {"after": ""}

    def latestOffset(self):
        files = _listing(self.path)
        return {"after": os.path.basename(files[-1]) if files else ""}

    def partitions(self, start, end):
        new = [p for p in _listing(self.path) if start["after"] < os.path.basename(p) <= end["after"]]
        return _tasks(new)

    def read(self, partition):
        return _rows(partition.paths, self.names)


class MailboxSource(DataSource):
    @classmethod
    def name(cls):
        return "mailbox"

    def __init__(self, options):
        super().__init__(options)
        missing = [o for o in REQUIRED if not options.get(o)]
        if missing:
            raise ValueError(f"mailbox needs the options {', '.join(missing)}")
        if options.get("port") and not options["port"].isdigit():
            raise ValueError("mailbox port must be a number")

    def schema(self):
        return "subject string, sent timestamp, received timestamp"

    def _names(self, schema: StructType):
        known = ("SUBJECT", "SENT", "RECEIVED")
        bad = [f.name for f in schema.fields if f.name.upper() not in known]
        if bad:
            raise ValueError(f"mailbox has no column {', '.join(bad)}")
        return [f.name for f in schema.fields]

    def reader(self, schema):
        return MailReader(self.options["path"], self._names(schema))

    def streamReader(self, schema):
        return MailStream(self.options["path"], self._names(schema))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MailboxSource)
