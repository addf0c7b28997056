"""Batch definitions: which files of a folder belong to a request.

A definition is a folder and a pattern with named groups over its file names
(``(?P<year>\\d{4})-(?P<month>\\d{2})-(?P<day>\\d{2})\\.parquet``). A request
fixes some of the groups: ``{"year": "2024", "month": "03"}`` is all days of a
month, ``{}`` is every file that matches. Names are listed once and compared
before anything is read, so only the files of the request are opened.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.session import list_folder

#: Fixed value: names of daily files.
DAILY_PATTERN = r"(?P<year>\d{4})-(?P<month>\d{2})-(?P<day>\d{2})\.parquet"


@dataclass(frozen=True)
class Batch:
    """A file (or Spark output folder) and the groups of its name."""

    path: str
    groups: tuple[tuple[str, str], ...]

    def __getitem__(self, name: str) -> str:
        return dict(self.groups)[name]


@dataclass(frozen=True)
class BatchDefinition:
    folder: str
    pattern: str = DAILY_PATTERN

    @property
    def names(self) -> list[str]:
        """Group names in the order of the pattern."""
        found = re.compile(self.pattern).groupindex
        return sorted(found, key=found.get)

    def batches(self, spark: SparkSession, request: dict[str, object] | None = None) -> list[Batch]:
        """The matching batches by the values of their groups, ascending. Values
        of a request are compared as text; integers take the zeros that the
        name has (month 3 is ``03``)."""
        request = dict(request or {})
        if unknown := set(request) - set(self.names):
            raise ValueError(f"the pattern has no groups {sorted(unknown)}, only {self.names}")
        out = []
        folder = self.folder.rstrip("/")
        for name in list_folder(spark, folder):
            if match := re.fullmatch(self.pattern, name):
                groups = match.groupdict()
                if all(_same(groups[k], v) for k, v in request.items()):
                    out.append(Batch(f"{folder}/{name}", tuple((n, groups[n]) for n in self.names)))
        return sorted(out, key=lambda b: [v or "" for _, v in b.groups])

    def read(self, spark: SparkSession, request: dict[str, object] | None = None, schema: T.StructType | str | None = None) -> DataFrame:
        """Rows of all batches of the request; no batch is an error. A schema
        saves Spark the look into a file, and fixes the columns of all."""
        found = self.batches(spark, request)
        if not found:
            raise FileNotFoundError(f"no batch of {self.folder} matches {request}")
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(*[b.path for b in found])

    def read_each(self, spark: SparkSession, request: dict[str, object] | None = None, schema: T.StructType | str | None = None) -> DataFrame:
        """As ``read``, with the groups of each row's batch as columns, taken
        from the path of the file that the row is read from."""
        rows = self.read(spark, request, schema)
        folder_name = r"([^/]+)(/part-[^/]*)?$"
        name = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), folder_name, 1))
        java = re.sub(r"\(\?P<", "(?<", self.pattern)
        groups = {n: F.regexp_extract(name, f"^{java}$", i + 1) for i, n in enumerate(self.names)}
        return rows.select("*", *[c.alias(n) for n, c in groups.items()])

    def latest(self, spark: SparkSession, request: dict[str, object] | None = None) -> Batch:
        """The last batch of the request by its groups (a validation's default)."""
        found = self.batches(spark, request)
        if not found:
            raise FileNotFoundError(f"no batch of {self.folder} matches {request}")
        return found[-1]


def _same(said: str | None, wanted: object) -> bool:
    if said is None:
        return wanted is None
    if isinstance(wanted, int):
        return said.isdigit() and int(said) == wanted
    return said == wanted
