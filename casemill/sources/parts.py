"""Keyed tables cut into parts by a hash of the key, of which a new version
rewrites the touched parts alone.

    data/version=V/part=K/   rows of part K as version V wrote them
    versions/V.json          which version holds each part, and a note

The file in `versions` is written last and makes the version exist; a write
that failed before is repeated or overwritten, and readers of older versions
are not disturbed.  One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.sources.files import exists, names, read_text, write_text


@dataclass(frozen=True)
class Version:
    number: int = -1
    parts: dict[int, int] = field(default_factory=dict)  # part -> version that wrote it
    note: dict = field(default_factory=dict)


class PartTable:
    """A table of `schema` below `folder`, in `parts` parts by the hash of the
    `key` column.  `parts` is fixed when the table is first written."""

    def __init__(self, spark: SparkSession, folder: str, key: str, schema: T.StructType, parts: int = 64):
        self.spark, self.folder, self.key, self.schema, self.n_parts = spark, folder, key, schema, parts

    def version(self) -> Version:
        """The latest version."""
        numbers = [int(n.removesuffix(".json")) for n in names(self.spark, f"{self.folder}/versions") if n.endswith(".json")]
        if not numbers:
            return Version()
        held = json.loads(read_text(self.spark, f"{self.folder}/versions/{max(numbers):09d}.json"))
        if held["n_parts"] != self.n_parts:
            raise ValueError(f"{self.folder} has {held['n_parts']} parts, not {self.n_parts}")
        return Version(max(numbers), {int(k): v for k, v in held["parts"].items()}, held["note"])

    def part(self, key: Column | None = None) -> Column:
        key = F.col(self.key) if key is None else key
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.n_parts)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that the keys of `rows` are in: `parts` numbers at most."""
        return sorted(r[0] for r in rows.select(self.part().alias("part")).distinct().collect())

    def read(self, only: Iterable[int] | None = None, version: Version | None = None) -> DataFrame:
        """The rows of all parts or of some: other parts' files are not listed."""
        version = version or self.version()
        wanted = sorted(version.parts) if only is None else [k for k in only if k in version.parts]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.folder}/data/version={version.parts[k]}/part={k}" for k in wanted]
        return self.spark.read.schema(self.schema).parquet(*folders)

    def replace(self, rows: DataFrame, touched: Iterable[int], number: int, note: dict | None = None) -> Version:
        """Version `number`: the touched parts hold `rows`, the others what
        they held.  Large parts are split over tasks."""
        before = self.version()
        if number <= before.number:
            raise ValueError(f"version {number} of {self.folder} is not new")
        out = f"{self.folder}/data/version={number}"
        cut = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], self.part().alias("part"))
        cut.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(out)
        written = {int(n.removeprefix("part=")) for n in names(self.spark, out) if n.startswith("part=")}
        touched = set(touched)
        if not written <= touched:
            raise ValueError(f"rows outside the touched parts: {sorted(written - touched)}")
        parts = {k: v for k, v in before.parts.items() if k not in touched} | dict.fromkeys(written, number)
        held = {"n_parts": self.n_parts, "parts": parts, "note": note or {}}
        write_text(self.spark, f"{self.folder}/versions/{number:09d}.json", json.dumps(held))
        return Version(number, parts, note or {})

    def unused(self, keep: int = 2) -> list[str]:
        """Data folders that none of the `keep` latest versions reads."""
        files = [n for n in names(self.spark, f"{self.folder}/versions") if n.endswith(".json")][-keep:]
        used = {v for n in files for v in json.loads(read_text(self.spark, f"{self.folder}/versions/{n}"))["parts"].values()}
        data = [n for n in names(self.spark, f"{self.folder}/data") if n.startswith("version=")]
        return [f"{self.folder}/data/{n}" for n in data if int(n.removeprefix("version=")) not in used and exists(self.spark, f"{self.folder}/data/{n}")]
