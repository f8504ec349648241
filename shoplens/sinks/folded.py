"""Counter tables of the stream guard: increments a batch, folded part by part.

A row belongs to a part (a day for the counters).  Each micro-batch adds one folder
of increments to the parts it touches:

    <path>/part=<value>/inc-<batch>     the batch's own rows
    <path>/part=<value>/full-<batch>    all rows up to that batch, merged
    <path>/done/<batch>                 the batch is whole

A batch reads the parts it touches only, and of each the newest ``full`` folder and
the increments after it.  After ``fold_every`` increments a part is merged into a new
``full`` folder, so what a batch reads depends on the keys of its parts, not on how
many batches or parts there were before.  ``expire`` drops whole parts.

Folders are written aside and renamed into place.  A batch that is replayed finds its
increments and leaves them; it reads ``before`` itself, i.e. no folder that it or a
later batch wrote.  Folding keeps the last two generations, for such a replay and for
readers that have listed the older one.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.sinks.appended import file_system

ALL = "all"         # the only part of a table without parts
REST = "rest"       # the part of rows whose part is not asked for by name


class FoldedTable:
    """``merge`` brings rows of the schema to one a key; ``part`` is the column whose values are parts."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 part: str | None = None, fold_every: int = 8, max_files: int | None = None):
        self.spark, self.path, self.merge, self.part = spark, path.rstrip("/"), merge, part
        self.schema = T.StructType.fromDDL(schema)
        self.fold_every, self.max_files = int(fold_every), max_files
        self._fs, self._Path = file_system(spark, self.path)

    # -- folders --------------------------------------------------------------------
    def _names(self, path: str) -> list[str]:
        p = self._Path(path)
        return [st.getPath().getName() for st in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _part_path(self, part: str) -> str:
        return f"{self.path}/part={quote(part, safe='')}"

    def parts(self) -> list[str]:
        """The stored parts, as folder values."""
        return sorted(n[5:] for n in self._names(self.path) if n.startswith("part="))

    def _folders(self, place: str, before: int | None) -> list[tuple[int, str]]:
        found = [(int(n.split("-")[1]), n.split("-")[0]) for n in self._names(place) if n.startswith(("inc-", "full-"))]
        return sorted(x for x in found if before is None or x[0] < before)

    def _current(self, place: str, before: int | None) -> list[tuple[int, str]]:
        """The newest full folder and the increments after it."""
        found = self._folders(place, before)
        base = max((b for b, kind in found if kind == "full"), default=None)
        return [(b, kind) for b, kind in found if base is None or (b == base and kind == "full") or (b > base and kind == "inc")]

    def paths(self, parts: list[str] | None = None, before: int | None = None) -> list[str]:
        """The folders that a read of these parts (all by default) takes."""
        places = [f"{self.path}/part={p}" for p in self.parts()] if parts is None else [self._part_path(p) for p in parts]
        return [f"{place}/{kind}-{b}" for place in places for b, kind in self._current(place, before)]

    def size(self, paths: list[str]) -> int:
        """Bytes under these folders."""
        return sum(self._fs.getContentSummary(self._Path(p)).getLength() for p in paths)

    # -- reading ----------------------------------------------------------------------
    def read(self, parts: list[str] | None = None, before: int | None = None) -> DataFrame:
        """One row a key, from batches ``< before`` only if given."""
        paths = self.paths(parts, before)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.merge(self.spark.read.schema(self.schema).parquet(*paths))

    def stored_rows(self, parts: list[str] | None = None, before: int | None = None) -> int:
        """Rows in the folders of such a read, a bound on the keys it returns; no column is read."""
        paths = self.paths(parts, before)
        return self.spark.read.schema(self.schema).parquet(*paths).count() if paths else 0

    def has(self, batch_id: int) -> bool:
        return any(int(n) >= int(batch_id) for n in self._names(f"{self.path}/done"))

    # -- writing ----------------------------------------------------------------------
    def _move(self, aside: str, place: str, name: str) -> None:
        self._fs.mkdirs(self._Path(place))
        if not self._fs.rename(self._Path(aside), self._Path(f"{place}/{name}")):
            raise OSError(f"could not move {aside} into place")

    def _rows(self, df: DataFrame, *more: Column) -> DataFrame:
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], *more)
        return rows.coalesce(self.max_files) if self.max_files else rows

    def append(self, df: DataFrame, batch_id: int, parts: list[str] | None = None) -> bool:
        """Add a batch's rows; False when the batch is there already.

        ``parts`` names the parts of the batch; rows of any other value go to the
        part ``REST``, which a reader of parts asks for as well.
        """
        if self.has(batch_id):
            return False
        name = f"inc-{int(batch_id)}"
        if self.part is None:
            value = F.lit(ALL)
        else:
            named = F.col(self.part).isin(parts or [])
            value = F.when(named, F.col(self.part)).otherwise(REST)
        aside = f"{self.path}.aside/{name}"
        self._rows(df, value.alias("_part")).write.mode("overwrite").partitionBy("_part").parquet(aside)
        touched = [n[6:] for n in self._names(aside) if n.startswith("_part=")]
        for part in touched:
            place = f"{self.path}/part={part}"
            if not self._fs.exists(self._Path(f"{place}/{name}")):
                self._move(f"{aside}/_part={part}", place, name)
        for part in touched:
            self._fold(f"{self.path}/part={part}", int(batch_id))
        self._fs.mkdirs(self._Path(f"{self.path}/done/{int(batch_id)}"))
        for n in self._names(f"{self.path}/done"):
            if int(n) < int(batch_id):
                self._fs.delete(self._Path(f"{self.path}/done/{n}"), True)
        self._fs.delete(self._Path(aside), True)
        return True

    def _fold(self, place: str, batch_id: int, least: int | None = None) -> None:
        current = self._current(place, batch_id + 1)
        if sum(kind == "inc" for _, kind in current) < (self.fold_every if least is None else least):
            return
        rows = self.spark.read.schema(self.schema).parquet(*[f"{place}/{kind}-{b}" for b, kind in current])
        aside = f"{self.path}.aside/full-{batch_id}"
        self._rows(self.merge(rows)).write.mode("overwrite").parquet(aside)
        self._move(aside, place, f"full-{batch_id}")
        before = [b for b, kind in current if kind == "full"]
        for b, kind in self._folders(place, before[0] if before else -1):
            self._fs.delete(self._Path(f"{place}/{kind}-{b}"), True)

    def compact(self) -> None:
        """Fold every part now; to be run between streams."""
        for part in self.parts():
            place = f"{self.path}/part={part}"
            found = self._folders(place, None)
            if found and found[-1][1] == "inc":
                self._fold(place, found[-1][0], least=2)

    def expire(self, before: str) -> list[str]:
        """Drop the parts whose value sorts below ``before`` (days as yyyy-MM-dd); returns them."""
        old = [p for p in self.parts() if p not in (ALL, REST) and p < before]
        for p in old:
            self._fs.delete(self._Path(f"{self.path}/part={p}"), True)
        return old
