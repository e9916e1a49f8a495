"""A table of directories that a commit record names.

``root/data`` holds directories of Parquet files that are written once and
never changed; ``root/commits/<version>`` names those that are the table. A
version is published by renaming a finished file to its number, which fails
when that number is taken, so writers never overwrite each other: the loser
reads the newer record and applies its change again, or gives up if what it
was to replace is gone.

A reader takes the newest record once and reads the directories it names.
Landing a batch adds one; folding replaces many by one, while streams write
and readers read: those that began before the switch still find their
directories, which ``vacuum`` removes only when they are old enough.

A batch is committed with its id in the same record, folded or not, so a
batch that a stream replays after a failure is known and left out; one that
failed between its write and its commit is simply written again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.schema import PARTITION_COLUMNS, STORED
from meterlake.sinks.files import write_parquet
from meterlake.streaming.ingest import with_trigger


#: Level of the path that names a directory of the table.
_DIRECTORY = "_directory"


class Conflict(RuntimeError):
    """Another writer has replaced what this one was to replace."""


@dataclass(frozen=True)
class Record:
    """One version: the live directories, how far each stream's batches are
    in the table, which directories have left it (with the time), and what
    each stream noted with its last batch."""

    version: int = 0
    live: tuple[str, ...] = ()
    landed: dict[str, int] = field(default_factory=dict)
    left: dict[str, float] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = STORED, partition_by: Sequence[str] = PARTITION_COLUMNS):
        self.spark, self.root, self.schema, self.partition_by = spark, root.rstrip("/"), schema, list(partition_by)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.root).getFileSystem(self._conf)
        self._files.mkdirs(self._path(f"{self.root}/commits"))
        self._files.mkdirs(self._path(f"{self.root}/data"))

    # --- records ---------------------------------------------------------------

    def versions(self) -> list[int]:
        names = [f.getPath().getName() for f in self._files.listStatus(self._path(f"{self.root}/commits"))]
        return sorted(int(n) for n in names if n.isdigit())

    def record(self, version: int | None = None) -> Record:
        """A version's record, the newest by default; version 0 is empty."""
        found = version if version is not None else max(self.versions(), default=0)
        if not found:
            return Record()
        stream = self._files.open(self._path(f"{self.root}/commits/{found:012d}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        raw = json.loads(text)
        return Record(found, tuple(raw["live"]), raw["landed"], raw["left"], raw.get("notes", {}))

    def _publish(self, record: Record) -> bool:
        """Make ``record`` its version, or return False if that is taken."""
        jvm = self.spark.sparkContext._jvm
        own = self._path(f"{self.root}/commits/.{uuid.uuid4().hex}")
        out = self._files.create(own, False)
        try:
            out.write(bytearray(json.dumps({"live": record.live, "landed": record.landed, "left": record.left, "notes": record.notes}).encode()))
        finally:
            out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # fails if the target exists
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), self._conf).rename(own, self._path(f"{self.root}/commits/{record.version:012d}"), options)
        except Exception as error:
            self._files.delete(own, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def commit(self, change: Callable[[Record], Record | None]) -> Record:
        """Publish what ``change`` makes of the newest record, again and again
        until no other writer was faster; None: there is nothing to do."""
        while True:
            now = self.record()
            new = change(now)
            if new is None:
                return now
            new = replace(new, version=now.version + 1)
            if self._publish(new):
                return new

    # --- reading ---------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The table as it is now, or as it was at ``version``: one relation
        over its directories, so partition filters prune in all of them. A
        frame keeps its directories whatever is committed later."""
        live = self.record(version).live
        if not live:
            return self.spark.createDataFrame([], self.schema)
        base = f"{self.root}/data"
        schema = T.StructType([*self.schema.fields, T.StructField(_DIRECTORY, T.StringType())])
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{d}" for d in live])
        return rows.select(*self.schema.names)

    # --- writing ---------------------------------------------------------------

    def land(self, batch: DataFrame, batch_id: int, stream: str = "stream", note: str | None = None) -> bool:
        """Write one micro-batch and commit it, with a short ``note`` that the
        stream needs for its next one; False if it is there already."""
        if batch_id <= self.record().landed.get(stream, -1):
            return False
        name = f"{_DIRECTORY}={stream}-{batch_id}-{uuid.uuid4().hex[:8]}"
        write_parquet(batch.select(*self.schema.names), f"{self.root}/data/{name}", partition_by=self.partition_by)

        def add(now: Record) -> Record | None:
            if batch_id <= now.landed.get(stream, -1):
                return None  # another attempt was faster; this one's directory is no part of the table
            notes = now.notes if note is None else {**now.notes, stream: note}
            return replace(now, live=(*now.live, name), landed={**now.landed, stream: batch_id}, notes=notes)

        return name in self.commit(add).live

    def fold(self, merge: Callable[[DataFrame], DataFrame] | None = None, sort_by: Sequence[str] = ()) -> Record:
        """Replace all directories of the newest version by one that holds the
        same rows, or what ``merge`` makes of them (mergeable partials), in a
        few large files a partition. Batches that land meanwhile stay."""
        before = self.record()
        if len(before.live) < 2:
            return before
        rows = self.read(before.version)
        name = f"{_DIRECTORY}=fold-{uuid.uuid4().hex}"
        write_parquet((merge(rows) if merge else rows).select(*self.schema.names), f"{self.root}/data/{name}", partition_by=self.partition_by, sort_by=sort_by)
        gone = set(before.live)

        def switch(now: Record) -> Record:
            if not gone <= set(now.live):
                raise Conflict(f"directories of version {before.version} have been replaced by another fold")
            when = time.time()
            return replace(now, live=(name, *(d for d in now.live if d not in gone)), left={**now.left, **dict.fromkeys(gone, when)})

        return self.commit(switch)

    def vacuum(self, keep_seconds: float) -> list[str]:
        """Delete directories that left the table longer ago than that, and
        those of that age that never were part of it (failed writes)."""
        now, cutoff = self.record(), time.time() - keep_seconds
        status = {f.getPath().getName(): f.getModificationTime() / 1000 for f in self._files.listStatus(self._path(f"{self.root}/data"))}
        old = [d for d, made in status.items() if d not in now.live and now.left.get(d, made) <= cutoff]
        for d in old:
            self._files.delete(self._path(f"{self.root}/data/{d}"), True)
        if set(old) & set(now.left):
            self.commit(lambda r: replace(r, left={d: t for d, t in r.left.items() if d not in old}))
        return sorted(old)


def start_landing(
    table: SnapshotTable,
    rows: DataFrame,
    checkpoint: str,
    trigger: dict | None = None,
    stream: str = "stream",
    of: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Stream rows, or what ``of`` makes of each batch (mergeable partials),
    into ``table``: a directory and a version a batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        table.land(of(batch) if of else batch, batch_id, stream)

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()
