"""A raw table that grows by batches: ids reserved once, every batch appended once.

A batch first reserves its range of ids in a commit of its own: the store's claim of the next
version decides between writers that started from the same state, and the loser reserves
after the winner. The rows are then written with these ids and appended in a second commit, which
may be retried as it stands, since no other batch can hold its ids. The manifest names every
batch, so a batch sent again finds its reservation (and its ids) or finds itself appended.
Ids of a batch that never came back stay unused.

The manifest has one entry per batch; :meth:`RawTable.fold` joins the appended ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import RAW, RAW_COLUMNS
from tidemark.sources.tables import prepare_append
from tidemark.sources.versions import Conflict, Staged, Store, Version

RAW_TABLE = "raw"
ORDER = ["city", "time", "temperature"]


class RawTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, Store(spark, root)

    def create(self) -> Version:
        """The empty table, unless it exists."""
        version = self.store.latest()
        if RAW_TABLE in version.tables:
            return version
        try:
            return self.store.commit([Staged(RAW_TABLE, RAW.json(), {})], version,
                                     {"next": 1, "reserved": {}, "folded": {}, **version.notes})
        except Conflict:
            return self.create()

    def reserve(self, batch: str, n: int) -> int:
        """The first of ``n`` ids for ``batch``; the same one if it has asked before."""
        while True:
            base = self.create()
            held = base.notes["reserved"].get(batch) or base.notes["folded"].get(batch)
            if held:
                if held[1] != n:
                    raise ValueError(f"batch {batch} had {held[1]} rows and now has {n}")
                return held[0]
            first = base.notes["next"]
            notes = {**base.notes, "next": first + n,
                     "reserved": {**base.notes["reserved"], batch: [first, n]}}
            try:
                self.store.commit([], base, notes)
                return first
            except Conflict:
                continue

    def append(self, batch: str, rows: DataFrame, is_forecast: bool | None = None,
               order_cols: list[str] = ORDER) -> Version:
        """Append rows without ids as ``batch``; a batch that is there already adds nothing."""
        version = self.create()
        if batch in version.parts(RAW_TABLE) or batch in version.notes["folded"]:
            return version
        # numbered from 1 once, in the shared folder, whatever range the batch will get
        numbered = prepare_append(rows, 0, order_cols, is_forecast)
        first = self.reserve(batch, numbered.count())
        placed = numbered.withColumn("id", F.col("id") + F.lit(first - 1).cast("long"))
        staged = self.store.stage(RAW_TABLE, placed.select(*RAW_COLUMNS))
        staged = Staged(RAW_TABLE, RAW.json(), {batch: staged.parts[""]}, False)
        while True:
            version = self.store.latest()
            if batch in version.parts(RAW_TABLE) or batch in version.notes["folded"]:
                return version
            try:
                return self.store.commit([staged], version, version.notes)
            except Conflict:
                continue

    def read(self, version: Version | None = None) -> DataFrame:
        self.create()
        return self.store.read(RAW_TABLE, version).select(*RAW_COLUMNS)

    def fold(self) -> Version:
        """Write the appended batches together; their names stay known as appended."""
        base = self.create()
        done = set(base.parts(RAW_TABLE))
        staged = self.store.stage(RAW_TABLE, self.read(base))
        reserved = base.notes["reserved"]
        notes = {**base.notes, "reserved": {b: r for b, r in reserved.items() if b not in done},
                 "folded": {**base.notes["folded"],
                            **{b: r for b, r in reserved.items() if b in done}}}
        return self.store.commit([Staged(RAW_TABLE, RAW.json(), {"": staged.parts[""]})], base, notes)
