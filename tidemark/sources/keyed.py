"""A table keyed by columns, changed by small commits: merge on read over hash buckets.

Rows are dealt to buckets by the hash of their key. A change writes only its own rows, as
delta files of the buckets they fall into; nothing else is read or rewritten. A reader takes
buckets without deltas as they are and merges the others, so the shuffle of a read is limited
to changed buckets. :meth:`KeyedTable.compact` folds the deltas of buckets that have
collected several into new base files. Every change is one commit of the store
(``sources.versions``).

The rules are those of ``sources.tables``: an upsert replaces or adds, an insert keeps the row
that is there, a NULL in a key equals nothing (such rows are added and share a bucket).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import _first_of_key
from tidemark.sources.versions import Conflict, Staged, Store, Version

ROWS, DELTA = "rows", "delta"
BUCKETS = 16
NO_KEY = "nokey"
PUT, ADD, DELETE = "put", "add", "delete"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = BUCKETS):
        self.store, self.keys, self.buckets = Store(spark, root), list(keys), buckets

    def bucket(self) -> Column:
        """Name of the bucket of a row."""
        number = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        return F.when(self._keyed(), F.lpad(number.cast("string"), 5, "0")).otherwise(NO_KEY)

    def _keyed(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    # -- changes ------------------------------------------------------------------

    def create(self, df: DataFrame) -> Version:
        """Make ``df`` the table, in place of what was there."""
        staged = self.store.stage(ROWS, df, self.bucket())
        empty = Staged(DELTA, self._delta(df.limit(0), PUT, 0).schema.json(), {})
        return self.store.publish([staged, empty])

    def upsert(self, incoming: DataFrame, order_by: list | None = None) -> Version:
        """Rows of ``incoming`` replace rows with their key; others are added."""
        order = order_by or [F.col(c).desc_nulls_last() for c in incoming.columns]
        return self._change(_first_of_key(incoming, self.keys, order), PUT)

    def insert_if_absent(self, incoming: DataFrame, order_by: list | None = None) -> Version:
        """Rows of ``incoming`` whose key the table doesn't hold are added."""
        order = order_by or [F.col(c).asc_nulls_last() for c in incoming.columns]
        return self._change(_first_of_key(incoming, self.keys, order), ADD)

    def delete_keys(self, doomed: DataFrame) -> Version:
        """Rows whose key is in ``doomed`` go."""
        version = self.store.latest()
        columns = self.store.read(ROWS, version).schema
        rows = doomed.select(*self.keys).where(self._keyed()).distinct()
        full = rows.select(*[F.col(f.name) if f.name in self.keys
                             else F.lit(None).cast(f.dataType).alias(f.name) for f in columns])
        return self._change(full, DELETE)

    def delete_where(self, column: str, value) -> Version:
        """``DELETE .. WHERE column = value``; rows with NULL in ``column`` stay.

        Keyed rows go by their keys; the bucket of rows without a key, which can't be named,
        is written anew if it holds such rows.
        """
        hit = F.col(column).eqNullSafe(F.lit(value))
        version = self.delete_keys(self.read().where(hit))
        loose = self.read(version, {NO_KEY})
        if loose is None or loose.where(hit).isEmpty():
            return version
        staged = self.store.stage(ROWS, loose.where(~hit), self.bucket(), {NO_KEY})
        return self.store.commit([staged, self._without_deltas(version, {NO_KEY})], version)

    def _delta(self, df: DataFrame, op: str, seq: int) -> DataFrame:
        return df.withColumn("_op", F.lit(op)).withColumn("_seq", F.lit(seq).cast("long"))

    def _change(self, df: DataFrame, op: str) -> Version:
        while True:
            base = self.store.latest()
            seq = base.number + 1
            name = F.concat(self.bucket(), F.lit(f"-{seq:020d}"))
            schema = self.store.read(ROWS, base).columns
            staged = self.store.stage(DELTA, self._delta(df.select(*schema), op, seq), name, set())
            try:
                return self.store.commit([staged], base)
            except Conflict:  # the order of changes is that of their versions: written again
                continue

    # -- reading --------------------------------------------------------------------

    @staticmethod
    def deltas(version: Version) -> dict[str, list[str]]:
        """Delta parts of every changed bucket."""
        out: dict[str, list[str]] = {}
        for part in sorted(version.parts(DELTA)):
            out.setdefault(part.split("-")[0], []).append(part)
        return out

    def read(self, version: Version | None = None, only: set[str] | None = None) -> DataFrame | None:
        """Rows of a version (default: the newest), of the buckets in ``only`` if given."""
        version = version or self.store.latest()
        base = self.store.read(ROWS, version, only)
        if base is None:
            return None
        changed = {b: parts for b, parts in self.deltas(version).items()
                   if only is None or b in only}
        if not changed:
            return base
        every = set(version.parts(ROWS)) if only is None else only
        clean = self.store.read(ROWS, version, every - set(changed))
        old = self._delta(self.store.read(ROWS, version, set(changed)), PUT, 0)
        new = self.store.read(DELTA, version, {p for parts in changed.values() for p in parts})
        return clean.unionByName(self._merged(old.unionByName(new)).select(*base.columns))

    def _merged(self, rows: DataFrame) -> DataFrame:
        """The row that every key ends with: its last put, or the first insert after its last
        delete. A key has one row per change at most."""
        key = Window.partitionBy(*self.keys)
        last = F.coalesce(F.max(F.when(F.col("_op") != ADD, F.col("_seq"))).over(key), F.lit(-1))
        keyed = rows.where(self._keyed()).withColumn("_last", last)
        live = keyed.where("_seq >= _last").withColumn("_n", F.row_number().over(
            key.orderBy("_seq"))).withColumn("_from", F.first("_op").over(key.orderBy("_seq")))
        # An insert-only key starts with its insert; a deleted one continues with the next insert.
        kept = live.where(((F.col("_from") != DELETE) & (F.col("_n") == 1))
                          | ((F.col("_from") == DELETE) & (F.col("_n") == 2)))
        loose = rows.where(~self._keyed() & (F.col("_op") != DELETE))
        return kept.drop("_last", "_n", "_from").unionByName(loose)

    # -- compaction -------------------------------------------------------------------

    def _without_deltas(self, version: Version, buckets: set[str]) -> Staged:
        gone = [p for b, parts in self.deltas(version).items() if b in buckets for p in parts]
        return Staged(DELTA, version.tables[DELTA]["schema"], {}, False, tuple(gone))

    def compact(self, least: int = 4) -> Version:
        """Fold the deltas of buckets that have ``least`` or more into base files."""
        version = self.store.latest()
        full = {b for b, parts in self.deltas(version).items() if len(parts) >= least}
        if not full:
            return version
        staged = self.store.stage(ROWS, self.read(version, full), self.bucket(), full)
        return self.store.commit([staged, self._without_deltas(version, full)], version)
