"""The stored chunks: a catalogue table that only ever grows by whole batches.

Every upsert appends its records, folded to one per key, as files of a new version; no
stored file is touched, so a batch writes in proportion to itself, a failed one leaves
nothing that changes an answer, and readers never meet a missing part. Reading resolves
keys that newer versions hold; ``compact`` writes the resolved rows as the version that
reading starts from, apart from ingestion. A record that was appended twice, or is found
beside the compacted copy of itself, resolves to the same row.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.functions.vectors import require_searchable
from passagework.operators.merge import fold_batch, fold_single
from passagework.schemas import CHUNK_SCHEMA
from passagework.session import staged, written

VERSION, CARRIED = "_version", "_carried"
_OWN = (VERSION, CARRIED)
#: Records for each repeated key from which on the repeated ones are treated apart.
_FEW = 10


def _last(column: str) -> Column:
    """The value of the newest record that carried the column, NULL values included."""
    told = F.when(F.array_contains(CARRIED, column), F.col(VERSION))
    return F.max_by(F.struct(F.col(column).alias("v")), told)["v"].alias(column)


def _merged_maps(column: str) -> Column:
    """Maps of all records, newer values winning; a key has a record per version since compaction."""
    told = F.when(F.array_contains(CARRIED, column) & F.col(column).isNotNull(), F.struct(VERSION, F.col(column).alias("m")))
    by_version = F.array_sort(
        F.collect_list(told),
        lambda a, b: F.when(a[VERSION] < b[VERSION], -1).when(a[VERSION] > b[VERSION], 1).otherwise(0),
    )
    ordered = F.transform(by_version, lambda x: x["m"])
    merged = F.aggregate(
        ordered,
        F.create_map().cast("map<string,string>"),
        lambda done, m: F.map_concat(F.map_filter(done, lambda k, _: ~F.map_contains_key(m, k)), m),
    )
    return F.when(F.count(told) > 0, merged).alias(column)


def _apart(rows: DataFrame, repeated: DataFrame, records: int, alone, together) -> DataFrame:
    """``together`` of the rows whose ``chunk_id`` is in ``repeated``, ``alone`` of all others.

    ``repeated`` is stored, so its size is known when the plan is made: as long as it is small,
    only its rows are shuffled. Where many keys repeat, all rows go one way.
    """
    many = repeated.count()
    if not many:
        return alone(rows)
    if many * _FEW > records:
        return together(rows)
    same = F.col("chunk_id").eqNullSafe(F.col("_again"))
    return alone(rows.join(repeated, same, "left_anti")).unionByName(together(rows.join(repeated, same, "left_semi")))


def _counted(counted: Observation) -> int:
    """``n`` of an observed write; a batch that is known to be empty is planned without its counter."""
    return counted.get["n"] if counted._jo.getRow().length() else 0


class ChunkTable:
    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.name = name

    def ensure(self, dim: int, location: str | None = None) -> bool:
        """Create the table if it is missing; True only when this call created it.

        A table of another width is refused.
        """
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CHUNK_SCHEMA)
        place = f" LOCATION '{location}'" if location else ""
        created = False
        if not self.spark.catalog.tableExists(self.name):
            try:
                self.spark.sql(
                    f"CREATE TABLE {self.name} ({columns}, {CARRIED} ARRAY<STRING>, {VERSION} BIGINT) USING parquet "
                    f"PARTITIONED BY ({VERSION}){place} TBLPROPERTIES ('chunks.dim'='{dim}', 'chunks.base'='0')"
                )
                created = True
            except AnalysisException as error:
                if error.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                    raise
        if self.dim != dim:
            raise ValueError(f"{self.name} holds vectors of width {self.dim}, not {dim}")
        return created

    def _property(self, key: str) -> int:
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('{key}')").first()
        return int(found["value"])

    @property
    def dim(self) -> int:
        return self._property("chunks.dim")

    def read(self) -> DataFrame:
        """One row per key, as all upserts leave it."""
        rows, base = self.spark.table(self.name), self._property("chunks.base")
        columns = [c for c in rows.columns if c not in _OWN]
        newer = rows.where(F.col(VERSION) > base)
        if base and newer.isEmpty():
            return rows.where(F.col(VERSION) == base).select(columns)
        maps = [c for c in columns if isinstance(rows.schema[c].dataType, T.MapType)]
        values = [_merged_maps(c) if c in maps else _last(c) for c in columns if c != "chunk_id"]

        def resolved(records: DataFrame) -> DataFrame:
            return records.groupBy("chunk_id").agg(*values).select(columns)

        if not base:
            # what is told now of the keys holds for these versions
            seen = [row[0] for row in newer.select(VERSION).distinct().collect()]  # one row per upsert
            known = newer.where(F.col(VERSION).isin(seen))
            again = known.groupBy(F.col("chunk_id").alias("_again")).count().where("count > 1").select("_again")
            return _apart(known, written(again, "again"), known.count(), lambda r: r.select(columns), resolved)
        # only keys that newer versions hold are put together anew
        stored = rows.where(F.col(VERSION) == base)
        changed = newer.select(F.col("chunk_id").alias("_key")).distinct()
        same = F.col("chunk_id") == F.col("_key")
        touched = newer.unionByName(stored.join(changed, same, "left_semi"))
        return (
            stored.join(changed, same, "left_anti")
            .select(columns)
            .unionByName(resolved(touched))
        )

    def _add_columns(self, batch: DataFrame) -> None:
        """Columns of another writer join the table the first time they appear."""
        known = self.spark.table(self.name).columns
        added = [f for f in batch.schema if f.name not in known]
        if added:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({columns})")

    def _append(self, rows: DataFrame, version: int) -> None:
        carried = F.array(*(F.lit(c) for c in rows.columns))
        target = self.spark.table(self.name)
        missing = [
            F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema if f.name not in (*rows.columns, *_OWN)
        ]
        full = rows.select("*", *missing, carried.alias(CARRIED), F.lit(version).alias(VERSION))
        full.select(target.columns).hint("rebalance").sortWithinPartitions("tenant", "chunk_id").write.insertInto(self.name)

    def _next_version(self) -> int:
        """Later than all before it; the clock orders writers that don't see each other."""
        last = self.spark.table(self.name).agg(F.max(VERSION)).first()[0]
        return max((last or 0) + 1, time.time_ns() // 1000)

    def upsert(self, chunks: DataFrame, seq: str = "seq", distinct: bool = False) -> int:
        """Upsert by ``chunk_id`` and return the number of records received.

        ``chunks`` carries the key, ``tenant``, an ``embedding`` and any further columns; ``seq``
        orders records of one key. A missing or misshapen vector fails the call before
        anything is appended. The same batch may be replayed: it leads to the same rows.
        ``distinct`` says that no key comes twice or is NULL: records are then appended as they come.
        """
        vector = require_searchable(F.col("embedding"), self.dim, F.col("chunk_id"))
        counted = Observation("received")
        checked = chunks.withColumn("embedding", vector).observe(counted, F.count(F.lit(1)).alias("n"))
        if distinct:
            self._add_columns(checked.drop(seq))
            # a failed write leaves no file: its tasks' files are moved into the table when all are done
            self._append(fold_single(checked, seq), self._next_version())
            return _counted(counted)
        # computed once: the plan below reads the batch more than once; counted as it is written
        with staged(checked) as batch:
            received = _counted(counted)
            if received:
                self._add_columns(batch.drop(seq))
                keys = batch.groupBy(F.col("chunk_id").alias("_again")).agg(F.count(F.lit(1)).alias("n"), F.count(seq).alias("told"))
                again = keys.where("n > 1 OR told < n OR _again IS NULL").select("_again")
                with staged(again) as repeated:
                    folded = _apart(
                        batch, repeated, received, lambda r: fold_single(r, seq), lambda r: fold_batch(r, "chunk_id", seq)
                    )
                    self._append(folded, self._next_version())
        return received

    def compact(self) -> None:
        """Write the resolved rows as the version that reading starts from.

        Runs beside ingestion: what is appended meanwhile is newer than what was read. Older
        files stay until ``drop_old``, so that running readers finish.
        """
        rows = self.spark.table(self.name)
        last = rows.agg(F.max(VERSION)).first()[0]
        if last is None or last == self._property("chunks.base"):
            return
        resolved = self.read()
        # in the place of the last version it has read: newer ones stay newer
        with staged(resolved) as done:
            self._append(done, last + 1)
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('chunks.base'='{last + 1}')")

    def drop_old(self) -> None:
        """Remove versions that reading no longer starts from."""
        base = self._property("chunks.base")
        old = self.spark.table(self.name).select(VERSION).distinct().where(F.col(VERSION) < base).collect()
        for row in old:  # one row per upsert since the last time
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({VERSION}={row[0]})")


def with_metadata(chunks: DataFrame, key: str, value: str) -> DataFrame:
    """Chunks whose metadata holds ``value`` under ``key``."""
    return chunks.where(F.try_element_at(F.col("metadata"), F.lit(key)) == F.lit(value))
