"""Bronze, silver and gold as catalog databases."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from threading import Lock
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampType,
)

from callmeter.schemas import TABLES


# Versions that a table's view may consist of, and dates that are replaced in it at a time.
MOST_PIECES = 8
MOST_DATES = 1000
_OWN = "callmeter."
_PIECES = f"{_OWN}pieces"
_SCHEMAS = f"{_OWN}schemas"
# Number types from narrow to wide.
_NUMBERS = (ByteType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType())
# Spark's writers of one table must not overlap, and streams side by side may share one: a lock for each table of parts.
_WRITING: dict[str, Lock] = defaultdict(Lock)


class Piece(NamedTuple):
    """A stored version of a table, and the dates (ISO, or None) that it no longer gives."""

    version: int
    replaced: tuple[str | None, ...]


def _not_on(date_col: str, dates: Sequence[str | None]) -> str:
    """SQL for a date being none of ``dates``, which may hold None."""
    named = ", ".join(f"DATE'{d}'" for d in dates if d is not None)
    outside = f"coalesce({date_col} NOT IN ({named}), true)" if named else "true"
    return f"{outside} AND {date_col} IS NOT NULL" if None in dates else outside


def wider_type(name: str, a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both; an error where there is none."""
    if a == b:
        return a
    if a in _NUMBERS and b in _NUMBERS:
        wide = _NUMBERS[max(_NUMBERS.index(a), _NUMBERS.index(b))]
        # A float does not hold all ints.
        return DoubleType() if isinstance(wide, FloatType) and {a, b} & {IntegerType(), LongType()} else wide
    if {a, b} == {DateType(), TimestampType()}:
        return TimestampType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
    raise ValueError(f"{name}: {a.simpleString()} and {b.simpleString()} have no common type")


def merged_schema(old: StructType, new: StructType) -> StructType:
    """The columns of ``old`` and then those that only ``new`` has, types widened."""
    added = {f.name: f for f in new.fields}
    both = [StructField(f.name, wider_type(f.name, f.dataType, added[f.name].dataType) if f.name in added else f.dataType) for f in old.fields]
    return StructType([*both, *(StructField(f.name, f.dataType) for f in new.fields if f.name not in old.fieldNames())])


def under_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows of ``df`` with the columns and types of ``schema``, NULL where it lacks one."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def on_dates(date_col: str, dates: Sequence[date | None]) -> Column:
    """Whether a date is one of ``dates``, which may hold None."""
    listed = F.coalesce(F.col(date_col).isin([d for d in dates if d is not None]), F.lit(False))
    return listed | F.col(date_col).isNull() if None in dates else listed


@dataclass(frozen=True)
class Lake:
    """Tables by layer; ``prefix`` keeps several lakes apart in one catalog."""

    spark: SparkSession
    prefix: str = ""
    format: str = "parquet"
    # Versions of a table that stay stored, the current one among them; what its last view was made of always does.
    keep_versions: int = 2

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        if table not in TABLES[layer]:
            raise KeyError(f"{table} is no {layer} table")
        return f"{self.database(layer)}.{table}"

    def create(self) -> None:
        """Create the databases that are missing."""
        for layer in TABLES:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def load(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.table(self.name(layer, table))

    def load_if_exists(self, layer: str, table: str) -> DataFrame | None:
        return self.load(layer, table) if self.exists(layer, table) else None

    def materialize(
        self, df: DataFrame, layer: str, table: str, partition_by: str | None = None, merge_schema: bool = False
    ) -> DataFrame:
        """Replace a table by the rows of ``df``, which may come from it, and return the stored table.

        The rows are written as a new version, to which a view of the table's
        name is then switched: if the write fails, the old version stays. What
        the view consisted of before is kept for readers that have begun with
        it, older versions are dropped. A partitioned table is rebalanced by its
        partition column first: small partitions end up in one file each, a
        large one is split over tasks. With ``merge_schema`` the table keeps
        the columns it had, NULL where ``df`` lacks them, and types widen.
        """
        if merge_schema and self.exists(layer, table):
            df = under_schema(df, merged_schema(self.load(layer, table).schema, df.schema))
        if partition_by is not None:
            df = df.hint("rebalance", F.col(partition_by))
        number = self._write_version(df, layer, table, (partition_by,) if partition_by else ())
        self._switch(layer, table, [Piece(number, ())], f"SELECT * FROM {self.name(layer, table)}__{number}")
        return self.load(layer, table)

    def materialize_split(
        self, df: DataFrame, layer: str, table: str, refused_table: str, partition_by: str | None = None
    ) -> DataFrame:
        """Replace two tables by the rows of ``df`` in one write: those that are not ``refused`` and those that are.

        The first table shows its rows without the columns ``refused`` and
        ``failed_rules``. Returns all that was committed.
        """
        if partition_by is not None:
            df = df.hint("rebalance", F.col("refused"), F.col(partition_by))
        number = self._write_version(df, layer, table, ("refused", partition_by) if partition_by else ("refused",))
        stored = f"{self.name(layer, table)}__{number}"
        self.define(layer, refused_table, f"SELECT * EXCEPT (refused) FROM {stored} WHERE refused")
        self._switch(layer, table, [Piece(number, ())], f"SELECT * EXCEPT (refused, failed_rules) FROM {stored} WHERE NOT refused")
        return self.spark.read.table(stored)

    def _versions(self, layer: str, table: str) -> list[int]:
        """The numbers of the stored versions, a failed write's among them, in order."""
        listed = self.spark.catalog.listTables(self.database(layer), f"{table}__*")
        found = (t.name.rpartition("__")[2] for t in listed if t.name.startswith(f"{table}__"))
        return sorted(int(number) for number in found if number.isdigit())

    def _pieces(self, layer: str, table: str) -> list[Piece]:
        """What the view of a table consists of: its versions, and the dates that later ones replace."""
        name = self.name(layer, table)
        if not self.exists(layer, table) or self.spark.catalog.getTable(name).tableType != "VIEW":
            return []
        stored = self.properties(layer, table).get(_PIECES, "[]")
        return [Piece(n, tuple(replaced)) for n, replaced in json.loads(stored)]

    def _write_version(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()) -> int:
        number = max(self._versions(layer, table), default=0) + 1
        writer = df.write.mode("overwrite").format(self.format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(f"{self.name(layer, table)}__{number}")
        return number

    def _switch(self, layer: str, table: str, pieces: list[Piece], query: str) -> None:
        """Point the table's view to ``pieces``; drop the versions that neither it nor the view before is made of."""
        name = self.name(layer, table)
        before = self._pieces(layer, table)
        if self.exists(layer, table) and self.spark.catalog.getTable(name).tableType != "VIEW":
            # A table that was not written by this class, such as one that a stream appended to.
            self.spark.sql(f"DROP TABLE {name}")
        listed = json.dumps([[p.version, list(p.replaced)] for p in pieces])
        newest = pieces[-1].version
        history = [*self.schema_history(layer, table), (newest, self.spark.read.table(f"{name}__{newest}").schema)]
        told = json.dumps([[n, s.jsonValue()] for n, s in history])
        self.define(layer, table, query, {_PIECES: listed, _SCHEMAS: told})
        used = {p.version for p in [*pieces, *before]} | {n for n, _ in history[-self.keep_versions :]}
        for version in self._versions(layer, table):
            if version not in used:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}__{version}")

    def schema_history(self, layer: str, table: str) -> list[tuple[int, StructType]]:
        """The versions that a table has had, in order, each with the schema it was written under."""
        if not self.exists(layer, table) or self.spark.catalog.getTable(self.name(layer, table)).tableType != "VIEW":
            return []
        told = json.loads(self.properties(layer, table).get(_SCHEMAS, "[]"))
        return [(n, StructType.fromJson(s)) for n, s in told]

    def as_of(self, layer: str, table: str, version: int) -> DataFrame:
        """A version that is still stored, under the table's schema of today: later columns are NULL, types widened."""
        stored = self.spark.read.table(f"{self.name(layer, table)}__{version}")
        return under_schema(stored, merged_schema(self.load(layer, table).schema, stored.schema))

    def replace_dates(self, df: DataFrame, layer: str, table: str, date_col: str, dates: Sequence[date | None]) -> DataFrame:
        """Replace the rows of the given dates by ``df``, which holds these dates only; all other rows stay where they are.

        Only ``df`` is written. The table's view takes the replaced dates from
        the newest version that holds them; after ``MOST_PIECES`` such steps,
        or for many dates, the table is written as a whole.
        """
        pieces = self._pieces(layer, table)
        if not pieces or len(pieces) >= MOST_PIECES or len(dates) > MOST_DATES:
            rest = [self.load(layer, table).filter(~on_dates(date_col, dates))] if self.exists(layer, table) else []
            return self.materialize(reduce(DataFrame.unionByName, [*rest, df]), layer, table)
        listed = [None if d is None else d.isoformat() for d in dates]
        pieces = [Piece(p.version, tuple(dict.fromkeys([*p.replaced, *listed]))) for p in pieces]
        pieces.append(Piece(self._write_version(df, layer, table), ()))
        name = self.name(layer, table)
        columns = ", ".join(f"`{c}`" for c in self.spark.read.table(f"{name}__{pieces[0].version}").columns)
        parts = [f"SELECT {columns} FROM {name}__{p.version} WHERE {_not_on(date_col, p.replaced)}" for p in pieces]
        self._switch(layer, table, pieces, " UNION ALL ".join(parts))
        return self.load(layer, table)

    def write_part(
        self, df: DataFrame, layer: str, table: str, source: str, batch: int, view: str, split_by: Sequence[str] = ()
    ) -> None:
        """Store the rows of one batch of a source as a part of a table, in place of what that part held.

        Parts are partitions by source and batch, so a batch that is written
        twice counts once and other parts are not touched. ``split_by`` are
        further partition columns. The table's name becomes a view: ``view``
        is its query over ``{parts}``. Writes from one driver to one table wait
        for each other; several drivers must not write to the same one.
        """
        parts = f"{self.name(layer, table)}__parts"
        rows = f"part_{uuid.uuid4().hex}"
        split = "".join(f", {c}" for c in split_by)
        with _WRITING[parts]:
            self._create_parts(df, layer, table, view, split_by)
            columns = [c for c in self.spark.read.table(parts).columns if c not in ("source", "batch")]
            df.select(*columns).createOrReplaceTempView(rows)
            try:
                self.spark.sql(
                    f"INSERT OVERWRITE TABLE {parts} PARTITION (source = '{source}', batch = {int(batch)}{split}) SELECT * FROM {rows}"
                )
            finally:
                self.spark.catalog.dropTempView(rows)

    def _create_parts(self, df: DataFrame, layer: str, table: str, view: str, split_by: Sequence[str]) -> None:
        name = self.name(layer, table)
        if self.spark.catalog.tableExists(f"{name}__parts"):
            return
        marked = df.limit(0).withColumns({"source": F.lit("").cast("string"), "batch": F.lit(0).cast("long")})
        marked.write.format(self.format).partitionBy("source", "batch", *split_by).saveAsTable(f"{name}__parts")
        if self.exists(layer, table) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")
        self.define(layer, table, view.format(parts=f"{name}__parts"))

    def define(self, layer: str, table: str, query: str, properties: Mapping[str, str] | None = None) -> None:
        """Make a table a view of ``query``; its properties change with it, in one step."""
        # As hexadecimal digits: Spark shows no property whose text holds a word such as "token".
        listed = ", ".join(f"'{key}' = '{value.encode().hex()}'" for key, value in (properties or {}).items())
        told = f"TBLPROPERTIES ({listed}) " if listed else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} {told}AS {query}")

    def properties(self, layer: str, table: str) -> dict[str, str]:
        """The properties that ``define`` gave a table's view."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()
        return {r["key"]: bytes.fromhex(r["value"]).decode() for r in rows if r["key"].startswith(_OWN)}

    def parts(self, layer: str, table: str, source: str | None = None, batch: int | None = None) -> DataFrame:
        """The stored parts of a table, or those of one source or batch, with the columns ``source`` and ``batch``."""
        found = self.spark.read.table(f"{self.name(layer, table)}__parts")
        if source is not None:
            found = found.filter(F.col("source") == source)
        return found if batch is None else found.filter(F.col("batch") == batch)

    def last_batch(self, layer: str, table: str, source: str) -> int | None:
        """The greatest batch number of a source among a table's parts, empty parts left aside."""
        parts = f"{self.name(layer, table)}__parts"
        if not self.spark.catalog.tableExists(parts):
            return None
        return self.parts(layer, table, source).agg(F.max("batch")).first()[0]

    def layer_tables(self) -> DataFrame:
        """The stored tables (layer, table_name)."""
        found = [
            (layer, t.name)
            for layer in TABLES
            if self.spark.catalog.databaseExists(self.database(layer))
            for t in self.spark.catalog.listTables(self.database(layer))
            if not t.isTemporary and "__" not in t.name
        ]
        return self.spark.createDataFrame(found, "layer string, table_name string")
