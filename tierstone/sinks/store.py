"""The layer tables as catalog tables over Parquet files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS, LAYERS, Contract
from tierstone.operators.conform import conform
from tierstone.operators.latest import upsert
from tierstone.scratch import new_folder


#: Writes what it is given a builder of, and returns it as read from there.
Staged = Callable[[Callable[[], DataFrame]], DataFrame]


def create_statement(contract: Contract, target: str) -> str:
    columns = [f"`{name}` {kind.simpleString().upper()}" for name, kind in contract.fields]
    layout = ""
    if contract.partitioning:
        part = contract.partitioning
        columns.append(f"`{part.column}` {part.sql_type}")
        layout = f" PARTITIONED BY (`{part.column}`)"
    return (
        f"CREATE TABLE IF NOT EXISTS {target} ({', '.join(columns)}) USING parquet"
        f"{layout} COMMENT '{contract.comment}'"
    )


def _one_of(column: str, values: list) -> Column:
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def _equal(one: DataFrame, keys: DataFrame) -> Column:
    """Equality of all columns of `keys`, NULL being equal to NULL."""
    return reduce(Column.__and__, [one[c].eqNullSafe(keys[c]) for c in keys.columns])


class LayerStore:
    """Reads and writes layer tables by their two-level name, such as `silver.users`.

    `prefix` is put before the namespaces, so that several stores can share one
    catalog.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def namespace(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table(self, name: str) -> str:
        contract = CONTRACTS[name]
        return f"{self.namespace(contract.layer)}.{contract.table}"

    def create(self, *names: str) -> LayerStore:
        """Create the named tables (all, if none is named) and their namespaces, if absent."""
        wanted = {CONTRACTS[name].layer for name in names} or set(LAYERS)
        for layer in (x for x in LAYERS if x in wanted):
            self.create_namespace(layer)
        for name in names or CONTRACTS:
            self.spark.sql(create_statement(CONTRACTS[name], self.table(name)))
        return self

    def create_namespace(self, layer: str) -> LayerStore:
        where = f"{self.root}/{self.namespace(layer)}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace(layer)} LOCATION '{where}'")
        return self

    def location(self, name: str) -> str:
        """The folder of a table's files."""
        described = self.layout(name).where("col_name = 'Location'")
        return described.first()["data_type"]

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")

    def overwrite(self, df: DataFrame, name: str) -> int:
        """Replace the whole table; returns the rows now stored.

        Rows are regrouped by folder value before writing, which keeps one task
        from opening a file in every folder; a folder with far more rows than
        others is split over several tasks.

        The plan runs once: the count reads the footers of what was stored, and
        so also holds when tasks were retried.
        """
        self._laid_out(df, name).write.insertInto(self.table(name), overwrite=True)
        return self.stored_rows(name)

    def _laid_out(self, df: DataFrame, name: str) -> DataFrame:
        contract = CONTRACTS[name]
        rows, part = conform(df, contract), contract.partitioning
        if not part:
            return rows
        return rows.withColumn(part.column, part.expression()).hint("rebalance", part.column)

    def upsert(
        self, incoming: DataFrame, name: str, keys: Sequence[str], newest_by: Sequence[str]
    ) -> int:
        """Apply a delivery to the stored table; returns the rows now stored.

        Folders that hold a key of the delivery, or get one of its rows, are read and
        written again; the others keep their files. The new content is first written to
        the shared folder: a stage that dies before the table is touched leaves the table
        as it was, and one that dies later can be run again. A table without folders is
        rewritten as a whole.
        """
        contract = CONTRACTS[name]
        delivery = f"{new_folder(self.spark, 'delivery')}/rows"
        conform(incoming, contract).write.parquet(delivery)
        delivered = self.spark.read.schema(contract.schema).parquet(delivery)
        self._rewrite(
            name, delivered, delivered.select(*keys), lambda current: upsert(current, delivered, keys, newest_by), self._scratch
        )
        return self.stored_rows(name)

    def replace(
        self, rows: DataFrame, name: str, among: DataFrame | None = None, staged: Staged | None = None
    ) -> None:
        """Put `rows` in the place of the stored rows whose keys are `among`; without
        `among` they are added. NULL keys are equal. Only folders that lose or get rows are
        written again. With `staged` of a ledger a run that died is continued from the new
        content it had staged, which makes the addition of rows repeatable.
        """
        rows = conform(rows, CONTRACTS[name])

        def merge(current: DataFrame) -> DataFrame:
            kept = current if among is None else current.join(among, _equal(current, among), "left_anti")
            return kept.unionByName(rows)

        self._rewrite(name, rows, among, merge, staged or self._scratch)

    def refill(self, rows: DataFrame, name: str, values: Sequence) -> None:
        """Replace whole folders, given by their values, by these rows, which belong there."""
        part, table = CONTRACTS[name].partitioning, self.table(name)
        staged = self._scratch(lambda: self._laid_out(rows, name)).select(*self.spark.table(table).columns)
        self._publish(staged, table, part.column, values)

    def _scratch(self, build: Callable[[], DataFrame]) -> DataFrame:
        folder = f"{new_folder(self.spark, 'upsert')}/rows"
        build().write.parquet(folder)
        return self.spark.read.parquet(folder)

    def _rewrite(
        self, name: str, new: DataFrame, keys: DataFrame | None, merge: Callable[[DataFrame], DataFrame], staged: Staged
    ) -> None:
        """Write the folders again that hold one of the keys or get one of the new rows."""
        contract = CONTRACTS[name]
        part, table = contract.partitioning, self.table(name)
        current = self.spark.table(table)
        if part:
            folders = new.select(part.expression().alias(part.column))
            if keys is not None:
                named = current.join(keys, _equal(current, keys), "left_semi")
                folders = folders.unionByName(named.select(part.column))
            # One value per folder touched, never more than the table has folders.
            values = [row[0] for row in folders.distinct().collect()]
            current = current.where(_one_of(part.column, values))
        merged = merge(current.select(*contract.columns))
        rows = staged(lambda: self._laid_out(merged, name)).select(*self.spark.table(table).columns)
        if part:
            self._publish(rows, table, part.column, values)
        else:
            rows.write.insertInto(table, overwrite=True)

    def _publish(self, rows: DataFrame, table: str, column: str, values: Sequence) -> None:
        """Overwrite the folders that get rows, and drop those of `values` that get none.

        `rows` are read from where they were staged, laid out by folder: they are copied
        file by file, by as many tasks as there are cores, and not regrouped once more.
        """
        self._replace_folders(rows, table)
        filled = {row[0] for row in rows.select(column).distinct().collect()}
        for value in set(values) - filled:
            self._drop_folder(table, column, value)

    def _replace_folders(self, rows: DataFrame, table: str) -> None:
        """Overwrite the folders that get rows; a catalog table takes this as a setting only."""
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            rows.write.insertInto(table, overwrite=True)
        finally:
            self.spark.conf.set(setting, before)

    def _drop_folder(self, table: str, column: str, value: object) -> None:
        if value is None:
            text = "NULL"
        else:
            quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
            text = f"'{quoted}'"
        self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = {text})")

    def stored_rows(self, name: str) -> int:
        return self.spark.table(self.table(name)).count()

    def read_folders(self, name: str, values: Sequence) -> DataFrame:
        """The declared columns of the rows in these folders; no other is opened."""
        contract = CONTRACTS[name]
        rows = self.spark.table(self.table(name))
        return rows.where(_one_of(contract.partitioning.column, values)).select(*contract.columns)

    def read(
        self, name: str, since: Column | None = None, until: Column | None = None
    ) -> DataFrame:
        """The declared columns of a table.

        `since` and `until` bound the column that the table is laid out by day
        with; folders of other days are not opened.
        """
        contract = CONTRACTS[name]
        rows = self.spark.table(self.table(name))
        part = contract.partitioning
        if since is not None or until is not None:
            if part is None or part.transform != "day":
                raise ValueError(f"{name} is not laid out by day")
            if since is not None:
                rows = rows.where(F.col(part.column) >= F.to_date(since))
                rows = rows.where(F.col(part.source) >= since)
            if until is not None:
                rows = rows.where(F.col(part.column) <= F.to_date(until))
                rows = rows.where(F.col(part.source) <= until)
        return rows.select(*contract.columns)

    def namespaces(self) -> DataFrame:
        """The namespaces of this store that the catalog has."""
        shown = self.spark.sql("SHOW NAMESPACES").where(
            F.col("namespace").isin([self.namespace(layer) for layer in LAYERS])
        )
        return shown.select(F.substring("namespace", len(self.prefix) + 1, 100).alias("layer"))

    def listing(self) -> DataFrame:
        """Namespaces and tables present in this store, from the catalog."""
        found = None
        for layer in sorted(row["layer"] for row in self.namespaces().collect()):
            shown = self.spark.sql(f"SHOW TABLES IN {self.namespace(layer)}").select(
                F.lit(layer).alias("layer"), F.col("tableName").alias("table_name")
            ).where(~F.col("isTemporary"))
            found = shown if found is None else found.unionByName(shown)
        return found

    def layout(self, name: str) -> DataFrame:
        """Columns, types, partitioning and comment of a table."""
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(name)}")

    def columns(self, name: str) -> DataFrame:
        """Columns of a table as the catalog has them, with a mark of the folder column."""
        listed = self.spark.catalog.listColumns(self.table(name))
        rows = [(c.name, c.dataType, c.isPartition) for c in listed]
        return self.spark.createDataFrame(rows, "column string, type string, is_folder boolean")
