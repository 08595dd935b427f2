"""Write, audit, publish: readers see a version only after its gates have passed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS
from tierstone.operators.conform import conform
from tierstone.plans import quality
from tierstone.sinks.ledger import Ledger
from tierstone.sinks.store import LayerStore

REASON = "rejected_by"


class AuditedTable:
    """Versions of a table, of which readers see the last one that passed.

    A version is written to a place of its own: rows that keep all rules, and, with the first
    rule they break, rows that do not. The rows that keep them are then audited as a whole. Only
    if every gate passes is the view that readers use pointed to the new place, in one
    statement of the catalog. A version that fails stays where it was written, for inspection.
    """

    def __init__(self, store: LayerStore, name: str, rules: dict[str, Column]) -> None:
        self.store, self.spark, self.name, self.rules = store, store.spark, name, rules
        self.contract = CONTRACTS[name]
        self.path = f"{store.root}/_versions/{name}"

    @property
    def view(self) -> str:
        """The name readers use."""
        return f"{self.store.namespace(self.contract.layer)}.{self.contract.table}_published"

    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}/_ledger")

    def version(self, number: int) -> DataFrame:
        """All rows of a version; `rejected_by` is NULL for those that keep the rules."""
        return self.spark.read.schema(f"{self._columns()}, {REASON} STRING, accepted BOOLEAN").parquet(f"{self.path}/version={number}")

    def _columns(self) -> str:
        return ", ".join(f"`{n}` {kind.simpleString()}" for n, kind in self.contract.fields)

    def load(
        self, rows: DataFrame, number: int, gates: Callable[[DataFrame], DataFrame], at_most_rejected: float = 1.0
    ) -> None:
        """Write, audit and publish one version. Raises GateFailed and publishes nothing if a
        gate fails, or if more than that share of the rows was rejected. A rule that is NULL
        for a row is broken. A version that is published stays as it is; one that is not may
        be loaded again."""
        ledger = self.ledger()
        if ledger.is_done(f"published_{number}"):
            raise ValueError(f"{self.name}: version {number} is published already")
        broken = F.coalesce(*(F.when(~F.coalesce(rule, F.lit(False)), F.lit(label)) for label, rule in self.rules.items()))
        judged = conform(rows, self.contract).withColumn(REASON, broken).withColumn("accepted", F.col(REASON).isNull())
        # One pass writes both; a folder for each keeps readers from opening the other.
        judged.write.mode("overwrite").partitionBy("accepted").parquet(f"{self.path}/version={number}")
        written = self.version(number)
        good = written.where("accepted").select(*self.contract.columns)
        share = written.agg(
            F.count_if(~F.col("accepted")).alias("failures"), F.count(F.lit(1)).alias("n")
        ).select(
            F.lit(self.name).alias("table"), F.lit("rejected_share").alias("check"), "failures",
            (F.col("failures") <= F.lit(at_most_rejected) * F.col("n")).alias("passed"),
        )
        audit = quality.all_gates(gates(good), share)
        audit.write.mode("overwrite").parquet(f"{self.path}/_audit/version={number}")
        quality.enforce(self.audit(number))
        self.publish(number)
        ledger.mark(f"published_{number}")

    def audit(self, number: int) -> DataFrame:
        """The gate rows of a version."""
        return self.spark.read.parquet(f"{self.path}/_audit/version={number}")

    def publish(self, number: int) -> None:
        """Point readers to a version; also the way back to an earlier one."""
        self.store.create_namespace(self.contract.layer)
        columns = ", ".join(f"`{c}`" for c in self.contract.columns)
        place = f"{self.path}/version={number}/accepted=true"
        if self.version(number).where("accepted").isEmpty():
            place = None
        source = f"parquet.`{place}`" if place else f"(SELECT {self._nulls()}) WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS SELECT {columns} FROM {source}")

    def _nulls(self) -> str:
        return ", ".join(f"CAST(NULL AS {kind.simpleString()}) AS `{n}`" for n, kind in self.contract.fields)

    def read(self) -> DataFrame:
        """What readers see."""
        return self.spark.table(self.view)

    def quarantine(self) -> DataFrame:
        """Rejected rows of all versions, published or not, with version and reason."""
        rows = self.spark.read.option("basePath", self.path).schema(
            f"{self._columns()}, {REASON} STRING, version BIGINT, accepted BOOLEAN"
        ).parquet(f"{self.path}/version=*")
        return rows.where("NOT accepted").select("version", REASON, *self.contract.columns)
