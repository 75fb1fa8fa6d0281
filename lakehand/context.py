"""Job context for curated transforms (S10, H2, A11, V4 inputs).

Replaces the reference's notebook globals: the batch start/end (overridable for
history replay), the source/target names, and the list of tables a transform
read (its lineage), which goes into the run output.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclasses.dataclass
class JobContext:
    spark: SparkSession
    entity_type: str                   # "Dimension" | "Fact"
    name: str                          # entity name, e.g. "Customer"
    start: str | None = None           # batch start; default now (UTC)
    end: str | None = None             # explicit end date (history replay)
    source: str = "trusted"
    target: str = "curated"
    tables: list = dataclasses.field(default_factory=list)

    def __post_init__(self):
        if self.start is None:
            self.start = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")

    @property
    def entity_name(self) -> str:
        """First letter of the entity type + '_' + name (e.g. D_Customer)."""
        return f"{self.entity_type[:1]}_{self.name}"

    @property
    def destination(self) -> str:
        return f"{self.target}.{self.entity_name}"

    @property
    def bk(self) -> str:
        return f"{self.name}_BK"

    @property
    def sk(self) -> str:
        return f"{self.name}_SK"

    def table(self, name: str, cache: bool = False) -> DataFrame:
        """Read a table and record it once for lineage; caching only on request."""
        if name not in self.tables:
            self.tables.append(name)
        df = self.spark.table(name)
        return df.cache() if cache else df

    def current(self, name: str) -> DataFrame:
        """F5 over a tracked table."""
        return self.table(name).where(F.col("_Current") == 1)

    def run_output(self, metrics_row: dict | None = None) -> str:
        """The run-output JSON (counts + entity) that the log and lineage views parse."""
        return json.dumps({"Counts": metrics_row or {},
                           "CuratedTransform": {"EntityType": self.entity_type, "Name": self.name,
                                                "EntityName": self.entity_name, "Destination": self.destination,
                                                "Tables": list(self.tables)}})


def run_entity(ctx: JobContext, transform, table, on_duplicate: str = "error", **kw) -> str:
    """Build one curated entity: ``transform(ctx) -> DataFrame`` (source rows with
    ``<Name>_BK``), then a type 2 save into ``table`` (a :class:`~lakehand.sinks.keyed.KeyedTable`).

    Returns the run-output JSON.  Inserted and closed rows were counted by the save itself,
    the table's rows come from the files' footers.
    """
    table.save_scd2(transform(ctx), ctx.bk, ctx.sk, ctx.start, ctx.end, on_duplicate=on_duplicate, **kw)
    done = table.last_metrics
    return ctx.run_output({"CuratedCount": table.read().count(), "InsertCount": done["InsertCount"],
                           "UpdateCount": done["UpdateCount"]})
