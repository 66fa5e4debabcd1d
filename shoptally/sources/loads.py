"""Loads that can be repeated: each writes beside what is there and counts only once it is noted down.

``target/<table>/load=<id>/accepted=true|false`` holds the rows of one load and ``target/_loads/load=<id>`` one row
that is written last and makes the load visible.  A load that was killed left no such row: readers do not see
what it wrote, and when it is repeated under its id it writes the same folders again.  A load that is noted down is not
repeated.  A refresh is a load that hides all before it, so the old tables stay readable until the moment it is noted
down.  One loader at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shoptally.sources.schemas import FOREIGN_KEYS, LOAD_ORDER

_NOTE = "load string, place long, refresh boolean, counts map<string,long>, rejected map<string,long>, schemas map<string,string>"


class Loads:
    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target

    def notes(self) -> list[Row]:
        """The loads that are noted down, oldest first: one row per load, whatever its size."""
        try:
            found = self.spark.read.schema(_NOTE).parquet(f"{self.target}/_loads").collect()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            found = []
        return sorted(found, key=lambda r: r["place"])

    def visible(self) -> list[Row]:
        """The last refresh and the loads after it."""
        notes = self.notes()
        begins = max((i for i, n in enumerate(notes) if n["refresh"]), default=0)
        return notes[begins:]

    def table(self, name: str, accepted: bool = True) -> DataFrame:
        """The visible rows of a table, or those that were set aside."""
        return self._rows(name, [n for n in self.visible() if name in n["counts"]], accepted)

    def set_aside(self, name: str, load: str) -> DataFrame:
        return self._rows(name, [n for n in self.notes() if n["load"] == load], False)

    def _rows(self, name: str, notes: list[Row], accepted: bool) -> DataFrame:
        if not notes:
            raise ValueError(f"nothing of {name} is loaded at {self.target}")
        schema = notes[-1]["schemas"][name]
        paths = [f"{self.target}/{name}/load={n['load']}" for n in notes]
        # Without these two Spark would add the folder's columns, guessing their types.
        parts = [self.spark.read.schema(f"{schema}, accepted boolean").parquet(path) for path in paths]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.where(F.col("accepted") == accepted).drop("accepted")

    def load(self, tables: Mapping[str, DataFrame], load: str, refresh: bool = False) -> dict[str, int]:
        """Add the tables' rows under the id ``load``, parents first, and return how many were accepted.

        A row with a foreign key that no accepted parent has, in this load or a visible one, is set aside; so
        is one whose key is null.  Tables that the load does not hold stay as they are.
        """
        noted = {n["load"]: n for n in self.notes()}
        if load in noted:
            return {name: noted[load]["counts"][name] for name in LOAD_ORDER if name in noted[load]["counts"]}
        before = [] if refresh else self.visible()
        counts, rejected, schemas = {}, {}, {}
        for name in (n for n in LOAD_ORDER if n in tables):
            rows = tables[name]
            columns = rows.columns
            schemas[name] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            accepted = F.lit(True)
            for i, (child, key, parent, parent_key) in enumerate(FOREIGN_KEYS):
                if child != name:
                    continue
                known = [n for n in before if parent in n["counts"]]
                if parent in counts:
                    known = [*known, Row(load=load, schemas=schemas)]
                keys = self._rows(parent, known, True).select(F.col(parent_key).alias(f"_k{i}")).distinct()
                rows = rows.join(keys, F.col(key) == F.col(f"_k{i}"), "left")
                accepted = accepted & F.col(f"_k{i}").isNotNull()
            rows = rows.withColumn("accepted", accepted).select(*columns, "accepted")
            path = f"{self.target}/{name}/load={load}"
            rows.write.mode("overwrite").partitionBy("accepted").parquet(path)
            written = self.spark.read.schema(f"{schemas[name]}, accepted boolean").parquet(path)
            n = {r["accepted"]: r["count"] for r in written.groupBy("accepted").count().collect()}
            counts[name], rejected[name] = n.get(True, 0), n.get(False, 0)
        place = max((n["place"] for n in noted.values()), default=0) + 1
        note = (load, place, refresh, counts, rejected, schemas)
        self.spark.createDataFrame([note], _NOTE).coalesce(1).write.mode("overwrite").parquet(f"{self.target}/_loads/load={load}")
        return counts

    def clear_hidden(self) -> None:
        """Empty the folders of loads that a refresh has hidden."""
        shown = {n["load"] for n in self.visible()}
        for note in self.notes():
            for name in note["counts"] if note["load"] not in shown else ():
                path = f"{self.target}/{name}/load={note['load']}"
                empty = self.spark.createDataFrame([], f"{note['schemas'][name]}, accepted boolean")
                empty.write.mode("overwrite").partitionBy("accepted").parquet(path)
