"""Tables that steps add rows to, each request's rows once.

Rows are staged first. A manifest then says which requests the staged rows are of and how
many each has; only what a finished manifest names is in the table. A job that is repeated under
its run's name takes up where it ended: requests that a manifest names are not written again, and count as they did.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.session import delete_folder, folder_names

_PLACE = "run string, step int, attempt string"
PLACE = ["run", "step", "attempt"]


class WrittenTable:
    """A table below ``path`` in the shared store, of a fixed schema without ``request_id``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, id_type: str = "bigint"):
        self.spark, self.path, self.id_type = spark, path.rstrip("/"), id_type
        self.columns = spark.createDataFrame([], schema).schema
        if {"request_id", *PLACE} & set(self.columns.names):
            raise ValueError("a written table has no columns request_id, run, step or attempt")

    def _attempts(self, run: str | None = None, step: int | None = None) -> list[str]:
        """The attempts whose manifest is finished."""
        root, out = f"{self.path}/manifest", []
        for r in [f"run={run}"] if run is not None else folder_names(self.spark, root):
            for s in [f"step={step}"] if step is not None else folder_names(self.spark, f"{root}/{r}"):
                if r.startswith("run=") and s.startswith("step="):
                    names = folder_names(self.spark, f"{root}/{r}/{s}")
                    out += [n.partition("=")[2] for n in names if "_SUCCESS" in folder_names(self.spark, f"{root}/{r}/{s}/{n}")]
        return out

    def _stored(self, part: str, columns: str, attempts: list[str]) -> DataFrame:
        if not attempts:
            return self.spark.createDataFrame([], f"{columns}, {_PLACE}")
        # Partition columns: only the folders of these attempts are read.
        return self.spark.read.schema(f"{columns}, {_PLACE}").parquet(f"{self.path}/{part}").where(F.col("attempt").isin(attempts))

    def manifest(self, run: str | None = None, step: int | None = None) -> DataFrame:
        """``request_id, n, run, step, attempt``: what each request wrote in a step; where two jobs wrote at once, one of them."""
        rows = self._stored("manifest", f"request_id {self.id_type}, n bigint", self._attempts(run, step))
        if run is not None:
            rows = rows.where((F.col("run") == run) & (F.col("step") == step))
        return rows.groupBy("request_id", "run", "step").agg(F.min_by("n", "attempt").alias("n"), F.min("attempt").alias("attempt"))

    def rows(self) -> DataFrame:
        """The rows of the table as it is now."""
        attempts = self._attempts()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)
        stored = self._stored("rows", f"request_id {self.id_type}, {columns}", attempts)
        named = self._stored("manifest", f"request_id {self.id_type}, n bigint", attempts)
        # Two jobs of one run that wrote for the same request at once: the rows of one of them count.
        twice = named.groupBy("request_id", "run", "step").agg(F.count("*").alias("times"), F.min("attempt").alias("kept")).where("times > 1")
        if not twice.isEmpty():
            lost = named.join(twice, ["request_id", "run", "step"]).where("attempt <> kept").select("request_id", *PLACE)
            stored = stored.join(lost, ["request_id", *PLACE], "left_anti")
        return stored.select(*[F.col(f"`{n}`") for n in self.columns.names])

    def add(self, calls: DataFrame, body: Callable[[DataFrame], DataFrame], run: str, step: int) -> DataFrame:
        """Write what ``body`` gives for ``calls`` (``request_id``, ...): ``request_id, n``, the rows that each request has written.

        ``body`` runs for requests only that have not written yet in this step of the run, and gives ``request_id`` and the table's columns.
        """
        before = self.manifest(run, step)
        todo = calls.join(before.select("request_id"), "request_id", "left_anti")
        attempt = uuid.uuid4().hex
        place = f"run={run}/step={step}/attempt={attempt}"
        made = body(todo)
        missing = sorted({"request_id", *self.columns.names} - set(made.columns))
        if missing:
            raise ValueError(f"rows to write lack {', '.join(missing)}")
        typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.columns]
        try:
            made.select(F.col("request_id").cast(self.id_type).alias("request_id"), *typed).write.parquet(f"{self.path}/rows/{place}")
            staged = self.spark.read.schema(f"request_id {self.id_type}").parquet(f"{self.path}/rows/{place}")
            counts = staged.groupBy("request_id").agg(F.count("*").alias("n"))
            named = todo.select("request_id").join(counts, "request_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            named.write.parquet(f"{self.path}/manifest/{place}")
        except Exception:
            # Without a manifest the rows are in no table; they only take room.
            delete_folder(self.spark, f"{self.path}/rows/{place}")
            raise
        written = calls.select("request_id").join(self.manifest(run, step), "request_id")
        return written.select("request_id", "n")
