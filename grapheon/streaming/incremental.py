"""Model files as a stream: a batch resolves the modules whose files have changed, and no others.

A name means something only within its module, so a module is what is resolved anew. The files' contents are a versioned table with their hashes, and elements and relations are
versioned tables by module. A batch that comes again finds the same hashes and changes nothing; one that was stopped after some of its writes is run again as a whole, for the
files are written last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grapheon.notation import model as notation
from grapheon.plans.lineage import cut
from grapheon.sources.files import module_of
from grapheon.sources.versions import Table


@dataclass
class Store:
    """Three tables below a folder: files (path, module, sha, text), elements and relations (by module)."""

    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        self.files, self.elements, self.relations = (Table(self.spark, f"{self.path}/{n}") for n in ("files", "elements", "relations"))

    def take(self, batch: DataFrame, batch_id: int = 0) -> list[str]:
        """The modules that a batch of files (path, text) changes, resolved anew. Of files of one path the last text in order stays; a null text removes the file."""
        latest = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("text")))
        given = batch.filter("path is not null").withColumn("_n", latest).filter("_n = 1").select("path", module_of(F.col("path")).alias("module"), F.sha2("text", 256).alias("sha"), "text")
        base = self.files.current()
        old = self.files.read(base.number) if base.number else given.limit(0)
        changed = cut(given.join(old.select("path", F.col("sha").alias("_old")), "path", "left").filter("not (sha <=> _old)").drop("_old"))
        modules = [r.module for r in changed.select("module").distinct().orderBy("module").collect()]  # names; a batch's at most
        if not modules:
            return []
        now = cut(old.join(changed.select("path"), "path", "left_anti").unionByName(changed.filter("sha is not null")))
        parsed = cut(notation.declarations(now.filter(F.col("module").isin(modules)).select("path", "text")))
        tag = f"batch {batch_id}"
        self.elements.replace(notation.elements(parsed), "module", modules, tag=tag)
        self.relations.replace(notation.relations(parsed), "module", modules, tag=tag)
        self.files.write(now, base, tag)
        return modules

    def follow(self, files: DataFrame, checkpoint: str, **trigger):
        """A query that takes the stream `files` (path, text) batch by batch."""
        return files.writeStream.foreachBatch(lambda df, n: self.take(df, n)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
