"""Intermediate tables of one operator call, in the shared folder the cluster names.

``Scratch`` writes a DataFrame as Parquet below ``spark.checkpoint.dir`` and reads it back: lineage is cut, a lost
executor costs a re-read, and the next plan knows the table's measured size (so a small side may be broadcast).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_dir


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted column names, each with as many underscores behind it as ``taken`` (whatever the case) makes necessary."""
    used = {t.lower() for t in taken}
    found = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        found.append(name)
    return found


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    #: Numbers that may be sent to every executor: 16 MB.
    SENT_NUMBERS = 1 << 21

    def sent(self, numbers: DataFrame, name: str) -> DataFrame:
        """Write a table of numbers; it is marked for broadcast only if they are ``SENT_NUMBERS`` at most, as counted.

        Beyond that the planner is free, which means a shuffled join.
        """
        written = self.write(numbers, name)
        return F.broadcast(written) if written.count() * len(written.columns) <= self.SENT_NUMBERS else written

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table.

        The shuffle files of the write are of no use afterwards; a collection of the driver's garbage lets Spark's
        cleaner remove them now instead of at some later time.
        """
        df.write.mode("overwrite").parquet(self.path(name))
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a written table that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *names: str) -> None:
        """Delete all written tables of this call but the named ones, which the returned result still reads."""
        base = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        for entry in base.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(base):
            if entry.getPath().getName() not in names:
                self.drop(entry.getPath().getName())
