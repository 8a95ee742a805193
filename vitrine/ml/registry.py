"""Model versions claimed by create-if-absent, an alias that moves by an atomic swap.

Layout below the registry folder: ``<name>/versions/<n>`` is the claim of version n (a file that only one caller can
create), ``<name>/records/<n>.json`` says where the finished version lies, ``<name>/aliases/<alias>`` names a version.
A reader of an alias sees the version before or after a move, never a half-written one, and a version gets an alias
only after its model is stored.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def _put(self, path, text: str) -> None:
        """The whole text or nothing: written beside the target, then renamed over it."""
        name = f".{path.getName()}-{uuid.uuid4().hex}"
        if self._fs(path).getUri().getScheme() == "file":  # whose Hadoop client deletes before it renames
            target = path.toUri().getPath()
            side = os.path.join(os.path.dirname(target), name)
            with open(side, "w") as f:
                f.write(text)
            os.replace(side, target)
            return
        side = self._jvm.org.apache.hadoop.fs.Path(path.getParent(), name)
        stream = self._fs(side).create(side, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        array = self.spark.sparkContext._gateway.new_array(options, 1)
        array[0] = options.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self._conf).rename(side, path, array)

    def _get(self, path) -> str | None:
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def claim(self, name: str) -> int:
        """The next version number, which no other caller gets: the file is made only if it is not there."""
        folder = self._path(name, "versions")
        fs = self._fs(folder)
        fs.mkdirs(folder)
        version = 1 + max((int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()), default=0)
        while not self._create(fs, self._jvm.org.apache.hadoop.fs.Path(folder, str(version))):
            version += 1
        return version

    def _create(self, fs, path) -> bool:
        """Make an empty file if none is there; false if another caller made it, be it at the same time.

        A local file system's Hadoop client looks before it creates, so there the operating system decides.  Other
        stores must refuse to create over a file by themselves, as HDFS does.
        """
        if fs.getUri().getScheme() == "file":
            try:
                os.close(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            return True
        try:
            fs.create(path, False).close()
        except Py4JJavaError as e:
            if fs.exists(path):
                return False
            raise e
        return True

    def register(self, name: str, model: PipelineModel, model_dir: str, alias: str = "champion", extra=None) -> tuple[int, str]:
        """Store the model under a claimed version, then move the alias to it; (version, path).

        ``extra(version, path)`` writes what belongs to the version before the alias names it.  A registration that
        dies in between leaves a claimed number without an alias.
        """
        version = self.claim(name)
        path = f"{model_dir.rstrip('/')}/{name}_v{version}"
        model.write().save(path)  # fails rather than replaces
        if extra is not None:
            extra(version, path)
        for folder in ("records", "aliases"):
            self._fs(self._path(name, folder)).mkdirs(self._path(name, folder))
        self._put(self._path(name, "records", f"{version}.json"), json.dumps({"name": name, "version": version, "path": path}))
        self._put(self._path(name, "aliases", alias), str(version))
        return version, path

    def lookup(self, name: str, alias: str = "champion") -> tuple[int, str] | None:
        """(version, path) that an alias names now."""
        version = self._get(self._path(name, "aliases", alias))
        if version is None:
            return None
        return int(version), json.loads(self._get(self._path(name, "records", f"{int(version)}.json")))["path"]

    def versions(self, name: str) -> DataFrame:
        """name, version, path, is_champion: one row per finished version."""
        records = self.spark.read.schema("name string, version int, path string").json(f"{self.root}/{name}/records")
        now = self.lookup(name)
        return records.withColumn("is_champion", F.col("version") == F.lit(now[0] if now else None))

    def load(self, name: str, alias: str = "champion") -> tuple[PipelineModel, str]:
        """The model that the alias names, and 'name (vN)'."""
        found = self.lookup(name, alias)
        if found is None:
            raise ValueError(f"{name} has no version with the alias {alias}")
        return PipelineModel.load(found[1]), f"{name} (v{found[0]})"
