"""Published tables in versions: a run writes a folder of its own and only then
moves the table to it, so a failed run leaves the last good version readable.

``publish`` writes the next version, compares the rows written with the rows
read back, and sets the table's location (or creates the table; a changed
schema replaces the entry). Of older versions ``keep - 1`` stay for readers
that still use them; the others, and folders of failed runs, are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tempora.session import ensure_checkpoint_dir

KEEP = 2


class _Folder:
    """A folder of versions on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._new = jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._fs = self._new(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def versions(self) -> list[str]:
        here = self._new(self.path)
        if not self._fs.exists(here):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(here) if s.isDirectory() and s.getPath().getName().startswith("v"))

    def complete(self, version: str) -> bool:
        return self._fs.exists(self._new(f"{self.path}/{version}/_SUCCESS"))

    def delete(self, version: str) -> None:
        self._fs.delete(self._new(f"{self.path}/{version}"), True)


def table_folder(spark: SparkSession, name: str) -> str:
    """Where a table's versions lie: beside the runs' own folders in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/').rsplit('/', 1)[0]}/tables/{name}"


def publish(spark: SparkSession, name: str, df: DataFrame, root: str | None = None, keep: int = KEEP) -> DataFrame:
    """Full overwrite of ``schema.table`` by a new version under ``root``; returns the table."""
    root = root or table_folder(spark, name)
    folder = _Folder(spark, root)
    last = max([int(v[1:]) for v in folder.versions()], default=0)
    path = f"{root}/v{last + 1:08d}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    written = spark.read.parquet(path)
    found = written.count()
    if found != seen.get["n"]:
        raise RuntimeError(f"{name}: {found} rows in {path}, {seen.get['n']} were written")
    quoted = ".".join(f"`{p}`" for p in name.split("."))
    at = path.replace("'", "\\'")
    kinds = lambda schema: [(f.name, f.dataType) for f in schema]
    if spark.catalog.tableExists(name) and kinds(spark.table(name).schema) == kinds(written.schema):
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{at}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {quoted}")
        spark.catalog.createTable(name, path=path, source="parquet")
    good = [v for v in folder.versions() if folder.complete(v)]
    for v in folder.versions():
        if v not in good[-keep:]:
            folder.delete(v)
    return spark.table(name)
