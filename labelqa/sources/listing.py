"""Directory listing as a data source: empty directories and empty files included.

Spark's file sources list files that hold bytes; a directory without files and
a file of zero bytes leave no row. Case discovery has to see both. Here the
driver lists only the root (names of the case directories, as any source holds
its input paths); the directories themselves are listed by the tasks, a group
of directories each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Schemes that Arrow can list, by the names Spark knows them under.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
SCHEMA = "case_dir string, name string, length long"


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` as Spark's own file sources print it, scheme included."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") or "/")
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(path).toString()


def arrow_uri(uri: str) -> str | None:
    """The same place in Arrow's notation; None if Arrow has no such store."""
    scheme, rest = uri.split(":", 1)
    if scheme not in ARROW_SCHEMES:
        return None
    return f"{ARROW_SCHEMES[scheme]}://" + ("/" + rest.lstrip("/") if scheme == "file" else rest.lstrip("/"))


@dataclass
class Directories(InputPartition):
    names: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.uri, self.prefix = options["uri"], options.get("prefix", "")
        self.per = int(options.get("directories", 256))

    def _open(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.uri.replace("%", "%25").replace(" ", "%20"))

    def partitions(self):
        from pyarrow import fs
        store, path = self._open()
        found = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(path))
                       if f.type == fs.FileType.Directory and f.base_name.startswith(self.prefix))
        return [Directories(found[i:i + self.per]) for i in range(0, len(found), self.per)] or [Directories([])]

    def read(self, partition):
        from pyarrow import fs
        store, path = self._open()
        for name in partition.names:
            entries = [f for f in store.get_file_info(fs.FileSelector(f"{path}/{name}")) if f.type == fs.FileType.File]
            for f in entries:
                yield name, f.base_name, f.size
            if not entries:
                yield name, None, None


class CaseListing(DataSource):
    """``spark.read.format("case_listing")``: files of the directories directly
    below option ``uri`` whose names start with option ``prefix``; one row with
    null ``name`` for a directory without files."""

    @classmethod
    def name(cls):
        return "case_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(dict(self.options))


def list_directories(spark: SparkSession, root: str, prefix: str = "", directories: int = 256) -> DataFrame | None:
    """``case_dir, name, length`` below ``root``; None where Arrow cannot list
    the store (then Spark's own listing has to do, without empty files)."""
    uri = arrow_uri(qualified(spark, root))
    if uri is None:
        return None
    spark.dataSource.register(CaseListing)
    return (spark.read.format("case_listing").option("uri", uri).option("prefix", prefix)
            .option("directories", directories).load())
