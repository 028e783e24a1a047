"""Tables and files: input tables, intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a session on one machine that names none gets a default."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/checkpoints/chatloom"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back.

    A lost executor then costs a re-read of this table, never a re-run of what made it.
    """
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str) -> tuple:
    """A path of any file system that Spark reaches, and that file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    where, files = _place(spark, path)
    return files.makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _place(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, files = _place(spark, path)
    files.delete(where, True)


def arrow_url(spark: SparkSession, path: str) -> str:
    """``path`` as tasks open it by Arrow, without the JVM."""
    url = qualified(spark, path)
    return "file://" + url.removeprefix("file:").removeprefix("//") if url.startswith("file:") else url


class Folder:
    """Small documents and whole tables under one path of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, str(root).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def delete(self, name: str) -> None:
        delete(self.spark, self.path(name))

    def text(self, name: str) -> str | None:
        where, files = _place(self.spark, self.path(name))
        if not files.exists(where):
            return None
        stream = files.open(where)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a document whole or not at all."""
        part, files = _place(self.spark, self.path(f"{name}.{uuid.uuid4().hex}.part"))
        stream = files.create(part)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        where, _ = _place(self.spark, self.path(name))
        files.delete(where, False)
        files.rename(part, where)


def discard(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once its results are written."""
    delete(spark, shared_dir(spark))
