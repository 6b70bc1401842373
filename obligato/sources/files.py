"""Small helpers on the cluster's file system (any Hadoop-supported store)."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local session that names none gets a folder beside its warehouse; on a cluster it must be named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another one of the same file system; no row is written again."""
    fs, new = _path(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), new):
        raise OSError(f"{source} could not be moved to {target}")


#: Columns with nearly as many values as a table has awards. A dictionary of them is given up for each file, after its cost.
IDS = ["award_key", "award_id", "usaspending_url", "solicitation_identifier"]


def writer(rows: DataFrame) -> DataFrameWriter:
    """For Parquet, in a codec that takes less disk than the default one, without dictionaries of ``IDS``."""
    plain = {f"parquet.enable.dictionary#{name}": "false" for name in IDS if name in rows.columns}
    return rows.write.format("parquet").option("compression", "zstd").options(**plain)


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders under ``root`` that hold at least one data file."""
    fs, p = _path(spark, root)
    if not fs.exists(p):
        return []
    values = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            if any(f.getPath().getName().startswith("part-") for f in fs.listStatus(status.getPath())):
                values.append(name.partition("=")[2])
    return sorted(values)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, in order; a missing folder has none."""
    fs, p = _path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file with its whole text, or says False if there is one; of several callers one succeeds.

    A draft is written first. It then gets its name by a step that fails where the name is taken: a rename without
    overwriting on a cluster's file system, a hard link on a local disk, where Java's rename would replace. A store
    without an atomic rename gives no such promise.
    """
    jvm, (fs, target) = spark._jvm, _path(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(draft, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True
