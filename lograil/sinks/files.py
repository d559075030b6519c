"""Small files of a shared file system: list, read, put in place once, remove."""

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path in its terms."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    fs, root = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds since 1970."""
    fs, root = file_system(spark, path)
    return fs.getFileStatus(root).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, root = file_system(spark, path)
    stream = fs.open(root)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in place whole, unless one of that name is there: then nothing changes."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, target = file_system(spark, path)
    if fs.exists(target):
        return False
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # Unlike that of the file system itself, this rename never replaces a file.
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), gateway.new_array(rename, 0))
    except Exception:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the folders above the target are made."""
    fs, to = file_system(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(file_system(spark, source)[1], to):
        raise OSError(f"cannot move {source} to {target}")


def move_all(spark: SparkSession, pairs) -> None:
    """Several moves side by side; each only waits for the file system."""
    with ThreadPoolExecutor(8) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(move), spark, *pair) for pair in pairs]:
            done.result()


def remove(spark: SparkSession, path: str) -> None:
    fs, root = file_system(spark, path)
    fs.delete(root, True)
