"""Folders and small texts of any file system that Spark reaches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = hadoop_path(spark, path)
    return files.exists(hadoop)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    files, hadoop = hadoop_path(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(goal.getParent())
    if not files.rename(hadoop, goal):
        raise OSError(f"{source} could not be moved to {target}")


def delete_path(spark: SparkSession, path: str) -> None:
    files, hadoop = hadoop_path(spark, path)
    files.delete(hadoop, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, hadoop = hadoop_path(spark, path)
    files.mkdirs(hadoop)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none when it is absent."""
    files, hadoop = hadoop_path(spark, folder)
    if not files.exists(hadoop):
        return []
    return [status.getPath().getName() for status in files.listStatus(hadoop)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    files, draft = hadoop_path(spark, f"{path}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    move_path(spark, f"{path}.draft", path)


def read_text(spark: SparkSession, path: str) -> str:
    files, hadoop = hadoop_path(spark, path)
    stream = files.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Folder:
    """A folder that holds data files, by its steps below the table's folder."""

    path: str
    steps: tuple[str, ...]
    size: int
    n_files: int


def data_folders(spark: SparkSession, location: str, levels: int) -> list[Folder]:
    """The folders `levels` below the location, with the bytes and number of their files."""
    files, root = hadoop_path(spark, location)
    if not files.exists(root):
        return []
    found: dict[str, list[int]] = {}
    listing = files.listFiles(root, True)
    while listing.hasNext():
        status = listing.next()
        path = status.getPath()
        if path.getName()[0] not in "_.":
            found.setdefault(path.getParent().toString(), []).append(status.getLen())
    return [
        Folder(path, tuple(path.split("/")[-levels:]), sum(sizes), len(sizes))
        for path, sizes in sorted(found.items())
    ]
