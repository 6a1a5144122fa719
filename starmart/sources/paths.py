"""File-system questions, asked through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.getFileStatus(hadoop_path).isDirectory()


def is_complete(spark: SparkSession, path: str) -> bool:
    """A written folder whose job finished."""
    return exists(spark, f"{path}/_SUCCESS")


def mark_complete(spark: SparkSession, path: str) -> None:
    fs, mark = _file_system(spark, f"{path}/_SUCCESS")
    fs.create(mark, True).close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def size_of(spark: SparkSession, *paths: str) -> int:
    """Bytes under the paths; a missing one counts nothing."""
    total = 0
    for path in paths:
        fs, hadoop_path = _file_system(spark, path)
        if fs.exists(hadoop_path):
            total += fs.getContentSummary(hadoop_path).getLength()
    return total


def sizes_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Data files below a folder, as paths relative to it, with their bytes; none without such a folder."""
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return {}
    root = fs.makeQualified(hadoop_path).toUri().getPath().rstrip("/") + "/"
    found, listed = {}, fs.listFiles(hadoop_path, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toUri().getPath().removeprefix(root)
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found[name] = status.getLen()
    return dict(sorted(found.items()))


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a folder, as paths relative to it."""
    return list(sizes_in(spark, folder))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder; none if there is no such folder."""
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the folder above the target is made, the target must not exist."""
    fs, source_path = _file_system(spark, source)
    target_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) or not fs.rename(source_path, target_path):
        raise OSError(f"{source} cannot be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place as a whole or not at all."""
    fs, hadoop_path = _file_system(spark, f"{path}.part")
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
