"""Small text files where Spark keeps its tables: on Hadoop's filesystems while a session is active, else local."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def _hadoop(path: str | Path):
    """``(filesystem, path)`` of the active session; None without one."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(path: str | Path, text: str) -> None:
    if (there := _hadoop(path)) is None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")
        return
    stream = there[0].create(there[1], True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(path: str | Path) -> str:
    if (there := _hadoop(path)) is None:
        return Path(path).read_text(encoding="utf-8")
    stream = there[0].open(there[1])
    try:
        return SparkSession.getActiveSession()._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(path: str | Path) -> bool:
    there = _hadoop(path)
    return Path(path).exists() if there is None else there[0].exists(there[1])


def folders(path: str | Path) -> list[str]:
    """Names of the folders below ``path``; none if it is not there."""
    if not exists(path):
        return []
    there = _hadoop(path)
    if there is None:
        return [p.name for p in Path(path).iterdir() if p.is_dir()]
    return [s.getPath().getName() for s in there[0].listStatus(there[1]) if s.isDirectory()]


def remove(path: str | Path) -> None:
    import shutil

    there = _hadoop(path)
    if there is None:
        shutil.rmtree(path, ignore_errors=True)
    else:
        there[0].delete(there[1], True)
