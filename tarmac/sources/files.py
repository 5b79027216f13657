"""Files as the cluster's file systems see them: listing, renaming, joining, and small texts.

Nothing here moves table rows. Any URI that Spark opens is a path.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Listed(NamedTuple):
    path: str
    size: int


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, path: str) -> list[Listed]:
    """The data files that a path, folder or pattern stands for, in order of their names.

    Names that begin with "_" or "." are not data, as for Spark's readers.
    """
    fs, place = _system(spark, path)
    found: list[Listed] = []
    for status in fs.globStatus(place) or ():
        if status.isFile():
            found.append(Listed(status.getPath().toString(), status.getLen()))
            continue
        files = fs.listFiles(status.getPath(), True)
        top = status.getPath().toString()
        while files.hasNext():
            file = files.next()
            name = file.getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name.removeprefix(top).split("/")):
                found.append(Listed(name, file.getLen()))
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed or not; "" of an empty one. Reads little more than it."""
    fs, place = _system(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
    stream = fs.open(place)
    try:
        raw = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, place = _system(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _system(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _system(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _system(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Moves a file or folder within its file system, in place of what is there."""
    fs, place = _system(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(str(target))
    fs.mkdirs(goal.getParent())
    if fs.exists(goal):
        fs.delete(goal, True)
    if not fs.rename(place, goal):
        raise OSError(f"{source} was not renamed to {target}")


def join(spark: SparkSession, parts: list[str], target: str) -> None:
    """Makes one file of the parts, in their order, which are then gone.

    The file system does it: a distributed one links the parts' blocks, and no byte of them passes
    through Spark. One that can't (an object store) says so, and the parts stay as they are.
    """
    fs, place = _system(spark, target)
    if not parts:
        fs.create(place, True).close()
        return
    local = fs.getScheme() == "file"
    if local:  # without the checksums of each file; and here a target begins empty
        fs = fs.getRawFileSystem()
    else:
        if not fs.hasPathCapability(place, "fs.capability.paths.concat"):
            raise OSError(f"{target}: this file system can't join files; the parts are in {parts[0].rsplit('/', 1)[0]}")
        rename(spark, parts[0], target)
        parts = parts[1:]
    paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
    for k, part in enumerate(parts):
        paths[k] = spark._jvm.org.apache.hadoop.fs.Path(part)
    if parts:
        fs.concat(place, paths)
    for part in parts if local else ():
        delete(spark, part)
