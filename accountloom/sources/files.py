"""Folder operations on any file system Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _open(spark, path)
    return files.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, folder = _open(spark, path)
    if not files.exists(folder):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(folder)]


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _open(spark, path)
    files.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears under its name when it is complete."""
    unfinished = f"{path}.{uuid.uuid4().hex}"
    store, place = _open(spark, unfinished)
    out = store.create(place, True)
    out.write(text.encode())
    out.close()
    move(spark, unfinished, path)


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _open(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move(spark: SparkSession, path: str, target: str) -> None:
    files, folder = _open(spark, path)
    if not files.rename(folder, _open(spark, target)[1]):
        raise OSError(f"cannot move {path} to {target}")


def put_in_place(spark: SparkSession, new: str, target: str) -> None:
    """Let a finished folder take another's place; if that fails, the other stays."""
    if not exists(spark, target):
        move(spark, new, target)
        return
    parent, _, name = target.rpartition("/")
    aside = f"{parent}/_old-{name}-{uuid.uuid4().hex}"
    move(spark, target, aside)
    try:
        move(spark, new, target)
    except Exception:
        move(spark, aside, target)
        raise
    delete(spark, aside)
