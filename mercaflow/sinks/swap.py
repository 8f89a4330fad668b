"""Replacement of a run's folders as a whole: staged first, then moved.

A folder is written below ``_staging`` of its table, where readers do not look.
Only when it is complete does the old one move to ``_replaced`` and the new one
to its place; a write that fails leaves the old one as it was. Where a job dies
between the two moves, :func:`recover` moves the old one back; every job calls it
for the tables it reads or writes. A run only touches folders of its own date.

Each move is one call, and takes place as a whole wherever the file system has
folders. An object store without them copies, so there a run must not be killed
while it moves.
"""
from __future__ import annotations

import logging
from collections.abc import Mapping
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

logger = logging.getLogger(__name__)
STAGING, REPLACED = "_staging", "_replaced"


class SwapFailed(RuntimeError):
    """A folder could not be moved; the old one is in its place."""


class _Folders:
    """Folders of the file system that ``path`` lies in."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def names(self, path: str, files: bool = False) -> list[str]:
        """Folders in ``path``, or with ``files`` whatever readers see there."""
        if not self.exists(path):
            return []
        found = [(s.getPath().getName(), s.isDirectory()) for s in self._files.listStatus(self._path(path))]
        if files:
            return [name for name, _ in found if not name.startswith(("_", "."))]
        return [name for name, is_folder in found if is_folder]

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._path(target).getParent())
        if not self._files.rename(self._path(source), self._path(target)):
            raise SwapFailed(f"{source} could not be moved to {target}")

    def drop_if_empty(self, *paths: str) -> None:
        for path in paths:
            if self.exists(path) and not self._files.listStatus(self._path(path)):
                self.delete(path)


def folder_names(spark: SparkSession, table: str, folder: str, files: bool = False) -> list[str]:
    """What lies in a folder of a table: its folders, or with ``files`` anything
    that readers see."""
    return _Folders(spark, table).names(folder, files)


def owned_path(path: str, owned: Mapping[str, str]) -> str:
    return "/".join([path, *(f"{column}={value}" for column, value in owned.items())])


def _place(path: str, owned: Mapping[str, str]) -> tuple[str, str]:
    """The folder that holds the hidden ones, and the run's own folder in it: a
    run that owns no partitions owns the table."""
    if owned:
        return path, owned_path("", owned)[1:]
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def stage(spark: SparkSession, path: str, owned: Mapping[str, str]) -> str:
    """The folder to write the ``owned`` part of a table to, not there yet."""
    root, name = _place(path, owned)
    staged = f"{root}/{STAGING}/{quote(name, safe='=')}"
    recover(spark, path, owned)
    _Folders(spark, path).delete(staged)
    return staged


def discard(spark: SparkSession, path: str, owned: Mapping[str, str]) -> None:
    """Remove what is staged for the ``owned`` part of a table."""
    root, name = _place(path, owned)
    folders = _Folders(spark, path)
    folders.delete(f"{root}/{STAGING}/{quote(name, safe='=')}")
    folders.drop_if_empty(f"{root}/{STAGING}")


def put_in_place(spark: SparkSession, path: str, owned: Mapping[str, str], staged: str | None) -> None:
    """Let the folder ``staged`` be the ``owned`` part of the table; with None, or
    where nothing was written, the table has no such part any more."""
    root, name = _place(path, owned)
    folders, target, parked = _Folders(spark, path), f"{root}/{name}", f"{root}/{REPLACED}/{quote(name, safe='=')}"
    had = folders.exists(target)
    if had:
        folders.move(target, parked)
    if staged is not None and folders.exists(staged):
        try:
            folders.move(staged, target)
        except Exception:
            if had:
                folders.move(parked, target)
            raise
    if had:
        folders.delete(parked)
    folders.drop_if_empty(f"{root}/{STAGING}", f"{root}/{REPLACED}")


def recover(spark: SparkSession, path: str, owned: Mapping[str, str] | None = None) -> list[str]:
    """Put back what a job has parked and then died; what it had replaced already
    goes. With ``owned`` only that part of the table, else all of them. Returns
    the parts put back."""
    root, name = _place(path, owned or {})
    root = path if owned is None else root
    folders, back = _Folders(spark, path), []
    for parked in folders.names(f"{root}/{REPLACED}"):
        part = unquote(parked)
        if owned is not None and part != name:
            continue
        if folders.exists(f"{root}/{part}"):
            folders.delete(f"{root}/{REPLACED}/{parked}")
        else:
            logger.warning("putting back %s of %s: the run that replaced it did not end", part, root)
            folders.move(f"{root}/{REPLACED}/{parked}", f"{root}/{part}")
            back.append(part)
    folders.drop_if_empty(f"{root}/{REPLACED}")
    return back
