"""Write, audit, publish: tables are written aside, checked there, and only then put in place."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tiermill.session import _context, remove_path

#: Folder of a lake that holds tables not yet published.
STAGING = "_staging"


class NotPromoted(RuntimeError):
    """A checked table could not be put in place; the former one is."""


@contextmanager
def staged(spark: SparkSession, root: str) -> Iterator[str]:
    """A fresh root for tables that are not published yet, on the lake's own file system; it goes in the end."""
    place = f"{root.rstrip('/')}/{STAGING}/{uuid.uuid4().hex[:12]}"
    try:
        yield place
    finally:
        remove_path(spark, place)


def promote(spark: SparkSession, source: str, target: str) -> str:
    """Put the folder ``source`` in the place of ``target`` by renaming.

    The former folder is renamed aside first and deleted last: readers see the
    old table or the new one, and a promotion that was broken off between the
    two renames is undone by the next. If the new folder cannot be moved, the
    old one is put back and :class:`NotPromoted` raised.
    """
    sc = _context(spark)
    if sc is None:
        raise NotPromoted("renaming needs a session with a file system; this one is remote")
    path = sc._jvm.org.apache.hadoop.fs.Path
    new, now, before = path(source), path(target), path(f"{target.rstrip('/')}.before")
    fs = now.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(before):
        if fs.exists(now):
            fs.delete(before, True)
        else:
            fs.rename(before, now)
    had = fs.exists(now)
    if had and not fs.rename(now, before):
        raise NotPromoted(f"{target} could not be moved aside")
    fs.mkdirs(now.getParent())
    if not fs.rename(new, now):
        if had:
            fs.rename(before, now)
        raise NotPromoted(f"{source} could not be moved to {target}")
    if had:
        fs.delete(before, True)
    return target
