"""Landing one large text file with many tasks (fixture side)."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import fresh_dir, local_path

PIECE = 64 << 20


def land_text(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write a column of text as one file below ``path``, or as one for each
    value of the column ``by``, its lines in the order of ``df``'s partitions.

    Every task writes a part, whose length then tells where it begins in
    the whole file; tasks copy the parts there, in pieces of ``PIECE`` bytes.
    So no task handles a whole file.  Only names and lengths of the parts reach
    the driver.  Files of a store that cannot be written in the middle (no
    shared folder) are written by one task.
    """
    spark = df.sparkSession
    if "://" in local_path(path):
        out = (df.repartition(1) if by else df.coalesce(1)).write
        return (out.partitionBy(by) if by else out).text(path)
    parts = fresh_dir(spark, "parts")
    (df.write.partitionBy(by) if by else df.write).text(parts)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(parts)
              .select("path", "length").where("length > 0").collect())
    ends: dict[str, int] = {} if by else {"whole.txt": 0}
    copies = []
    for part, length in sorted(tuple(r) for r in listed):
        name = f"{part.rsplit('/', 2)[1]}/whole.txt" if by else "whole.txt"
        begin = ends.get(name, 0)
        ends[name] = begin + length
        copies += [(part, f"{path}/{name}", at, begin + at) for at in range(0, length, PIECE)]
    os.makedirs(local_path(path), exist_ok=True)
    for name in ends:
        os.makedirs(os.path.dirname(local_path(f"{path}/{name}")), exist_ok=True)
        open(local_path(f"{path}/{name}"), "xb").close()
    if copies:
        spark.sparkContext.parallelize(copies, len(copies)).foreach(_copy)
    open(local_path(f"{path}/_SUCCESS"), "xb").close()


def _copy(piece: tuple[str, str, int, int]) -> None:
    """A piece of a part to its place in the whole; done again, it changes nothing."""
    part, whole, at, place = piece
    left = PIECE
    with open(local_path(part), "rb") as source, open(local_path(whole), "r+b") as target:
        source.seek(at)
        target.seek(place)
        while left and (block := source.read(min(left, 1 << 20))):
            target.write(block)
            left -= len(block)


def slices(df: DataFrame, least: int, size: int, col: str = "body") -> int:
    """How many files of about ``size`` bytes hold the texts, ``least`` or more."""
    total = df.agg(F.sum(F.octet_length(col))).first()[0] or 0
    return max(least, -(-total // size))
