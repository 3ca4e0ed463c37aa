"""Unions of frames that describe the same table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_present(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """UNION ALL by column name of the frames that exist, None if there are none.

    Where a column is text in one frame and typed in another it becomes text: feeds of
    different platforms need not agree, and text must not be forced into a number.
    """
    present = [frame for frame in frames if frame is not None]
    if len(present) < 2:
        return present[0] if present else None
    kinds: dict[str, set[str]] = {}
    for frame in present:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    to_text = {
        name: F.col(name).cast("string")
        for name, found in kinds.items()
        if len(found) > 1 and "string" in found
    }
    if to_text:
        present = [frame.withColumns(to_text) for frame in present]
    return reduce(DataFrame.unionByName, present)
