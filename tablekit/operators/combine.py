"""Union of frames that may be missing."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def combine_frames(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Union by column name, duplicates kept; None where every frame is None."""
    present = [frame for frame in frames if frame is not None]
    return reduce(DataFrame.unionByName, present) if present else None
