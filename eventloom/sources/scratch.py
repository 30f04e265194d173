"""Where intermediate tables go: the shared folder the cluster names.

A ``scratch_space`` owns its folder and deletes it at the end of its block, so
read or write the results inside. Outside such a block a session has one
folder, which ``clear_scratch`` deletes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass
class ScratchSpace:
    """A folder, and what has been written there once for several queries."""

    root: str
    kept: dict = field(default_factory=dict)

    def delete(self, spark: SparkSession) -> None:
        """Delete the folder with all that is in it, in whatever store it is."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self.kept.clear()


_OPEN: list[ScratchSpace] = []
_SESSIONS: dict[str, ScratchSpace] = {}


def _new_space(spark: SparkSession, base: str | None = None) -> ScratchSpace:
    """An unused folder under ``base``, by default under ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return ScratchSpace(f"{base.rstrip('/')}/eventloom/{uuid.uuid4().hex}")


def current_space(spark: SparkSession) -> ScratchSpace:
    """The innermost open space, or the session's own."""
    if _OPEN:
        return _OPEN[-1]
    application = spark.sparkContext.applicationId
    if application not in _SESSIONS:
        _SESSIONS[application] = _new_space(spark)
    return _SESSIONS[application]


@contextmanager
def scratch_space(spark: SparkSession, base: str | None = None) -> Iterator[ScratchSpace]:
    """A folder for the length of a block; ``base`` must be shared by all executors."""
    space = _new_space(spark, base)
    _OPEN.append(space)
    try:
        yield space
    finally:
        _OPEN.remove(space)
        space.delete(spark)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what the session's own folder holds."""
    space = _SESSIONS.pop(spark.sparkContext.applicationId, None)
    if space is not None:
        space.delete(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the current space."""
    return f"{current_space(spark).root}/{label}-{uuid.uuid4().hex}"
