"""Expiry of what a store no longer needs: mark what the newest heads name, sweep the rest."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import SparkSession

from pricelake.files import children, delete, delete_if_empty
from pricelake.plans.store import delta_path, newest_heads, quarantine_path


def _number(name: str, prefix: str) -> int | None:
    text = name.removeprefix(prefix)
    return int(text) if name.startswith(prefix) and text.isdecimal() else None


def expire(
    spark: SparkSession, root: str, rejected_before: dt.datetime | None = None
) -> dict[str, int]:
    """Delete the snapshots, manifest rows and delta batches that nothing reads any more.

    Kept are the newest head and the one before it, which a reader that began before the
    last compaction still reads: their snapshots, and all delta batches that the older of
    the two has not folded. Snapshots without a manifest row go if their version has been
    decided, as their writer has lost; the one being written is of a later version.
    Quarantined records go by age only, and only where ``rejected_before`` is given.

    Folders are listed bit by bit and no file is read. Running it again, also after it
    broke off, removes what is left. Returns the number of folders removed by kind.
    """
    gone: Counter[str] = Counter(base=0, manifest=0, delta=0, quarantine=0)

    def remove(kind: str, path: str) -> None:
        delete(spark, path)
        gone[kind] += 1

    heads = newest_heads(spark, root)
    if len(heads) == 2:
        newest, before = heads
        kept = {head["path"].rsplit("/", 1)[-1] for head in heads}
        for name, _ in children(spark, f"{root}/base"):
            version = name.split("-", 1)[0]
            if version.isdecimal() and int(version) <= newest["version"] and name not in kept:
                remove("base", f"{root}/base/{name}")
        for name, _ in children(spark, f"{root}/manifest"):
            version = _number(name, "v=")
            if version is not None and version < before["version"]:
                remove("manifest", f"{root}/manifest/{name}")
        for run, _ in children(spark, delta_path(root)):
            last = before["folded"].get(run.removeprefix("run="), -1)
            folder = f"{delta_path(root)}/{run}"
            for name, _ in children(spark, folder) if run.startswith("run=") else ():
                batch = _number(name, "batch=")
                if batch is not None and batch <= last:
                    remove("delta", f"{folder}/{name}")
            delete_if_empty(spark, folder)
    if rejected_before is not None:
        limit = rejected_before.timestamp() * 1000
        for run, _ in children(spark, quarantine_path(root)):
            folder = f"{quarantine_path(root)}/{run}"
            for name, changed in children(spark, folder) if run.startswith("run=") else ():
                if changed < limit:
                    remove("quarantine", f"{folder}/{name}")
    return dict(gone)
