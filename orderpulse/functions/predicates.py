"""The two MERGE guards, with SQL three-valued logic kept intact.

``newer``:   S.ts > T.ts OR T.ts IS NULL       (a null S.ts never beats a non-null T.ts)
``changed``: T.status <> S.status OR T.status IS NULL   (deliberately not null-safe)
"""

from __future__ import annotations

from pyspark.sql import Column


def newer(source_ts: Column, target_ts: Column) -> Column:
    return (source_ts > target_ts) | target_ts.isNull()


def changed(target_status: Column, source_status: Column) -> Column:
    return (target_status != source_status) | target_status.isNull()
