"""Assembly of the blocks onto the weekly spine, and the run.

All blocks are keyed by (account, week), so the chain of left joins is on one
key set: Spark hash-partitions the spine once and each aggregated block is
already partitioned on those keys by its own aggregate, so every join adds at
most one exchange (the block's) and the spine's partitioning is reused down
the chain. A missing block contributes NULL columns only (Q17, Q24).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import ACCOUNT, WEEK
from tidemark.functions.calendar import AS_OF
from tidemark.functions.columns import quoted
from tidemark.functions.predicates import valid_key
from tidemark.functions.shape import add_durations, clean_names
from tidemark.plans import runlog
from tidemark.sources.sinks import write_weeks

KEYS = [ACCOUNT, WEEK]


def assemble(spine: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """C9/C10 chain → B6 once → F5 → F6. Keeps the spine's row count as long
    as every block is unique on (account, week), which each block guarantees
    by ending in an aggregate on those keys."""
    base = spine.filter(valid_key(spine, ACCOUNT))
    taken = set(base.columns)
    for b in blocks:
        clash = (set(b.columns) - set(KEYS)) & taken
        if clash:
            raise ValueError(f"block columns already present: {sorted(clash)}")
        taken |= set(b.columns)
    # A block is one struct while the joins run: what a join copies is a field per block, and a missing block is one NULL.
    packed = {f"__block{i}": [c for c in b.columns if c not in KEYS] for i, b in enumerate(blocks)}
    joined = base
    for (p, cols), b in zip(packed.items(), blocks):
        joined = joined.join(b.select(*KEYS, F.struct(*[quoted(c) for c in cols]).alias(p)), KEYS, "left") if cols else joined
    out = joined.select(*[quoted(c) for c in base.columns], *[F.col(p)[c].alias(c) for p, cols in packed.items() for c in cols])
    return add_durations(clean_names(out), AS_OF)


def run(
    spark: SparkSession,
    build: Callable[[list[int]], DataFrame],
    requested: DataFrame,
    mart_path: str,
    log_path: str,
    process: str,
    table: str,
) -> list[int]:
    """I1+I3+I4: build every pending week in one job, write, then log.

    ``build(weeks)`` returns the mart rows of those weeks. Weeks already in the
    log for (process, table) are skipped, so a second run changes nothing.
    The weeks of one run are one batch: they share their start, end and elapsed
    time in the log. Returns the weeks written.
    """
    log = runlog.read_log(spark, log_path)
    pending = [r[WEEK] for r in runlog.pending_weeks(requested, log, process, table).collect()]
    if not pending:
        return []
    start = dt.datetime.now()
    write_weeks(build(pending), mart_path)
    end = dt.datetime.now()
    runlog.append_log(spark, log_path, pending, start, end, process, table)
    return pending
