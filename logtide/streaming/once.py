"""Streams without redelivered records.

Delivery is at least once: after a restart, records since the last checkpoint come again. A shard's positions only grow, and what
comes again are positions that the shard has passed; so one position for each shard is all the state there is,
however long the stream runs, and not a set of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "sequence_number string, sub_sequence_number long"


def _new(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The rows above the position that the shard has reached, each position once."""
    reached = tuple(state.get) if state.exists else ("", -1)
    seen: set = set()  # positions of this micro-batch: whole rows go on as they come
    for rows in chunks:
        sub = rows["sub_sequence_number"].fillna(-1).astype("int64")
        at = pd.Series(list(zip(rows["sequence_number"], sub)), index=rows.index, dtype=object)
        keep = [x > reached and not (x in seen or seen.add(x)) for x in at]
        if any(keep):
            yield rows[keep]
    if seen:
        state.update(max(seen))


def deliver_once(records: DataFrame) -> DataFrame:
    """A stream's records (shard_id, sequence_number, sub_sequence_number, ...) without those that were delivered before.

    Records of one shard must come in the order of their positions from micro-batch to micro-batch, as a log's do; within one they
    may come in any order. A shard's rows go through one task, chunk by chunk.
    """
    return records.groupBy("shard_id").applyInPandasWithState(_new, records.schema, STATE, "append", GroupStateTimeout.NoTimeout)
