"""The checkpointer's state machine: staging, flushing, ends of shards.

The same step function folds over a batch of events and, as the state of a streaming query, over a stream of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logtide.operators.batching import fold_sorted

#: Events: a record is staged; the greatest position seen; the shard's end is seen; flush; flush and release; a flush that the store refuses.
KINDS = ("stage", "seen", "end", "checkpoint", "release", "refused")


@dataclass
class Checkpointer:
    staged: int | None = None
    last: int | None = None
    greatest: int | None = None
    ended: bool = False

    def step(self, kind: str, position: int | None) -> str | None:
        """Apply an event; the checkpoint that is written, ``RELEASE`` for a mere release, or None."""
        if kind == "stage":
            self.staged = position
        elif kind == "seen":
            self.greatest = position
        elif kind == "end":
            self.ended = True
        elif kind in ("checkpoint", "release"):
            release = kind == "release"
            if self.staged is not None:
                at_end = self.ended and self.greatest == self.staged
                out = "SHARD_END" if at_end else str(self.staged)
                # an end is no position: nothing is known to have been flushed up to
                self.last, self.staged = None if at_end else self.staged, None
                return out
            if release and self.ended and ((self.greatest is None and self.last is None) or (self.last is not None and self.last == self.greatest)):
                return "SHARD_END"
            return "RELEASE" if release else None
        elif kind != "refused":  # a refused flush leaves all as it was
            raise ValueError(kind)
        return None


def checkpoints(events: DataFrame, shard: str, order: list[str], kind: str = "kind", position: str = "position") -> DataFrame:
    """Adds ``written``: the checkpoint that each event causes, if any."""

    def step(state, rows):
        state = state or Checkpointer()
        out = [state.step(k, p) for k, p in zip(rows.column(kind).to_pylist(), rows.column(position).to_pylist())]
        return state, [pa.array(out, pa.string())]

    return fold_sorted(events, shard, order, "written string", step)


STATE = "staged bigint, last bigint, greatest bigint, ended boolean"


def stream_checkpoints(events: DataFrame, shard: str = "shard_id", kind: str = "kind", position: str = "position", order: str = "event_id") -> DataFrame:
    """The same over a stream of events: (shard, event, written) of each checkpoint."""

    def step(key, frames, state: GroupState):
        import pandas as pd

        now = Checkpointer(*state.get) if state.exists else Checkpointer()
        out = []
        for frame in frames:
            frame = frame.sort_values(order)
            for e, k, p in zip(frame[order], frame[kind], frame[position]):
                written = now.step(k, None if pd.isna(p) else int(p))
                if written is not None:
                    out.append((key[0], int(e), written))
        state.update((now.staged, now.last, now.greatest, now.ended))
        yield pd.DataFrame(out, columns=["shard_id", "event_id", "written"])

    return events.groupBy(shard).applyInPandasWithState(step, "shard_id string, event_id bigint, written string", STATE, "append", GroupStateTimeout.NoTimeout)
