"""Sequence numbers, checkpoints and starting positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.schema import DIGITS

# The names that a stored checkpoint may have instead of a sequence number.
SPECIAL = ("SHARD_END", "TRIM_HORIZON", "LATEST", "AT_TIMESTAMP")


def padded(sequence: Column) -> Column:
    """A decimal sequence number whose text order is its number order."""
    return F.lpad(sequence.cast("string"), DIGITS, "0")


def parse_checkpoint(stored: Column, sub_sequence: Column) -> Column:
    """struct(special, seq, sub_seq): one of the reserved words, or a position."""
    special = stored.isin(*SPECIAL)
    return F.when(
        stored.isNotNull(),
        F.struct(F.when(special, stored).alias("special"), F.when(~special, stored).alias("seq"), F.when(~special, F.coalesce(sub_sequence, F.lit(0).cast("bigint"))).alias("sub_seq")),
    )


def print_checkpoint(checkpoint: Column) -> Column:
    return F.coalesce(checkpoint["special"], checkpoint["seq"])


def after_checkpoint(sequence: Column, sub_sequence: Column, checkpoint: Column) -> Column:
    """Whether a record stands after a checkpoint: always after a special one; sequence numbers are padded."""
    position = checkpoint["seq"]
    later = F.when(sub_sequence.isNotNull(), F.struct(sequence, sub_sequence) > F.struct(position, checkpoint["sub_seq"])).otherwise(sequence > position)
    return checkpoint["special"].isNotNull() | position.isNull() | later


def start_position(checkpoint: Column, initial: Column, initial_timestamp: Column) -> Column:
    """struct(iterator, seq, at) where reading resumes; a position resumes AT its record, which the filter then drops.

    invalid: a checkpoint that nothing can be read from (SHARD_END, or AT_TIMESTAMP without such an initial position).
    """
    special = checkpoint["special"]
    iterator = (
        F.when(checkpoint["seq"].isNotNull(), "AT_SEQUENCE_NUMBER")
        .when(special.isin("TRIM_HORIZON", "LATEST"), special)
        .when((special == "AT_TIMESTAMP") & (initial == "AT_TIMESTAMP"), special)
        .when(checkpoint.isNull(), initial)
        .otherwise("invalid")
    )
    return F.struct(iterator.alias("iterator"), checkpoint["seq"].alias("seq"), F.when(iterator == "AT_TIMESTAMP", initial_timestamp).alias("at"))


def shard_end_checkpoint(staged: Column, greatest: Column, last: Column, ended: Column, release: Column) -> Column:
    """What a flush writes: SHARD_END, position or nothing. Positions are structs, or null."""
    at_end = ended & staged.eqNullSafe(greatest) & staged.isNotNull()
    empty_end = staged.isNull() & release & ended & ((greatest.isNull() & last.isNull()) | (last.isNotNull() & last.eqNullSafe(greatest)))
    return F.when(at_end | empty_end, "SHARD_END").when(staged.isNotNull(), "POSITION").when(release, "RELEASE").otherwise("NOTHING")


def polling_end(children: Column, next_iterator: Column) -> Column:
    """A polled shard has ended: it has children and no next iterator."""
    return (F.coalesce(F.size(children), F.lit(0)) > 0) & next_iterator.isNull()


def pushed_end(children: Column) -> Column:
    """A subscribed shard has ended: it has children."""
    return F.coalesce(F.size(children), F.lit(0)) > 0


def poll_delay(behind_ms: Column, interval_ms: int) -> Column:
    """Milliseconds until the next poll: none while records are left behind."""
    return F.when(behind_ms != 0, F.lit(0)).otherwise(F.lit(interval_ms)).cast("bigint")


def backoff(attempt: Column, least_ms: int, most_ms: int, factor: float = 2.0) -> Column:
    """Milliseconds before a retry: grows by the factor with each attempt (from 0), up to a maximum."""
    return F.least(F.lit(float(most_ms)), F.lit(float(least_ms)) * F.pow(F.lit(factor), attempt.cast("double"))).cast("bigint")
