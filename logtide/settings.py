"""Settings with their defaults and the combinations that are refused."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Backoff:
    """Delays that grow by a factor up to a maximum; ``retries`` None: without end."""

    least_s: float
    most_s: float
    factor: float = 2.0
    retries: int | None = None

    def delays(self, n: int) -> list[float]:
        """The first n delays, or fewer if the retries end before."""
        count = n if self.retries is None else min(n, self.retries + 1)
        return [min(self.most_s, self.least_s * self.factor**i) for i in range(count)]


@dataclass(frozen=True)
class PollingSettings:
    """Reading by polls of at most ``batch_size`` records; failed polls are tried again as ``retry`` says."""

    batch_size: int = 1000
    interval_s: float = 1.0
    retry: Backoff = Backoff(1, 60, 2.0, 0)

    def trigger(self, caught_up: bool) -> dict[str, object]:
        """Drain what is left behind at once, then poll in intervals."""
        return {"processingTime": f"{self.interval_s} seconds"} if caught_up else {"availableNow": True}


@dataclass(frozen=True)
class ProducerSettings:
    """What ``produce.plan`` does with records; ``backoff`` is that of ``observe.Client`` when a write fails."""

    backoff: Backoff = Backoff(0.5, 60, 2.0, 5)
    aggregate: bool = False
    predict_shards: bool = True
    throttle: bool = True
    allowed_error: float = 0.05

    def __post_init__(self) -> None:
        if self.aggregate and not self.predict_shards:
            raise ValueError("aggregation needs shard prediction")
        if self.throttle and not self.predict_shards:
            raise ValueError("throttling needs shard prediction")
        if not 0 <= self.allowed_error <= 1:
            raise ValueError("the allowed error is a share")


@dataclass(frozen=True)
class LeaseSettings:
    """When leases are renewed and when they expire, for ``strategies.Coordinator``."""

    renew_interval_s: int = 3
    expiration_s: int = 10

    def __post_init__(self) -> None:
        if self.renew_interval_s >= self.expiration_s:
            raise ValueError("leases have to be renewed before they expire")


@dataclass(frozen=True)
class CheckpointSettings:
    """When a consumer checkpoints, and how many records of a shard it processes at a time, those of one key in order."""

    batch_size: int = 200
    parallelism: int = 1
    one_key_at_a_time: bool = False  # a checkpoint between two records of one key
