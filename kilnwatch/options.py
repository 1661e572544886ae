"""Job options as plain keyword values with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleOptions:
    """Windows and guards of the anomaly rules.

    ``slice_ms`` is the length of the time slices that one task works on, or a sixteenth of
    which with the sums of :mod:`kilnwatch.operators.trailing`. It must be at least as long
    as the longest window; the default is six times that.

    ``in_arrival_order`` has batch plans follow the order of arrival, as the stream does: a
    late reading sees later samples, and what a later arrival has pushed out stays out.
    ``slice_arrivals`` is then the number of consecutive arrival numbers whose readings of
    one sensor a task puts in order. ``own_limits`` is for limits that differ from reading
    to reading; results are the same without it, at the cost of a copy of the samples in
    reach for each pair of limits.
    """

    limit_window_ms: int = 300_000
    trend_window_ms: int = 60_000
    min_batches: int = 5
    min_trend_samples: int = 42
    min_bias_samples: int = 240
    slice_ms: int | None = None
    in_arrival_order: bool = False
    own_limits: bool = False
    slice_arrivals: int = 1 << 20

    def __post_init__(self) -> None:
        if self.slice_arrivals < 1:
            raise ValueError("a slice holds at least one arrival number")
        if min(self.limit_window_ms, self.trend_window_ms) < 0:
            raise ValueError("a window cannot be negative")
        if self.slice_ms is not None and self.slice_ms < max(1, self.longest_window_ms):
            raise ValueError("a time slice cannot be shorter than the longest window")

    @property
    def longest_window_ms(self) -> int:
        return max(self.limit_window_ms, self.trend_window_ms)

    @property
    def slice_length_ms(self) -> int:
        return self.slice_ms or max(1, 6 * self.longest_window_ms)


@dataclass(frozen=True)
class JobOptions:
    """Options of the streaming job; topics, output path and checkpoints have no defaults.

    ``max_messages_per_trigger`` bounds a micro-batch of the landing query,
    ``max_landed_files`` one of the queries on what it landed, and so what one of them
    holds of one sensor. ``exact_dedup`` keeps a key exactly for its time to live, in
    Python state; without it the JVM keeps the key for one to two such times, much faster. ``files_per_partition`` is the number
    of tasks, hence files, a storage partition is spread over in one micro-batch.
    ``landing_retention`` ("7d") is how long the landing names its files to readers; by
    default it never forgets them. ``merge_every`` is the number of micro-batches after which
    the documents' stream merges batches of its table.
    """

    bootstrap_servers: str = "localhost:9092"
    source_topic: str = ""
    group_id: str = "kilnwatch-ingestion"
    start_from_earliest: bool = True
    checkpoint_interval_ms: int = 60_000
    output_path: str = ""
    dedup_ttl_hours: int = 6
    index: str = "documents"
    violations_topic: str = ""
    checkpoint_dir: str = ""
    max_messages_per_trigger: int | None = 1_000_000
    max_landed_files: int | None = 64
    exact_dedup: bool = False
    files_per_partition: int = 4
    landing_retention: str | None = None
    merge_every: int | None = 16
    rules: RuleOptions = RuleOptions()
