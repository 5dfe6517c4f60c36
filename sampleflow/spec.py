"""Options of a generation job, checked when they are made."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field


def _require(holds: bool, message: str) -> None:
    if not holds:
        raise ValueError(message)


@dataclass(frozen=True)
class DataOptions:
    """What to read and write; without ``copy_columns`` every input column is kept."""

    input_path: str
    output_path: str
    input_column: str = "question"
    output_column: str = "response"
    copy_columns: Sequence[str] | None = None
    filter_condition: str | None = None
    limit: int | None = None
    shuffle_seed: int | None = None


@dataclass(frozen=True)
class SamplingOptions:
    """How to sample answers; a temperature list gives one per sample."""

    num_samples: int = 1
    temperature: float | Sequence[float] = 1.0
    top_p: float = 1.0
    top_k: int = -1
    max_tokens: int = 512
    stop_sequences: Sequence[str] | None = None
    seed: int | None = None
    presence_penalty: float = 0.0
    frequency_penalty: float = 0.0
    enable_thinking: bool | None = True

    def __post_init__(self) -> None:
        _require(self.num_samples >= 1, "num_samples must be at least 1")
        single = isinstance(self.temperature, (int, float))
        steps = [self.temperature] if single else list(self.temperature)
        _require(
            single or len(steps) == self.num_samples,
            f"{len(steps)} temperatures given for {self.num_samples} samples",
        )
        _require(all(t >= 0 for t in steps), "temperatures must not be negative")
        _require(0 <= self.top_p <= 1, "top_p must be between 0 and 1")
        _require(self.max_tokens >= 1, "max_tokens must be at least 1")


@dataclass(frozen=True)
class SplitOptions:
    """One split of a table, numbered from 1; neither field means the whole table."""

    split_id: int | None = None
    num_splits: int | None = None

    def __post_init__(self) -> None:
        _require(
            (self.split_id is None) == (self.num_splits is None),
            "split_id and num_splits go together",
        )
        if self.split_id is not None:
            _require(
                1 <= self.split_id <= self.num_splits,
                f"split_id must be between 1 and {self.num_splits}, got {self.split_id}",
            )

    def suffix(self) -> str:
        """What an output name gains for this split."""
        return "" if self.split_id is None else f"-{self.split_id}-of-{self.num_splits}"


@dataclass(frozen=True)
class RetryOptions:
    """Attempts per call, the growing wait between them, and how long a call may take, in seconds."""

    max_attempts: int = 3
    retry_delay: float = 1.0
    backoff_factor: float = 2.0
    max_delay: float = 10.0
    timeout: float | None = None

    def __post_init__(self) -> None:
        _require(self.max_attempts >= 1, "max_attempts must be at least 1")
        _require(self.retry_delay >= 0, "retry_delay must not be negative")
        _require(self.backoff_factor >= 1, "backoff_factor must be at least 1")
        _require(self.timeout is None or self.timeout > 0, "timeout must be positive")

    def wait(self, attempt: int) -> float:
        return min(self.retry_delay * self.backoff_factor ** (attempt - 1), self.max_delay)


@dataclass(frozen=True)
class JobSpec:
    """A whole generation job.

    ``concurrency`` calls run at a time in each of ``partitions`` tasks, by default
    as many as a shuffle has.  ``endpoints`` serve the splits in turn, or the rows of a
    job that is not split.
    """

    data: DataOptions
    sampling: SamplingOptions = field(default_factory=SamplingOptions)
    split: SplitOptions = field(default_factory=SplitOptions)
    retry: RetryOptions = field(default_factory=RetryOptions)
    prompt_template: str | None = None
    system_prompt: str | None = None
    concurrency: int = 1
    partitions: int | None = None
    keep_telemetry: bool = False
    model: str = ""
    endpoints: Sequence[str] = ()
