"""Settings as one frozen object; nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass

from quire.errors import ConfigurationError


@dataclass(frozen=True)
class ChunkSettings:
    """Sizes in tokens of the session's token counter."""

    parent_target: int = 1500
    parent_min: int = 1000
    parent_max: int = 2000
    child_target: int = 256
    child_tolerance: float = 0.10
    child_max: int = 512

    def __post_init__(self) -> None:
        if not 0 < self.parent_min <= self.parent_target <= self.parent_max:
            raise ConfigurationError("parent sizes must rise from min over target to max")
        if not 0 < self.child_target <= self.child_max or not 0 <= self.child_tolerance < 1:
            raise ConfigurationError("child target must be positive and within the maximum, tolerance in [0, 1)")

    @property
    def child_range(self) -> tuple[int, int]:
        spread = int(self.child_target * self.child_tolerance)
        return self.child_target - spread, self.child_target + spread

    @property
    def parent_range(self) -> tuple[int, int]:
        return self.parent_min, self.parent_target


@dataclass(frozen=True)
class TableSettings:
    """A table beyond either number is linearised row by row into several texts."""

    large_rows: int = 50
    large_cols: int = 10


@dataclass(frozen=True)
class Settings:
    chunks: ChunkSettings = ChunkSettings()
    tables: TableSettings = TableSettings()
    embedding_model: str = "text-embedding-3-small"
    embedding_dimension: int = 1536
    embed_batch: int = 100
    retries: int = 3
    first_backoff: float = 2.0
    qa_share: float = 0.20
    qa_always: tuple[str, ...] = ("emergenc", "vaccin")

    def __post_init__(self) -> None:
        if self.embedding_dimension <= 0 or self.embed_batch <= 0 or not 0 <= self.qa_share <= 1 or not self.embedding_model.strip():
            raise ConfigurationError("embedding dimension and batch must be positive, the share in [0, 1], the model named")
