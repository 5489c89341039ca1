"""Small value types shared by jobs, sinks and reports.

Everything here is checked on the driver before any Spark job starts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum


class InsertMode(str, Enum):
    """How a job writes its result into the target table."""

    UPDATE = "update"
    OVERWRITE = "overwrite"

    @classmethod
    def parse(cls, value) -> "InsertMode":
        if isinstance(value, cls):
            return value
        if not isinstance(value, str):
            raise TypeError(f"insert mode must be a string, got {type(value).__name__}")
        try:
            return cls(value)
        except ValueError:
            raise ValueError(
                f"bad insert mode {value!r}; expected one of "
                f"{', '.join(m.value for m in cls)}") from None


class QueryType(str, Enum):
    """Direction of an extreme-value report."""

    HIGHEST = "highest"
    LOWEST = "lowest"

    @classmethod
    def parse(cls, value) -> "QueryType":
        if isinstance(value, cls):
            return value
        if not isinstance(value, str):
            raise TypeError(f"query type must be a string, got {type(value).__name__}")
        try:
            return cls(value)
        except ValueError:
            raise ValueError(
                f"a report ranks by lowest or highest, not by {value!r}"
            ) from None


@dataclass(frozen=True)
class TableSpec:
    """A target table: its name, key and the ordered list of its columns."""

    name: str
    key: tuple[str, ...]
    columns: tuple[str, ...]

    def __post_init__(self):
        if not self.key:
            raise ValueError(f"table {self.name}: empty key")
        missing = [k for k in self.key if k not in self.columns]
        if missing:
            raise ValueError(f"table {self.name}: key columns {missing} not in columns")
        if len(set(self.columns)) != len(self.columns):
            raise ValueError(f"table {self.name}: repeated column names")


@dataclass
class JobResult:
    """What a job or sink did. ``rows_read`` and ``rows_rejected`` are None where not counted."""

    mode: str
    target: str
    rows_read: int | None = None
    rows_written: int = 0
    rows_rejected: int | None = None
    wrote: bool = False
    details: dict = field(default_factory=dict)
