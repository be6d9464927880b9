"""What one conversion should do."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields

from ..functions.fixed import CATEGORICAL_TYPES, CHARSET, MAX_CATEGORIES
from ..operators.types import PROFILES


@dataclass(frozen=True)
class ConversionSpec:
    """Settings of a conversion; only `out_path` is required.

    `nrows` and `npartitions` of None or 0 keep all rows and partitions.
    `tab_offset` > 0 means empty cells at the start of data rows, < 0 at the
    end. `dtype_dict` is a two-level mapping or the name of a default one.
    `index_categories` stores categories as their list positions.
    `check_quotes` reads the lines once more beforehand and refuses quoted cells with line breaks.
    """

    out_path: str
    nrows: int | None = 0
    npartitions: int | None = 0
    tab_offset: int = 0
    force: bool = False
    dtype_dict: Mapping | str = "dtype"
    max_categories: int = MAX_CATEGORIES
    categorical_type: tuple[str, ...] = CATEGORICAL_TYPES
    encoding: str = CHARSET
    settings: Mapping = field(default_factory=dict)
    index_categories: bool = False
    description: str | None = None
    check_quotes: bool = True

    def __post_init__(self):
        if not self.out_path:
            raise ValueError("A conversion needs an out_path")
        if isinstance(self.dtype_dict, str) and self.dtype_dict not in PROFILES:
            raise ValueError(f"Unknown type profile {self.dtype_dict!r}; there are {sorted(PROFILES)}")
        if (self.nrows or 0) < 0 or (self.npartitions or 0) < 0:
            raise ValueError("nrows and npartitions cannot be negative")
        object.__setattr__(self, "categorical_type", tuple(self.categorical_type))

    @classmethod
    def from_dict(cls, config: Mapping) -> ConversionSpec:
        """A spec from a mapping of settings; missing ones take their defaults."""
        known = {f.name for f in fields(cls)}
        unknown = set(config) - known
        if unknown:
            raise ValueError(f"Unknown conversion settings {sorted(unknown)}")
        if "out_path" not in config:
            raise ValueError("A conversion needs an out_path")
        return cls(**config)

    @property
    def row_index(self) -> bool:
        return bool(self.settings.get("write_index", False))

    def as_config(self) -> dict:
        return {**asdict(self), "categorical_type": list(self.categorical_type)}
