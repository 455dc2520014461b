"""What is known about a source table, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """How one source table is loaded.

    ``incremental`` tables are pulled past their high-water mark and upserted on ``keys``; the others
    are replaced whole. ``buckets`` is the number of hash buckets the stored table is split into, the
    unit an upsert rewrites. ``id_range`` buckets by ``floor(id / id_range)`` instead, so that a batch
    of recent ids touches only the newest buckets: the choice for large tables whose ids grow. The id is
    ``range_key``, one of the keys, which must be an integer; it need not be named if there is one key.

    With ``split_rows`` a bucket of more rows than that is split alone, by more bits of its keys' hash, while the others
    stay: the choice for tables that grow without growing ids. Small buckets share directories, which are rewritten together.

    ``unique`` says that the source holds one row per key, as a primary key does. Whole rows of a batch are then not
    searched for older copies of a key, only the keys are checked. Leave it off for feeds of changes.

    ``inclusive`` pulls the rows at the high-water mark again at each load, ``cap_at`` leaves out rows stamped later.
    """

    name: str
    keys: tuple[str, ...]
    incremental: bool = False
    natural_key: str | None = None
    updated_at: str = "updated_at"
    buckets: int = 8
    id_range: int | None = None
    range_key: str | None = None
    unique: bool = False
    split_rows: int | None = None
    inclusive: bool = False
    cap_at: str | None = None

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"{self.name}: a table needs at least one key column")
        if self.id_range is not None and self.range_key is None:
            if len(self.keys) != 1:
                raise ValueError(f"{self.name}: name the range_key among the keys")
            object.__setattr__(self, "range_key", self.keys[0])
        if self.range_key is not None and self.range_key not in self.keys:
            raise ValueError(f"{self.name}: range_key must be one of the keys")
        if self.split_rows is not None and (self.id_range is not None or self.split_rows < 1):
            raise ValueError(f"{self.name}: split_rows is positive and goes without id_range")
        if self.buckets < 1:
            raise ValueError(f"{self.name}: buckets must be positive")


def by_name(specs: list[TableSpec]) -> dict[str, TableSpec]:
    """Index specs by table name; a name declared twice is an error."""
    index = {spec.name: spec for spec in specs}
    if len(index) != len(specs):
        raise ValueError("a table is declared twice")
    return index
