"""Identity of a dataset and every path and name derived from it."""

from __future__ import annotations

import re
from dataclasses import dataclass

from .paths import qualify


@dataclass(frozen=True)
class DatasetSpec:
    """(datasource, dataset) below three zone roots.

    The roots may be on any Hadoop-readable file system; executors must reach them.
    """

    datasource: str
    dataset: str
    landing: str
    raw: str
    bronze: str
    database: str = "bronze"

    def __post_init__(self) -> None:
        for zone in ("landing", "raw", "bronze"):
            object.__setattr__(self, zone, qualify(getattr(self, zone)))
        for part in (self.landing, self.raw, self.bronze, self.datasource, self.dataset):
            if re.search(r"[*?\[\]{}\\]", part):
                raise ValueError(f"{part!r} has characters that Spark reads as a path pattern")

    # The templates of paths and names below.
    @property
    def landing_dir(self) -> str:
        return f"{self.landing}/{self.datasource}/{self.dataset}"

    @property
    def raw_dir(self) -> str:
        return f"{self.raw}/{self.datasource}/{self.dataset}"

    @property
    def table_dir(self) -> str:
        return f"{self.bronze}/{self.datasource}/{self.dataset}"

    @property
    def checkpoint_dir(self) -> str:
        return f"{self.table_dir}_checkpoint"

    @property
    def schema_dir(self) -> str:
        return f"{self.table_dir}_schema"

    @property
    def manifest_dir(self) -> str:
        return f"{self.table_dir}_manifest"

    @property
    def folders_dir(self) -> str:
        return f"{self.table_dir}_folders"

    @property
    def commits_dir(self) -> str:
        return f"{self.table_dir}_commits"

    @property
    def offsets_dir(self) -> str:
        return f"{self.table_dir}_offsets"

    @property
    def types_dir(self) -> str:
        return f"{self.table_dir}_types"

    @property
    def archive_log_dir(self) -> str:
        return f"{self.table_dir}_archive"

    @property
    def query_name(self) -> str:
        return f"bronze-{self.datasource}-{self.dataset}"

    @property
    def table(self) -> str:
        """Quoted table name; characters the catalog refuses become ``_``."""
        name = re.sub(r"\W", "_", f"{self.datasource}_{self.dataset}")
        return f"`{self.database}`.`{name}`"
