"""Tables opened on first use: a report touches only what it reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """Logical table name -> DataFrame, each opened once, when first asked for.

    `manifest` makes the list of what has landed, where the tables are landed snapshots.
    """

    def __init__(
        self,
        openers: Mapping[str, Callable[[], DataFrame]],
        manifest: Callable[[], DataFrame] | None = None,
    ) -> None:
        self._openers = dict(openers)
        self._open: dict[str, DataFrame] = {}
        self.manifest = manifest

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def map(self, change: Callable[[DataFrame], DataFrame]) -> LazyTables:
        """The same tables, each changed when opened."""
        return LazyTables({name: lambda name=name: change(self[name]) for name in self}, self.manifest)
