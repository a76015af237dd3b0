"""Intermediate results that several reports over the same tables have in common."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Mapping

from pyspark.sql import DataFrame

from .scratch import materialise


class Shared(Mapping[str, DataFrame]):
    """Tables for several reports of one run.

    A report that comes to an intermediate result which an earlier report over the same ``Shared`` has made, from the same
    parameters, goes on from that one's written table. The results go with the object: other tables, or the same ones
    at a later time, are another ``Shared``.
    """

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = dict(tables)
        self._made: dict[tuple, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def once(self, name: str, params: tuple[Hashable, ...], build: Callable[[], DataFrame]) -> DataFrame:
        key = (name, *params)
        if key not in self._made:
            self._made[key] = materialise(build(), name)
        return self._made[key]


def shared(
    tables: Mapping[str, DataFrame],
    name: str,
    params: tuple[Hashable, ...],
    build: Callable[[], DataFrame],
    write: bool = False,
) -> DataFrame:
    """What ``build`` makes of ``tables`` and ``params``: written once for all reports over a :class:`Shared`; for a report
    of its own, written if it uses it several times itself (``write``), else a part of its plan."""
    if isinstance(tables, Shared):
        return tables.once(name, params, build)
    return materialise(build(), name) if write else build()
