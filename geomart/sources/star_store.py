"""The star in versioned tables: whole refreshes and appended batches, each checked before it is seen."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from geomart.operators.star import DIMENSION_KEYS, LOAD_ORDER, check_star, new_rows
from geomart.sources.versions import CommitConflict, Version, VersionedTables


class StarStore(VersionedTables):
    """Writers stage folders, check the keys of what would be there, and commit one version for all tables."""

    def load(self, tables: Mapping[str, DataFrame]) -> list[str]:
        """Full refresh of the tables that are given and have rows; the names of these.

        Staged tables are written once, straight to where they stay. A refresh that breaks a key of the star is
        refused, and until the commit readers see the star as it was.
        """
        old = self.version()
        given = {n: self.stage(n, tables[n]) for n in LOAD_ORDER if n in tables}
        staged = {n: sp for n, sp in given.items() if sp[1].rows}
        seen = {n: self.staged(s, (p,)) for n, (s, p) in given.items()}
        seen |= {n: self.read(n, old) for n in old.tables if n not in staged}
        check_star(seen)
        tops = {n: k for n, k in self.tops(seen).items() if n in staged}
        self.replace(staged, tops)
        return list(staged)

    @staticmethod
    def tops(tables: Mapping[str, DataFrame]) -> dict[str, int]:
        """The highest key of each numbered dimension."""
        return {n: tables[n].agg({k: "max"}).first()[0] or 0 for n, k in DIMENSION_KEYS.items() if n in tables and k in tables[n].columns}

    def append(self, batch: DataFrame, batch_id: str, attempts: int = 3) -> bool:
        """Add the listings of a batch; False (and nothing written) if a batch of this id is in the star already.

        Only rows that are new are written: members the dimensions lack, with keys above the highest one ever given
        out, and the batch's facts. The key ranges are reserved by the same commit that shows the rows. A batch
        that breaks a key is refused whole. If another writer commits first, the batch is made again
        on what that one left, ``attempts`` times at most.
        """
        for left in range(attempts, 0, -1):
            old = self.version()
            if batch_id in old.batches:
                return False
            rows = new_rows(batch, {n: self.read(n, old) for n in LOAD_ORDER}, old.top)
            try:
                self.commit(self.grown(old, rows, batch_id))
                return True
            except CommitConflict:
                if left == 1:
                    raise
        return False

    def grown(self, old: Version, rows: Mapping[str, DataFrame], batch_id: str) -> Version:
        """The version after ``old`` with the rows staged and their keys reserved for the batch."""
        tables, top, ranges = dict(old.tables), dict(old.top), {}
        for name in LOAD_ORDER:
            schema, part = self.stage(name, rows[name])
            if not part.rows:
                continue
            tables[name] = (tables[name][0], (*tables[name][1], part))
            if name in DIMENSION_KEYS:
                ranges[name] = (top[name] + 1, top[name] + part.rows)
                top[name] += part.rows
        return replace(old, number=old.number + 1, tables=tables, top=top, batches=old.batches | {batch_id: ranges})
