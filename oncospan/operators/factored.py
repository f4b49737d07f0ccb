"""Many-to-many links on equal keys, kept factorised.

N rows and M partners of one key are N x M links. ``FactoredLinks`` keeps the two sides and one group row per key, so its
tables grow with N + M; counts of links come from the groups alone. ``expand`` writes the links out for who wants them:
a key with many links is cut into tiles of at most about ``tile_rows`` rows and partners, so that its links are made by
many tasks. Keys with few links, found by the counts, join directly.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE_ROWS = 512


class FactoredLinks:
    """``rows`` linked to ``partners`` that share ``keys`` (same names on both sides). Null keys link with nothing."""

    def __init__(self, rows: DataFrame, partners: DataFrame, keys: list[str], tile_rows: int = TILE_ROWS):
        clash = (set(rows.columns) & set(partners.columns)) - set(keys)
        if clash:
            raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
        self.rows, self.partners, self.keys, self.tile_rows = rows, partners, list(keys), tile_rows

    def _sizes(self, df: DataFrame, name: str) -> DataFrame:
        known = df.filter(" and ".join(f"`{k}` is not null" for k in self.keys))
        return known.groupBy(*self.keys).agg(F.count("*").alias(name))

    @cached_property
    def groups(self) -> DataFrame:
        """One row per key that both sides hold: n_rows, n_partners, n_links."""
        both = self._sizes(self.rows, "n_rows").join(self._sizes(self.partners, "n_partners"), self.keys)
        return both.withColumn("n_links", F.col("n_rows") * F.col("n_partners"))

    def _blocks(self, count: str) -> Column:
        return F.ceil(F.col(count) / self.tile_rows).cast("int")

    def expand(self) -> DataFrame:
        """Rows with the columns of each partner; a row without a partner stays, its partner's columns null."""
        heavy = self.groups.filter(F.col("n_links") > self.tile_rows * self.tile_rows).select(
            *self.keys, self._blocks("n_rows").alias("_row_blocks"), self._blocks("n_partners").alias("_partner_blocks"))

        def tiled(df: DataFrame, own: str, other: str) -> DataFrame:
            """Rows of heavy keys, each in a block of its own side and listed for every block of the other."""
            block = F.pmod(F.xxhash64(*df.columns), F.col(f"{own}_blocks")).cast("int").alias(own)
            every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other)
            return df.join(heavy, self.keys).select(*df.columns, block, every)

        light = self.rows.join(heavy.select(*self.keys), self.keys, "left_anti").join(self.partners, self.keys, "left")
        tiles = tiled(self.rows, "_row", "_partner").join(tiled(self.partners, "_partner", "_row"),
                                                         [*self.keys, "_row", "_partner"])
        columns = [*self.rows.columns, *(c for c in self.partners.columns if c not in self.keys)]
        return light.select(*columns).unionByName(tiles.select(*columns))
