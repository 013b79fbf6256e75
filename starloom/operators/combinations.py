"""One key for a combination of values of small vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_COMBINATIONS = 100_000
MAX_VALUES = 100


class Combinations:
    """All combinations of a few vocabularies, keyed 0, 1, 2, … by mixed radix.

    The key is an expression of the values and the values are expressions of the key, so a fact needs
    no join to get its key and a report on keys needs none to get the values. NULL is the first value
    of every vocabulary. A value outside its vocabulary fails the query: it has no key.
    """

    def __init__(self, vocabularies: Mapping[str, Sequence]):
        self.vocabularies = {name: list(values) for name, values in vocabularies.items()}
        sizes = [len(values) + 1 for values in self.vocabularies.values()]
        self.size = prod(sizes)
        if self.size > MAX_COMBINATIONS:
            raise ValueError(f"{self.size} combinations are too many for one dimension")
        self._radix = {name: prod(sizes[place + 1:]) for place, name in enumerate(self.vocabularies)}

    def key(self, **values: Column) -> Column:
        """The key of a combination; all names must be given."""
        if set(values) != set(self.vocabularies):
            raise ValueError(f"expected {sorted(self.vocabularies)}, not {sorted(values)}")
        return sum((self._slot(name, values[name]) * radix for name, radix in self._radix.items()), F.lit(0).cast("bigint"))

    def _slot(self, name: str, value: Column) -> Column:
        place = F.array_position(self._array(name), value)
        unknown = F.raise_error(F.concat(F.lit(f"no {name} in the vocabulary: "), value.cast("string")))
        return F.when(value.isNull(), F.lit(0)).when(place == 0, unknown.cast("bigint")).otherwise(place).cast("bigint")

    def _array(self, name: str) -> Column:
        return F.array(*[F.lit(value) for value in self.vocabularies[name]])

    def value(self, name: str, key: str) -> Column:
        """The value of ``name`` behind a key."""
        slot = F.expr(f"CAST({key} div {self._radix[name]} % {len(self.vocabularies[name]) + 1} AS INT)")
        return F.get(self._array(name), slot - 1).alias(name)

    def with_values(self, df: DataFrame, key: str) -> DataFrame:
        return df.select("*", *[self.value(name, key) for name in self.vocabularies])

    def dimension(self, spark: SparkSession, key: str) -> DataFrame:
        """The table of all combinations."""
        return self.with_values(spark.range(0, self.size, 1, 1).withColumnRenamed("id", key), key)


def vocabulary(df: DataFrame, column: str, max_values: int = MAX_VALUES) -> list:
    """The distinct values of a column in order, without NULL; fails above ``max_values``. Runs a job."""
    found = df.where(F.col(column).isNotNull()).groupBy(column).count().select(column).limit(max_values + 1).collect()
    if len(found) > max_values:
        raise ValueError(f"{column} has more than {max_values} values: it is no vocabulary")
    return sorted(row[0] for row in found)
