"""Search by ingredient over a stored inverted index: ingredient -> recipes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def bucket_of(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


class IngredientIndex:
    """Postings (ingredient, recipe keys) below ``place``, in folders by the bucket of the ingredient.

    A question reads the folders of the ingredients it names, and in them the row
    groups whose range holds the name, since files are sorted by it. The number
    of buckets is part of the index and must be the same for all calls.
    """

    def __init__(self, spark: SparkSession, place: str, keys: Sequence[str] = ("path",), buckets: int = 64):
        self.spark, self.place, self.keys, self.buckets = spark, place.rstrip("/"), list(keys), buckets

    def append(self, lines: DataFrame) -> None:
        """Add recipes: ``lines(keys..., cleaned)``. A recipe that is added again changes nothing.

        A frequent ingredient's bucket is dealt over several writers.
        """
        posting = lines.where("cleaned IS NOT NULL").select(*self.keys, "cleaned").distinct()
        placed = posting.withColumn("bucket", bucket_of(F.col("cleaned"), self.buckets))
        placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "cleaned").write.mode("append").partitionBy("bucket").parquet(
            f"{self.place}/postings")
        lines.select(*self.keys).distinct().write.mode("append").parquet(f"{self.place}/recipes")

    def recipes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.place}/recipes").select(*self.keys).distinct()

    def with_any(self, names: Sequence[str]) -> DataFrame:
        """Recipes with at least one of the ingredients."""
        wanted = [F.col("bucket").isin([bucket_of(F.lit(n), self.buckets) for n in names]), F.col("cleaned").isin(list(names))]
        stored = self.spark.read.parquet(f"{self.place}/postings")
        return stored.where(wanted[0] & wanted[1]).select(*self.keys).distinct()

    def search(self, all_of: Sequence[str] = (), none_of: Sequence[str] = ()) -> DataFrame:
        """Recipes with every ingredient of ``all_of`` and none of ``none_of``."""
        sets = [self.with_any([name]) for name in dict.fromkeys(all_of)]
        found = reduce(DataFrame.intersect, sets) if sets else self.recipes()
        return found.join(self.with_any(none_of), self.keys, "left_anti") if none_of else found
