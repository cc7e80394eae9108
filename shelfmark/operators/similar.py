"""Names that are nearly the same: an exact set-similarity join on character trigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import stored

PERCENT = 60


def trigrams(name: Column) -> Column:
    """The different runs of three characters of the lower-cased name between two blanks on each side."""
    padded = F.concat(F.lit("  "), F.lower(name), F.lit("  "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def _ordered(names: DataFrame) -> DataFrame:
    """(name, size, grams): different names, their trigrams from the rarest to the most common one.

    Trigrams are counted before they are joined back, so a common one is one row on that side and the
    adaptive skew join splits the other.
    """
    cut = stored(names.select(F.explode(trigrams(F.col("name"))).alias("gram"), "name"), "trigrams")
    counts = cut.groupBy("gram").agg(F.count("*").alias("n"))
    ranked = cut.join(counts, "gram").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("ranked"))
    return ranked.select("name", F.size("ranked").alias("size"), F.transform("ranked", lambda x: x["gram"]).alias("grams"))


def similar_names(left: DataFrame, column: str, percent: int = PERCENT) -> DataFrame:
    """(a, b, shared, total): all pairs of different names, a before b, whose trigrams have that in common.

    ``shared`` is the size of the intersection and ``total`` of the union of both sets: a pair is given if
    100 * shared >= percent * total (percent from 1 to 100). Nulls and repeated names count once or not
    at all, so copies make no pairs; join the pairs back by name.

    No two names are compared without need. With trigrams in one order, rarest first, a pair that is
    similar enough shares one among the first few of both (prefix filter), their sizes differ by no
    more than the similarity allows (length filter), and what is left of both after the shared one must
    reach the overlap needed (position filter). A pair is made at the first trigram that both prefixes
    share, so it is made once.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be between 1 and 100")
    names = left.select(F.col(column).alias("name")).where("name is not null").distinct()
    sets = stored(_ordered(names), "trigram-sets")
    # all but the last (least overlap - 1) trigrams: ceil(percent / 100 * size) are shared at least
    prefix = F.col("size") - F.ceil(F.col("size") * percent / 100).cast("int") + 1
    firsts = sets.select("name", "size", "grams", F.posexplode(F.slice("grams", F.lit(1), prefix)).alias("at", "gram"), prefix.alias("prefix"))
    a, b = firsts.alias("a"), firsts.alias("b")
    small, large = F.col("a.size"), F.col("b.size")
    before = (small < large) | ((small == large) & (F.col("a.name") < F.col("b.name")))  # the smaller set first
    met = a.join(b, F.col("a.gram") == F.col("b.gram")).where(before & (small * 100 >= large * percent))
    rest = F.least(small - F.col("a.at"), large - F.col("b.at"))  # the shared trigram and what follows it
    met = met.where(rest * (100 + percent) >= percent * (small + large))
    common = F.array_intersect(F.slice("a.grams", F.lit(1), F.col("a.prefix")), F.slice("b.grams", F.lit(1), F.col("b.prefix")))
    met = met.where(F.get(common, F.lit(0)) == F.col("a.gram"))
    met = met.select(
        F.least("a.name", "b.name").alias("a"), F.greatest("a.name", "b.name").alias("b"),
        F.size(F.array_intersect("a.grams", "b.grams")).alias("shared"), (small + large).alias("both"),
    )
    found = met.select("a", "b", "shared", (F.col("both") - F.col("shared")).alias("total"))
    return found.where(100 * F.col("shared") >= percent * F.col("total"))
