"""Items bought together as neighbour lists, and recommendations from a user's candidates.

Baskets shrink to distinct sets of items, pairs are counted once per set, and each item keeps a short list of its
closest others. A user's candidates are the lists of what the user bought; no user is scored against all
items. Similarities are whole millionths, so that ties are ties wherever they are computed.

What is wide is moved narrow: an item's count goes to its baskets and not to its pairs, a pair is counted in one
direction, and a list travels to its users as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.session import stored

MILLION = 1_000_000
#: Others that an item keeps.
NEIGHBOURS = 10
#: Share of all purchases from which a user's candidates are spread over tasks.
BUSY = 0.001


def pair_counts(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """(item, other, together, baskets, others) once for each pair, ``item`` being the smaller.

    Equal baskets become one row with a count before pairs are formed; a basket of b items gives b (b - 1) / 2 pairs.
    ``baskets`` and ``others`` are the baskets of either item: members carry them, so no row of a pair meets them.
    """
    sets = lines.where(F.col(item).isNotNull()).groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))
    sets = stored(sets.groupBy("items").agg(F.min(basket).alias("_set"), F.count(F.lit(1)).alias("n")), "baskets")
    singles = sets.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("baskets"))
    members = sets.where(F.size("items") > 1).select("_set", "n", F.explode("items").alias("item")).join(singles, "item")
    sized = members.groupBy("_set").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("item", "baskets"))).alias("m"))
    later = F.slice("m", F.col("at") + 2, F.size("m"))
    return (
        sized.select("n", "m", F.posexplode("m").alias("at", "x"))
        .select("n", "x", F.explode(later).alias("y"))
        .groupBy(F.col("x.item").alias("item"), F.col("y.item").alias("other"))
        .agg(F.sum("n").alias("together"), F.max("x.baskets").alias("baskets"), F.max("y.baskets").alias("others"))
    )


def neighbour_lists(lines: DataFrame, basket: str, item: str, most: int = NEIGHBOURS) -> DataFrame:
    """(item, other, similarity): the ``most`` closest others of each item, by the cosine of their baskets.

    ``similarity`` is in whole millionths; ties go to the smaller item. The cut to ``most`` is made before
    the rows of an item meet, so a popular item brings ``most`` rows from each task and no more.
    """
    cosine = F.col("together") / F.sqrt((F.col("baskets") * F.col("others")).cast("double"))
    counted = pair_counts(lines, basket, item).select("item", "other", F.floor(cosine * MILLION).alias("similarity"))
    both = F.array(F.struct("item", "other"), F.struct(F.col("other").alias("item"), F.col("item").alias("other")))
    close = counted.select(F.explode(both).alias("p"), "similarity").select("p.item", "p.other", "similarity")
    order = Window.partitionBy("item").orderBy(F.desc("similarity"), "other")
    return close.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most).drop("_place")


def busy_users(owned: DataFrame) -> list:
    """Users that may hold ``BUSY`` of the rows: all of those, and at most 1 / ``BUSY`` in all."""
    return [u for u in owned.stat.freqItems(["_user"], BUSY).first()[0] if u is not None]


def recommend(history: DataFrame, neighbours: DataFrame, user: str, item: str, top: int = 5) -> DataFrame:
    """(user, place, item, score, because): the best items that a user has not bought.

    A candidate scores as its closest tie to anything the user bought, which ``because`` names (the smaller item
    of several). What a user owns enters the same aggregate as the candidates and takes them out there. With lists
    of n others an item can be missed only if n - ``top`` or more of a list are already the user's. A user's lists are opened
    where the user's rows meet; those of a busy user are opened before, and meet by candidate first.
    """
    owned = stored(history.where(F.col(item).isNotNull()).select(F.col(user).alias("_user"), F.col(item).alias("item")).distinct(), "owned")
    lists = neighbours.groupBy("item").agg(F.collect_list(F.struct("other", (-F.col("similarity")).alias("far"))).alias("l"))
    lists = stored(lists.select("item", F.col("l.other").alias("_others"), F.col("l.far").alias("_fars")), "lists")
    busy = F.coalesce(F.col("_user").isin(busy_users(owned)), F.lit(False))
    held = owned.join(lists, "item", "left")
    quiet, spread = held.where(~busy).repartition("_user"), held.where(busy)
    return _best(_ties(quiet), user, item, top).unionByName(_best(_ties(spread), user, item, top))


def _ties(held: DataFrame) -> DataFrame:
    """(_user, _item, _tie) of all candidates, and without a tie what the user owns."""
    pairs = F.arrays_zip(F.col("_others").alias("other"), F.col("_fars").alias("far"))
    own = F.struct(F.col("item").alias("other"), F.lit(None).cast(held.schema["_fars"].dataType.elementType).alias("far"))
    opened = held.select("_user", "item", F.explode(F.concat(F.array(own), F.coalesce(pairs, F.array().cast(held.select(pairs).schema[0].dataType)))).alias("c"))
    # the far tie first, so that the least struct is the closest and of the smallest item
    tie = F.when(F.col("c.far").isNotNull(), F.struct(F.col("c.far").alias("far"), F.col("item").alias("because")))
    return opened.select("_user", F.col("c.other").alias("_item"), tie.alias("_tie"))


def _best(ties: DataFrame, user: str, item: str, top: int) -> DataFrame:
    scored = ties.groupBy("_user", "_item").agg(F.min("_tie").alias("_tie"), F.bool_or(F.col("_tie").isNull()).alias("_owned"))
    order = Window.partitionBy("_user").orderBy("_tie.far", "_item")
    return (
        scored.where(~F.col("_owned"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= top)
        .select(F.col("_user").alias(user), "place", F.col("_item").alias(item), (-F.col("_tie.far") / MILLION).alias("score"), F.col("_tie.because").alias("because"))
    )
