"""Validity intervals as equi-join keys, for keys with very many of them that may overlap.

Days are cut into a tree: a node of level l covers ``RADIX**l`` successive days. An interval is the union of few nodes, at most
``2 * (RADIX - 1)`` of each level, none of which overlap; a day is in one node of each level. So a fact finds its
intervals by equality of key and node, each once, whatever the intervals' lengths: an interval costs rows by the
logarithm of the days it covers, a fact one row for each level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.operators.dimensions import effective_lookup
from dimflow.session import materialise

RADIX_BITS = 2
RADIX = 1 << RADIX_BITS


def levels_for(days: int) -> int:
    """How many levels above the lowest make one node cover so many days."""
    levels = 0
    while RADIX**levels < days:
        levels += 1
    return levels


def cover(first: Column, last: Column, levels: int) -> Column:
    """The nodes, as an array of (level, node), whose days are ``first`` to ``last``: numbers from 0 to ``RADIX**levels - 1``.

    On each level the nodes are those before the first and after the last that fit into a node of the level above.
    Nothing if last is before first.
    """

    def bounds(level: int) -> tuple[Column, Column]:
        """The nodes of a level that lie inside: from the first to before the second."""
        size = F.lit(RADIX**level)
        return F.ceil(first / size).cast("long"), F.floor((last + 1) / size).cast("long")

    parts = []
    for level in range(levels + 1):
        begin, end = bounds(level)
        up_begin, up_end = bounds(level + 1)
        whole = up_begin < up_end  # some node above is inside, and its children need not be named
        left = _run(level, begin, F.when(whole, up_begin * RADIX).otherwise(end))
        right = _run(level, F.when(whole, up_end * RADIX).otherwise(end), end)
        parts += [left, right]
    return F.concat(*parts)


def _run(level: int, begin: Column, end: Column) -> Column:
    none = F.array().cast("array<struct<level:int,node:bigint>>")
    nodes = F.transform(F.sequence(begin, end - 1), lambda n: F.struct(F.lit(level).alias("level"), n.alias("node")))
    return F.when(begin < end, nodes).otherwise(none)


def nodes_of(day: Column, levels: int) -> Column:
    """The nodes a day is in, one of each level."""
    return F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(day, RADIX_BITS * n).cast("long").alias("node")) for n in range(levels + 1)])


def _number(node: Column) -> Column:
    """Level and node as one number, which a shuffle moves more cheaply."""
    return F.shiftleft(node["level"].cast("long"), 48) + node["node"]


def effective_lookup_deep(
    facts: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    at: str,
    valid_from: str,
    valid_until: str,
    take: dict[str, str],
    fact_id: list[str],
    deep: int = 64,
) -> DataFrame:
    """As ``dimensions.effective_lookup``, for dimensions in which some keys have more than ``deep`` validities.

    Those keys' facts meet their validities by key and node, the others' as before. ``fact_id`` names columns
    that tell the facts of deep keys apart: a fact under none of its key's validities is kept once, with NULLs.
    """
    keys = list(on.values())
    counted = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > deep)
    many = materialise(counted.select(*[F.col(k).alias(f"_deep_{i}") for i, k in enumerate(keys)]), "deep-keys")
    same = [F.col(f) == F.col(f"_deep_{i}") for i, f in enumerate(on)]
    deep_keys = [F.col(k) == F.col(f"_deep_{i}") for i, k in enumerate(keys)]
    # Written, the sizes of both sides of validities are known: they are broadcast only where they are small.
    few = materialise(dim.join(many, deep_keys, "left_anti").select(*dict.fromkeys([*keys, valid_from, valid_until, *take])), "few")
    shallow = effective_lookup(facts.join(many, same, "left_anti"), few, on, at, valid_from, valid_until, take)
    found = materialise(facts.join(many, same, "left_semi"), "deep-facts")
    day = F.to_date(F.col(at))
    span = found.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if span["first"] is None:  # no fact of a deep key has a date
        return shallow.unionByName(found.select("*", *[F.lit(None).cast(dim.schema[c].dataType).alias(n) for c, n in take.items()]))
    first, levels = F.lit(span["first"]), levels_for((span["last"] - span["first"]).days + 1)
    number = lambda c: F.datediff(c, first).cast("long")
    begin = number(F.greatest(F.col(valid_from).cast("date"), first))
    end = number(F.least(F.col(valid_until).cast("date"), F.lit(span["last"])))
    validities = dim.join(many, deep_keys, "left_semi").where(F.col(valid_from).isNotNull() & F.col(valid_until).isNotNull())
    nodes = validities.select(
        *[F.col(k).alias(f"_on_{i}") for i, k in enumerate(keys)], *[F.col(c).alias(n) for c, n in take.items()],
        F.explode(cover(begin, end, levels)).alias("_cover"),
    ).withColumn("_cover", _number(F.col("_cover")))
    nodes = materialise(nodes, "nodes")
    asked = found.where(F.col(at).isNotNull()).withColumn("_node", F.explode(nodes_of(number(day), levels)))
    asked = asked.withColumn("_node", _number(F.col("_node")))
    matched = asked.join(nodes, [*[F.col(f) == F.col(f"_on_{i}") for i, f in enumerate(on)], F.col("_node") == F.col("_cover")])
    matched = materialise(matched.select(*facts.columns, *take.values()), "matched")
    none = found.join(matched.select(*fact_id).distinct(), [found[c].eqNullSafe(matched[c]) for c in fact_id], "left_anti")
    lacking = none.select(*facts.columns, *[F.lit(None).cast(dim.schema[c].dataType).alias(n) for c, n in take.items()])
    return shallow.unionByName(matched).unionByName(lacking)
