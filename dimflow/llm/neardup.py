"""Near-duplicate documents by b-bit MinHash, with exact confirmation on whole shingle sets.

1. One pass gives each document its set's size and digest, 128 minima, of which the low 4 bits are
   packed into bit planes, and 25 band keys of 5 minima each. Documents with equal sets form a class, and
   only classes go on, so copies cost nothing.
2. Classes that share a band key are compared with one leader of the key's bucket. XOR and a bit count
   over the packed planes give the share of equal low bits; corrected for chance collisions it estimates the
   similarity, and only pairs not clearly below the limit go on.
3. Pairs are confirmed on the full sets, and the links' connected components are found.
4. Two star rounds with other leaders join most of what belongs together. What is then left in a
   bucket outside its largest component is compared with every other member of that bucket that lies in
   another component, in blocks and on full sets. After that no candidate pair of two components is
   unchecked; pairs inside one component cannot change the result and are never made.

A pair of similarity s is no candidate with probability (1 - s^5)^25, 4e-7 at 0.85 and 5e-5 at 0.80, and a candidate
at the limit is set aside wrongly with ``MISSED`` at most, by the exact binomial tail; both fall fast above the limit.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import query, table
from dimflow.llm.components import components
from dimflow.llm.shingles import mix, shingle_sets
from dimflow.session import materialise

MINIMA, BITS, BANDS, ROWS = 128, 4, 25, 5
MISSED = 1e-7
STAR_ROUNDS = 2
_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 2048
_BLOCK_MEMBERS = 512


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        np.minimum(least, np.multiply.outer(_FACTORS, shingles[at : at + _BLOCK]).min(axis=1), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima as bit planes: two 64-bit words for each of the bits kept."""
    low = mix(least)
    planes = [np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(BITS)]
    return np.concatenate(planes).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key for each band of minima; keys of different bands differ."""
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        keys = mix(keys * np.uint64(31) + rows[:, j])
    return keys.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, text_col: str, carry: list[str], size: int) -> DataFrame:
    """``carry`` columns with ``n_shingles``, ``digest``, ``planes`` and ``bands``; the last three null for empty sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, planes, bands = [], [], [], []
            for found in shingle_sets(batch.column(len(carry)), size):
                n.append(len(found))
                least = minima(found) if len(found) else None
                digests.append(None if least is None else _digest(found))
                planes.append(None if least is None else packed(least))
                bands.append(None if least is None else band_keys(least))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carry)], pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(planes, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                names=[*carry, "n_shingles", "digest", "planes", "bands"],
            )

    chosen = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text_col}`").cast("string").alias("_text"))
    fields = [T.StructField(f.name, f.dataType) for f in chosen.schema.fields[:-1]]
    long_list = T.ArrayType(T.LongType())
    made = [("n_shingles", T.LongType()), ("digest", T.BinaryType()), ("planes", long_list), ("bands", long_list)]
    return chosen.mapInArrow(work, T.StructType(fields + [T.StructField(n, t) for n, t in made]))


def full_sets(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """``digest`` and the whole set, as the bytes of its sorted hashes, of every document that has one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for s in shingle_sets(batch.column(0), size) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                names=["digest", "shingles"],
            )

    return docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(work, "digest binary, shingles binary")


def estimate(left: str, right: str) -> Column:
    """Similarity from two signatures' equal low bits, corrected for bits that agree by chance."""
    words = MINIMA // 64
    unequal = F.lit(0)
    for w in range(words):
        mask = F.lit(0).cast("long")
        for b in range(BITS):
            mask = mask.bitwiseOR(F.expr(f"{left}[{b * words + w}]").bitwiseXOR(F.expr(f"{right}[{b * words + w}]")))
        unequal = unequal + F.bit_count(mask)
    chance = 2.0**-BITS
    return ((1 - unequal / MINIMA) - chance) / (1 - chance)


def lowest_estimate(percent: int) -> float:
    """The estimate below which a pair at the limit falls with a chance of ``MISSED`` at most.

    How many of the minima's low bits are equal is binomial: a pair with fewer than the number whose tail stays below that
    chance is set aside.
    """
    chance = 2.0**-BITS
    equal = percent / 100 * (1 - chance) + chance
    tail, least = 0.0, 0
    while (tail := tail + math.comb(MINIMA, least) * equal**least * (1 - equal) ** (MINIMA - least)) <= MISSED:
        least += 1
    return ((least - 0.5) / MINIMA - chance) / (1 - chance)  # half way to the count below


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with 100 * intersection >= percent * union on their full sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("right"))
    left = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("left"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return joined.mapInArrow(work, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, size: int = 5, percent: int = 80, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col``, ``carry``, ``n_shingles``, ``component_id`` and ``kept``, one row for each document.

    Documents are linked from ``percent`` per cent of common shingles of ``size`` words on;
    ``component_id`` is the least id reachable over links and ``kept`` says whether that is the document's own.
    A null or wordless text has ``n_shingles`` 0, its own id as component, and is kept. Null ids come
    last: they are the component only where no member has an id. Rows with the same id and text get the
    same result; rows with the same id and other texts are judged by their texts. Other columns of ``docs``
    are not looked at, so their names don't matter.
    """
    names = list(dict.fromkeys([id_col, *carry]))
    found = materialise(signatures(docs, text_col, names, size), "signatures")
    classes = found.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(id_col).alias("least"), F.first("planes").alias("planes"), F.first("bands").alias("bands")
    )
    classes = materialise(classes, "classes")
    keyed = classes.select("digest", F.explode("bands").alias("key"))
    shared = materialise(keyed.groupBy("key").count().where("count > 1").select("key"), "shared")
    members = materialise(keyed.join(shared, "key").join(classes.select("digest", "planes"), "digest"), "members")
    wanted = materialise(members.select("digest").distinct().join(classes.select("digest", "least"), "digest"), "wanted")
    wanted = wanted.select(F.col("least").alias("_least")).distinct()
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    sets = full_sets(rows.join(wanted, F.col("_id").eqNullSafe(F.col("_least")), "left_semi"), "_text", size)
    sets = materialise(sets.dropDuplicates(["digest"]), "sets")  # rows that repeat an id, or have none, give one set

    lowest, links, labels = lowest_estimate(percent), None, None
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            placed = members.withColumn("component", F.col("digest"))
        else:
            known = labels.withColumnRenamed("node", "digest")
            placed = members.join(known, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
            placed = materialise(placed, "placed")
        if turn < STAR_ROUNDS:
            more = confirmed(materialise(_star(placed, turn, lowest), "pairs"), sets, percent)
        else:
            more = _across(placed, sets, lowest, percent)
        links = materialise(more if links is None else links.unionAll(more), "confirmed")
        labels = components(links)

    merged = classes.select("digest", "least").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    merged = merged.withColumn("component", F.coalesce("component", "digest"))
    heads = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    heads = materialise(heads, "heads")
    heads = materialise(merged.join(heads, "component").select("digest", "component_id"), "heads")
    own = F.when(F.col("digest").isNull(), F.col(f"`{id_col}`")).otherwise(F.col("component_id"))
    result = found.join(heads, "digest", "left").withColumn("component_id", own)
    return result.select(*names, "n_shingles", "component_id", F.col(id_col).eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str, text_col: str, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one document left of each group: that of the least id.

    Of rows that repeat the id and the text one stays. Documents without words belong to no group and all stay.
    """
    key = [F.col(f"`{id_col}`").alias("_id"), F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("_md5")]
    rows = docs.select(F.struct("*").alias("row"), *key)
    keyed = docs.select(*key, F.col(f"`{text_col}`").alias("_text"))
    found = near_duplicates(keyed, "_id", "_text", size, percent, carry=("_md5",))
    wordless = F.col("n_shingles") == 0
    keep = materialise(found.where("kept").select(F.col("_id").alias("id"), F.col("_md5").alias("md5"), wordless.alias("wordless")).distinct(), "kept")
    # One row of each key, by the row's number within its key: keys are spread, and only exact repeats share one.
    joined = rows.join(keep, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_md5") == F.col("md5")))
    first = F.row_number().over(Window.partitionBy("id", "md5").orderBy(F.lit(1))) == 1
    return joined.withColumn("first", first).where("first OR wordless").select("row.*")


def _oriented(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _star(placed: DataFrame, turn: int, lowest: float) -> DataFrame:
    """Each member of a bucket with the bucket's leader, where they lie in different components."""
    leader = F.min(F.struct(F.xxhash64("digest", F.lit(turn)), "digest", "planes", "component")).alias("leader")
    leaders = materialise(placed.groupBy("key").agg(leader).select("key", "leader.*").drop("col1"), "leaders")
    leaders = leaders.toDF("key", "lead", "lead_planes", "lead_component")
    apart = placed.join(leaders, "key").where("component <> lead_component")
    return apart.where(estimate("planes", "lead_planes") >= lowest).select(*_oriented("digest", "lead")).distinct()


def _across(placed: DataFrame, sets: DataFrame, lowest: float, percent: int) -> DataFrame:
    """Links between components: members outside their bucket's largest component with all others there.

    Semi-joins first leave only members with a promising partner. What is left of a bucket is cut into blocks,
    and each pair of blocks is compared on full sets in one place. Only one link is returned for a
    document and a component, so no list of pairs comes to be, however many there are.
    """
    counts = placed.groupBy("key", "component").count()
    split = counts.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("count", "component")).alias("main")
    )
    split = materialise(split.where("parts > 1").select("key", "main"), "split")
    rest = materialise(placed.join(split, "key"), "rest")
    outer = rest.where("component <> main").select("key", "digest", "planes", "component")
    inner = rest.select("key", "digest", "planes", "component")

    def promising(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select("key", *[F.col(c).alias(f"y_{c}") for c in ("planes", "component")])
        near = (F.col("component") != F.col("y_component")) & (estimate("planes", "y_planes") >= lowest)
        return left.join(right.withColumnRenamed("key", "y_key"), (F.col("key") == F.col("y_key")) & near, "left_semi")

    outer = materialise(promising(outer, inner), "outer")
    inner = materialise(promising(inner, outer), "inner")
    blocks = {side: df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / _BLOCK_MEMBERS).alias(f"{side}_blocks")) for side, df in (("x", outer), ("y", inner))}
    grid = materialise(blocks["x"].join(blocks["y"], "key"), "grid")

    def spread(df: DataFrame, own: str, other: str) -> DataFrame:
        at = F.pmod(F.xxhash64("digest"), F.col(f"{own}_blocks")).alias(own)
        all_others = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1)).alias(other)
        placed_in = df.join(grid, "key").select("key", "digest", "component", at, all_others)
        return placed_in.select("key", "x", "y", F.lit(own).alias("side"), "digest", "component")

    cells = spread(outer, "x", "y").unionAll(spread(inner, "y", "x")).join(sets, "digest")
    cells = cells.select("key", "x", "y", "side", "digest", "component", "shingles")
    cells = cells.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {"x": [], "y": []}
        for batch in batches:
            for key, x, y, side, *member in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, x, y) != cell:
                    yield _linked(held["x"], held["y"], percent)
                    cell, held = (key, x, y), {"x": [], "y": []}
                held[side].append(member)
        yield _linked(held["x"], held["y"], percent)

    return cells.mapInArrow(work, "a binary, b binary")


def _linked(left: list, right: list, percent: int) -> pa.RecordBatch:
    """For each member of ``left`` one link to each other component of ``right`` that it is similar enough to."""
    a, b = [], []
    if left and right:
        sets = [np.frombuffer(m[2], np.uint64) for m in right]
        sizes = np.array([len(s) for s in sets])
        values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        parts = [m[1] for m in right]
        for digest, component, raw in left:
            own = np.frombuffer(raw, np.uint64)
            starts, ends = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            runs = ends - starts
            at = np.repeat(starts - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
            common = np.bincount(owners[at], minlength=len(sets))
            found = np.flatnonzero(100 * common >= percent * (len(own) + sizes - common))
            for i in {parts[i]: i for i in found if parts[i] != component}.values():
                a.append(min(digest, right[i][0]))
                b.append(max(digest, right[i][0]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


@query
def op1_near_duplicates(spark, sf_dir):
    """Links from 85 per cent of common 3-word shingles on."""
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", size=3, percent=85)
