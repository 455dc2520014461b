"""Benchmark passages in training texts, exact and near, found through a positional inverted index.

1. Every item is cut into its distinct windows (``window`` words, or the whole of a shorter item). A window may
   miss a fifth of its words and still be near, so it is looked up by its rarest words in the training
   texts, two more than it may miss: two of them must stand in any match.
2. The index keeps the postings of these words: for a term and a document the sorted positions.
3. Two of a window's words form a pair: their terms and their distance. Windows with the same pair share it, so
   an item of one repeated word has a handful. Where both lists of a document, adjusted by the distance, meet
   within the slop, the windows of the pair are candidates there. Lists are intersected, never joined position by position.
4. A candidate is read word by word. Exact: the window stands in full, and its words are hit. Near: at some start
   all its words but a fifth stand within ``slop`` places of their own.

Both kinds are whole: the pairs lose no exact and no near match. All steps are joins and aggregates on terms and
documents. Spark decides by written sizes what to broadcast; the candidates of documents are weighed first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import query, table
from dimflow.session import materialise

#: The bytes between words, after A-Z are lower-cased: all of ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: How many places from its own a word of a near match may stand.
SLOP = 2
#: Words, ids and starts of candidates that may be sent to every executor: some 16 MB.
BROADCAST_VALUES = 500_000
KEY = ("_hash", "_id")


def words_of(text: Column) -> Column:
    """The words of a text, in a form that compares like the lower-cased words.

    Only A-Z are to be lower-cased, which Spark's ``lower`` does not promise. So the UTF-8 bytes are taken as
    Latin-1 characters first. ``lower`` then also changes lead bytes, C0-DE to E0-FE, but the number of
    continuation bytes that follow still tells which it was: different words stay different.
    """
    bytes_ = F.decode(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"), "ISO-8859-1")
    return F.array_remove(F.split(F.lower(bytes_), BETWEEN), "")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def allowed(length: Column) -> Column:
    """How many words of a window a near match may lack: a fifth, so none of a window of fewer than five."""
    return F.floor(length / 5).cast("int")


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """One row for each distinct window: ``window`` (its row), ``words``, ``item_ids`` as text. Null ids are not listed."""
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("string").alias("item_id"), words_of(F.col(f"`{text_col}`")).alias("_words")
    )
    items = items.where(F.size("_words") > 0).withColumn("_len", F.least(F.size("_words"), F.lit(window)))
    cuts = F.transform(F.sequence(F.lit(1), F.size("_words") - F.col("_len") + 1), lambda i: F.slice("_words", i, F.col("_len")))
    items = items.select("item_id", F.explode(F.array_distinct(cuts)).alias("words"))
    windows = items.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
    return materialise(windows.select(F.monotonically_increasing_id().alias("window"), "words", "item_ids"), "windows")


def window_pairs(docs: DataFrame, text_col: str, windows: DataFrame, near: bool = True) -> DataFrame:
    """``first, second, apart, window, place``: the pairs of terms that a window is looked up by; one pair if not ``near``.

    ``apart`` is the distance of the two in the window, ``place`` that of the first. A window of one word is
    paired with itself. Terms that the training texts lack make no pair; a window with too many of them has none.
    """
    terms = materialise(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    used = docs.select(F.explode(words_of(F.col(f"`{text_col}`"))).alias("term")).join(terms, "term")
    counts = materialise(used.groupBy("term").agg(F.count(F.lit(1)).alias("uses")), "uses")
    placed = windows.select("window", F.posexplode("words").alias("place", "term")).join(counts, "term", "left")
    ranked = placed.groupBy("window").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "place", "term"))).alias("ranked")
    )
    rarest = ranked.select("window", F.slice("ranked", F.lit(1), (allowed(F.size("ranked")) if near else F.lit(0)) + 2).alias("r"))

    def pair(x: Column, y: Column) -> Column:
        apart = (y["place"] - x["place"]).alias("apart")
        return F.struct(x["term"].alias("first"), y["term"].alias("second"), apart, x["place"].alias("place"))

    several = F.flatten(F.transform("r", lambda x, i: F.transform(F.slice("r", i + 2, F.size("r")), lambda y: F.when((x["uses"] > 0) & (y["uses"] > 0), pair(x, y)))))
    alone = F.transform("r", lambda x: F.when(x["uses"] > 0, pair(x, x)))
    pairs = F.array_compact(F.when(F.size("r") > 1, several).otherwise(alone))
    return materialise(rarest.select("window", F.explode(pairs).alias("p")).select("p.*", "window"), "pairs")


def postings(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """The index: ``_hash, _id, term, positions`` for the terms asked for.

    The hash comes first in all keys: rows of a document lie together, and a number is what Spark sorts fastest.
    """
    words = docs.select(*doc_key(id_col, text_col), F.posexplode(words_of(F.col(f"`{text_col}`"))).alias("at", "term"))
    found = words.join(materialise(terms.distinct(), "terms"), "term")
    lists = found.groupBy(*KEY, "term").agg(F.sort_array(F.collect_set("at")).alias("positions"))
    return materialise(lists, "postings")


def doc_key(id_col: str, text_col: str) -> list[Column]:
    """What tells documents apart: the id, and a hash of the text where an id comes up twice or is null."""
    text = F.col(f"`{text_col}`").cast("string")
    return [F.xxhash64(text).alias("_hash"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id")]


def _around(places: Column | str, shift: Column, slop: int) -> Column:
    """All numbers within ``slop`` of the places, less ``shift``."""
    return F.flatten(F.transform(places, lambda p: F.sequence(p - shift - slop, p - shift + slop)))


def candidates(index: DataFrame, pairs: DataFrame, slop: int) -> DataFrame:
    """``_hash, _id, window, starts``: where a window may stand, as the lists of its pairs meet within the slop.

    A row holds at most a few numbers for each position of a document, whatever repeats in it or in an item.
    """
    distinct = pairs.select("first", "second", "apart").distinct()
    left = index.join(distinct, F.col("term") == F.col("first")).select(*KEY, "second", "first", "apart", F.col("positions").alias("here"))
    right = index.select(*KEY, F.col("term").alias("second"), F.col("positions").alias("there"))
    # A place of the first word, were the window there: both words stand within the slop of their own.
    at = F.array_intersect(_around("here", F.lit(0), slop), _around("there", F.col("apart"), slop))
    met = left.join(right, [*KEY, "second"]).select(*KEY, "first", "second", "apart", at.alias("at"))
    met = materialise(met.where(F.size("at") > 0), "met")
    starts = F.transform("at", lambda p: p - F.col("place"))
    each = met.join(pairs, ["first", "second", "apart"]).select(*KEY, "window", starts.alias("starts"))
    return each.groupBy(*KEY, "window").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
    window: int = WINDOW, slop: int = SLOP, near: bool = True,
) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated``, ``near``.

    ``items`` holds the ids of items with an occurring window, as text, sorted, each once; ``near`` those of items with a near
    one, which every occurring one is too; with ``near=False`` only exact matches are looked for. Null texts have no words, on either side; an empty benchmark hits
    nothing; an item without an id hits words but is not listed. Repeated documents or items change
    nothing for one another. Clashing names are kept apart by the struct.
    """
    if not {item_col, item_text_col} <= set(benchmark.columns):
        raise ValueError("the benchmark lacks its columns")
    windows = item_windows(benchmark, item_col, item_text_col, window)
    pairs = window_pairs(docs, text_col, windows, near)
    index = postings(docs, id_col, text_col, pairs.select(F.explode(F.array("first", "second")).alias("term")))
    met = candidates(index, pairs, slop if near else 0).join(windows, "window")
    met = materialise(met.groupBy(*KEY).agg(F.collect_list(F.struct("item_ids", "words", "starts")).alias("passages")), "passages")
    weight = F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + F.size(p["item_ids"]) + F.size(p["words"]) + F.size(p["starts"]))
    small = (met.agg(F.sum(weight)).first()[0] or 0) <= BROADCAST_VALUES

    rows = docs.select(F.struct("*").alias("row"), *doc_key(id_col, text_col))
    # Few candidates go to the texts; else the texts move once, and the candidates are the small side of each partition.
    rows = rows.join(met.hint("broadcast" if small else "shuffle_hash"), list(KEY), "left")
    texts = F.array().cast("array<string>")

    def found(v: Column) -> Column:
        n = F.size(v["words"])

        def spans(p: Column) -> Column:
            length = F.size(p["words"])

            def stands(s: Column) -> Column:
                return (s >= 0) & (s + length <= n) & (F.slice(v["words"], F.greatest(s, F.lit(0)) + 1, length) == p["words"])

            def nearly(s: Column) -> Column:
                def there(w: Column, i: Column) -> Column:
                    first = F.greatest(s + i - slop, F.lit(0))
                    return F.array_contains(F.slice(v["words"], first + 1, F.greatest(s + i + slop + 1 - first, F.lit(0))), w)

                def enough(words: Column, of: Column) -> Column:
                    return F.size(F.filter(F.transform(words, there), lambda t: t)) >= of - allowed(length)

                half = F.ceil(length / 2).cast("int")  # most candidates fail on their first half
                return enough(F.slice(p["words"], F.lit(1), half), half) & enough(p["words"], length)

            def matched(places: Column) -> Column:
                at = F.flatten(F.transform(places, lambda s: F.sequence(s, s + length - 1)))
                exact = F.size(places) > 0
                close = exact | F.exists(p["starts"], nearly) if near else exact
                return F.struct(p["item_ids"].alias("item_ids"), at.alias("at"), close.alias("near"))

            return _let(F.filter(p["starts"], stands), matched)

        def listed(o: Column) -> Column:
            return F.array_sort(F.array_distinct(F.flatten(F.transform(o, lambda x: x["item_ids"]))))

        def summed(o: Column) -> Column:
            hit = F.size(F.array_distinct(F.flatten(F.transform(o, lambda x: x["at"]))))
            return F.struct(
                n.cast("long").alias("n_words"),
                hit.cast("long").alias("n_hit"),
                listed(F.filter(o, lambda x: F.size(x["at"]) > 0)).alias("items"),
                listed(F.filter(o, lambda x: x["near"])).alias("near"),
            )

        none = F.struct(n.cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), texts.alias("items"), texts.alias("near"))
        return F.when(v["passages"].isNull(), none).otherwise(_let(F.transform(v["passages"], spans), summed))

    value = F.struct(words_of(F.col("row")[text_col]).alias("words"), F.col("passages").alias("passages"))
    result = rows.select("row", _let(value, found).alias("f"))
    return result.select(
        "row", "f.n_words", "f.n_hit", F.size("f.items").cast("long").alias("n_items"), "f.items", (F.col("f.n_hit") > 0).alias("contaminated"), "f.near"
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without a benchmark passage."""
    found = contamination(docs, benchmark, "doc_id", "text", "item_id", "text", near=False)
    return found.where(~F.col("contaminated")).select("row.*")


@query
def op3_decontamination(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = contamination(docs, benchmark, "doc_id", "text", "item_id", "text")
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    near = F.sha2(F.array_join("near", ","), 256).alias("near_sha256")
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", F.size("near").cast("long").alias("n_near"), near)
