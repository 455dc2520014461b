"""Quality rules over whole texts as a short-circuit cascade of native expressions.

Every document gets its base measures. The rules then form one CASE, which stops at the first rule that
rejects. Their order comes from a sample drawn from the whole table: each rule is evaluated and timed on it, and the next
rule is always the one that rejects most of the sample rows still left per second. The order changes only how long
the cascade takes, never its verdict, so the bounded sample and its timing noise leave results alone. A cost is that of
the rule given the base measures, which the base check and the result need anyway.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import query, table
from dimflow.session import materialise

SPACE = r"[ \t-\r]+"
#: Characters of sampled text that each rule is timed on, and the seed of the draw.
EVALUATED, SEED = 12_000_000, 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A named reason to reject, as SQL over the column ``text`` and the fields of the struct ``m``."""

    name: str
    rejects: str


#: Thresholds in whole numbers, so that SQL engines agree on them.
RULES = (
    Rule("symbols", "10 * m.n_symbols > m.n_words"),
    Rule("repeated_lines", "10 * m.n_dup_lines > 3 * m.n_lines"),
    Rule("word_length", "m.word_chars < 2 * m.n_words OR m.word_chars > 15 * m.n_words"),
    Rule("capitals", r"2 * length(regexp_replace(text, '[^\\p{Lu}]+', '')) > length(regexp_replace(text, '[^\\p{L}]+', ''))"),
    Rule("shouting", "5 * (length(text) - length(replace(text, '!!', ' '))) > m.n_words"),
    Rule("few_letters", r"10 * length(regexp_replace(text, '[^\\p{L}]+', '')) < 6 * m.word_chars"),
)
BASE_FAILED = "m.n_words < 50 OR 100 * m.n_repeat_words > 50 * m.n_words"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """How many words lie in a three-word window that the text has at least twice."""

    def places(ordered: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

        covered = F.transform(F.filter(ordered, twin), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(covered)))

    def counted(hashes: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeated, _let(F.sort_array(marked), places)).otherwise(0)

    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return _let(windows, counted)


def measures(text: Column) -> Column:
    """A struct of the base measures of a text; a null text counts as empty.

    Windows and lines are compared as 64-bit hashes and as they are, in this order.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        repeated = F.size(lines) - F.size(F.array_distinct(lines))
        return F.struct(F.size(lines).cast("long").alias("n_lines"), repeated.cast("long").alias("n_dup_lines"))

    words = _let(F.array_remove(F.split(text, SPACE), ""), of_words)
    lines = _let(F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]")), of_lines)
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")
    parts = F.struct(words.alias("w"), lines.alias("l"), symbols.alias("s"))
    found = {"n_words": "w", "word_chars": "w", "n_symbols": "", "n_dup_lines": "l", "n_lines": "l", "n_repeat_words": "w"}
    return _let(parts, lambda p: F.struct(*[(p[at][name] if at else p["s"]).alias(name) for name, at in found.items()]))


def measured(docs: DataFrame, text_col: str, carry: Sequence[str]) -> DataFrame:
    """``carry`` columns as struct ``row``, the text as ``text`` and its measures as ``m``."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    return docs.select(row, text, measures(F.col(f"`{text_col}`")).alias("m"))


def drawn(docs: DataFrame, text_col: str, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows drawn from the whole table, as ``text`` and ``m``, written to one small file."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    # Measures are made after the draw, for the drawn rows only.
    rows = docs.select(F.col(f"`{text_col}`").alias("text")).sample(False, share, seed=SEED).repartition(1)
    return materialise(measured(rows, "text", []).select("text", "m"), "drawn")


def rule_costs(sample: DataFrame, rules: Sequence[Rule], runs: int = 3) -> list[float]:
    """The seconds that each rule takes over the sample beside one that never rejects.

    Each rule is evaluated on every row many times in one job (``EVALUATED`` characters in all, a thousand times a row
    at most), so that what a job costs anyway is small beside it, and the least of ``runs`` jobs counts. A rule not told apart from the
    constant one gets the floor, a twentieth of the constant one's time: among such rules only rejections count.
    """
    total = sample.agg(F.sum(F.length("text") + 100)).first()[0] or 1
    again = max(1, min(1000, EVALUATED // total))
    many = sample.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.lit(again))))

    def seconds(rejects: Column) -> float:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            many.agg(F.count_if(rejects)).first()
            taken.append(time.perf_counter() - start)
        return min(taken)

    seconds(F.col("m.n_words") < 0)  # the first jobs also compile and open files
    base = seconds(F.col("m.n_words") < 0)
    return [max(seconds(F.expr(rule.rejects)) - base, base / 20) for rule in rules]


def rule_order(docs: DataFrame, text_col: str, rules: Sequence[Rule] = RULES, sample_rows: int = 400) -> list[Rule]:
    """The rules by rejection per second on some ``sample_rows`` rows drawn from all.

    Only yes or no for each rule and row of the sample reaches the driver. Rules that reject nothing there come last, the
    cheapest of them first. An empty table keeps the order given.
    """
    rows = drawn(docs, text_col, sample_rows)
    verdicts = [F.coalesce(F.expr(rule.rejects), F.lit(False)).alias(f"r{i}") for i, rule in enumerate(rules)]
    sample = rows.select(*verdicts).collect()
    if not sample:
        return list(rules)
    costs = rule_costs(rows, rules)
    left, todo, order = set(range(len(sample))), set(range(len(rules))), []
    while todo:
        gain = {i: sum(bool(sample[r][i]) for r in left) for i in todo}
        best = max(sorted(todo), key=lambda i: (gain[i] / costs[i], -costs[i]))
        order.append(rules[best])
        todo.remove(best)
        left = {r for r in left if not sample[r][best]}
    return order


def cascade(order: Sequence[Rule]) -> Column:
    """The first rejecting rule's name, base failures first; null where every rule lets the text pass."""
    verdict = F.when(F.expr(BASE_FAILED), F.lit("base"))
    for rule in order:
        verdict = verdict.when(F.expr(rule.rejects), F.lit(rule.name))
    return verdict


def judged(docs: DataFrame, text_col: str, carry: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns), the measures ``m``, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base check. Rows stand for themselves: equal rows get
    equal verdicts, an empty table gives an empty result, and as the carried columns sit in a struct, their
    names cannot clash with the result's.
    """
    rows = measured(docs, text_col, carry)
    rejected_by = cascade(rule_order(docs, text_col, rules))
    return rows.select("row", "m", F.expr(BASE_FAILED).alias("base_failed"), rejected_by.isNull().alias("kept"))


def good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that no rule rejects."""
    return judged(docs, text_col, docs.columns).where("kept").select("row.*")


@query
def op2_quality_rules(spark, sf_dir):
    rows = judged(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return rows.select("row.doc_id", *[f"m.{name}" for name in MEASURES], "base_failed", "kept")
