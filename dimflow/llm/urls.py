"""URL verdicts: host and path rules first, then a logistic regression on character n-grams.

Host and path are cut with native expressions. Rules are a short list given by the caller, so they become one
CASE, longest rule first. What no rule decides goes to a model trained on a small labelled table of
URLs, which owes nothing to the rules: counts of character n-grams of host and path, hashed into a fixed number of features, weighted by
Spark's logistic regression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = 1 << 14
NGRAMS = (2, 3, 4)
#: Names of hosts by language, good and spam, written for this table. Twice as many are good, so that unheard-of names pass.
GOOD = {
    "en": ("library", "weather", "gardening", "university", "history", "museum", "the-other-weather", "mathematics", "northern-town", "cooking",
           "fashion", "workshop", "relationships", "stations", "english-theatre", "health", "nations", "fish-and-ships"),
    "de": ("bibliothek", "wetter", "garten", "universitaet", "geschichte", "nachrichten", "stadt-museum", "rezepte", "wanderung", "schule"),
    "fr": ("bibliotheque", "meteo", "jardin", "universite", "histoire", "musee", "recettes", "la-ville", "journal", "ecole"),
    "es": ("biblioteca", "tiempo", "jardin", "universidad", "historia", "museo", "recetas", "la-ciudad", "noticias", "escuela"),
}
SPAM = {
    "en": ("casino", "online-casino", "casino-slots", "win-casino", "best-bets", "free-pills", "win-cash", "ads-click-tracker", "spam-links"),
    "de": ("spielcasino", "sport-wetten-bonus", "gratis-pillen", "gewinnspiel-ads", "sofort-kredit"),
    "fr": ("casino-gratuit", "paris-bonus", "pilules-gratuites", "gagner-cash", "pub-tracker"),
    "es": ("casino-gratis", "apuestas-bonus", "pastillas-gratis", "ganar-cash", "ads-tracking"),
}
#: Each name comes once with each of these, good or spam, so that they teach the model nothing.
SUBDOMAINS, DOMAINS = ("", "www.", "m.", "blog."), ("example.com", "example.net", "example.org")


@dataclass(frozen=True)
class UrlRule:
    """``site`` is a host and the start of a path; it holds for the host and all its subdomains."""

    site: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, start = self.site.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)


RULES = (
    UrlRule("org/", "allow"),
    UrlRule("example.org/es/", "block"),
    UrlRule("example.org/en/1", "block"),
    UrlRule("com/fr/", "allow"),
    UrlRule("com/de/", "block"),
)


def parts(url: Column) -> Column:
    """A struct of host and path; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.struct(F.translate(host, UPPER, LOWER).alias("host"), path.alias("path"))


def with_rules(urls: DataFrame, url_col: str, carry: Sequence[str], rules: Sequence[UrlRule]) -> DataFrame:
    """``carry`` columns, ``host``, ``path``, ``rule`` (the longest that fits, else null) and ``ruled`` (its verdict)."""
    cut = urls.select(*[F.col(f"`{c}`") for c in carry], parts(F.col(f"`{url_col}`").cast("string")).alias("_parts"))
    host, path = F.col("_parts.host"), F.col("_parts.path")
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.site), r.site)):
        rule, ruled = F.when(r.fits(host, path), r.site).otherwise(rule), F.when(r.fits(host, path), r.verdict).otherwise(ruled)
    return cut.select(*carry, host.alias("host"), path.alias("path"), rule.alias("rule"), ruled.alias("ruled"))


def ngrams(host: Column, path: Column) -> Column:
    """All character n-grams of host and path, ends marked."""
    text = F.concat(F.lit("^"), host, F.lit("\u0001"), path, F.lit("$"))
    runs = [
        F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i, n=n: F.substr(text, i, F.lit(n)))
        for n in NGRAMS
    ]
    return F.flatten(F.array(*[F.when(F.length(text) >= n, run).otherwise(F.array().cast("array<string>")) for n, run in zip(NGRAMS, runs)]))


def _featured(rows: DataFrame) -> DataFrame:
    counted = HashingTF(numFeatures=FEATURES, inputCol="_ngrams", outputCol="_features")
    return counted.transform(rows.withColumn("_ngrams", ngrams(F.col("host"), F.col("path"))))


def train(labelled: DataFrame):
    """The model for ``host, path, ruled`` rows (``block`` or ``allow``), None without rows. One small partition."""
    rows = _featured(labelled.select("host", "path", (F.col("ruled") == "block").cast("double").alias("label")).coalesce(1))
    rows = rows.select("_features", "label").persist()
    try:
        if rows.isEmpty():
            return None
        learner = LogisticRegression(featuresCol="_features", labelCol="label", regParam=1e-3, maxIter=30)
        learner.setPredictionCol("_prediction").setProbabilityCol("_probability").setRawPredictionCol("_raw")
        return learner.fit(rows)
    finally:
        rows.unpersist()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``host, path, ruled``: the labelled table, every name in the paths of every language."""
    named = [(name, verdict) for verdict, names in (("allow", GOOD), ("block", SPAM)) for of in names.values() for name in of]
    rows = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(verdict).alias("ruled")) for name, verdict in sorted(set(named))])
    urls = spark.range(1).select(F.inline(rows))
    for column, values in (("sub", SUBDOMAINS), ("domain", DOMAINS), ("lang", tuple(GOOD))):
        urls = urls.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(column))
    # Numbers of one to five digits, the same for all names.
    number = F.substring(F.pmod(F.xxhash64("sub", "domain", "lang"), F.lit(90000)).cast("string"), 1, F.pmod(F.hash("lang", "domain", "sub"), F.lit(5)) + 1)
    return urls.select(F.concat("sub", "name", F.lit("."), "domain").alias("host"), F.concat(F.lit("/"), "lang", F.lit("/"), number).alias("path"), "ruled")


def judged(urls: DataFrame, url_col: str, carry: Sequence[str], rules: Sequence[UrlRule], labelled: DataFrame | None = None) -> DataFrame:
    """``carry`` columns, ``host``, ``path``, ``rule`` and ``verdict``.

    ``labelled`` has ``host, path, ruled``; without it the model learns from ``labelled_urls``. Null
    URLs and such without ``://`` have an empty host and path and get the model's verdict on those. With
    nothing to learn from the verdict is ``allow``. Rows stand for themselves; ``carry`` may not name a
    result column.
    """
    if clash := set(carry) & {"host", "path", "rule", "ruled", "verdict"}:
        raise ValueError(f"rename {sorted(clash)} first")
    rows = with_rules(urls, url_col, carry, rules)
    model = train(labelled_urls(urls.sparkSession) if labelled is None else labelled)
    if model is None:
        learnt, scored = F.lit("allow"), rows
    else:
        scored = model.transform(_featured(rows))
        learnt = F.when(F.col("_prediction") > 0.5, "block").otherwise("allow")
    return scored.select(*carry, "host", "path", "rule", F.coalesce("ruled", learnt).alias("verdict"))


@query
def op10_url_filter(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages"), "url", ["page_id"], RULES)
