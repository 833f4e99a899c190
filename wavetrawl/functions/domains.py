"""Registered domains by public-suffix rules."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl.functions.text import or_empty
from wavetrawl.functions.urls import url_host

# The rule table is read whole on every executor, so its size is checked before it is broadcast. The
# complete public list has about ten thousand rules.
MAX_BROADCAST_RULES = 100_000


def _bundled_list() -> list[str]:
    return files("wavetrawl").joinpath("data/suffixes.csv").read_text(encoding="utf-8").split()[1:]


def bundled_suffixes(spark: SparkSession) -> DataFrame:
    """The small rule list that ships with the package, as ``suffix``."""
    return spark.createDataFrame([(rule,) for rule in _bundled_list()], "suffix string")


_RULES = "rule_key string, exact boolean, below boolean, exception boolean, depth int"


def _bundled_rules(spark: SparkSession) -> tuple[DataFrame, int, int]:
    """The bundled list in the form of :func:`suffix_rules`, its size and its deepest rule."""
    kinds: dict[str, set[str]] = {}
    for rule in _bundled_list():
        kind = "exception" if rule.startswith("!") else "below" if rule.startswith("*.") else "exact"
        kinds.setdefault(rule.lstrip("!*."), set()).add(kind)
    rows = [(k, "exact" in v, "below" in v, "exception" in v, k.count(".") + 1) for k, v in kinds.items()]
    return spark.createDataFrame(rows, _RULES), len(rows), max(row[-1] for row in rows)


def suffix_rules(suffixes: DataFrame) -> DataFrame:
    """One row per rule key: ``rule_key, depth, exact, below, exception``.

    ``below`` marks a wildcard rule, which makes every label directly under the key a suffix.
    """
    rule = F.lower(F.trim(F.col("suffix")))
    return (
        suffixes.select(
            F.regexp_replace(rule, r"^(!|\*\.)", "").alias("rule_key"),
            rule.startswith("!").alias("exception"),
            rule.startswith("*.").alias("below"),
        )
        .filter(F.col("rule_key") != "")
        .groupBy("rule_key")
        .agg(
            F.bool_or(~F.col("exception") & ~F.col("below")).alias("exact"),
            F.bool_or("below").alias("below"),
            F.bool_or("exception").alias("exception"),
        )
        .withColumn("depth", F.size(F.split("rule_key", r"\.")))
    )


def read_suffix_list(spark: SparkSession, path: str, private: bool = False) -> DataFrame:
    """A public-suffix list in its published text form, as ``suffix``; it is one small file.

    A rule is the first word of a line; comments start with two slashes. The list's second part, the suffixes of private
    services, is only read on demand, as those make each customer's host a domain.
    """
    whole = spark.read.text(path, wholetext=True)
    public = F.substring_index("value", "===BEGIN PRIVATE DOMAINS===", 1)
    lines = F.explode(F.split(F.col("value") if private else public, r"\r?\n")).alias("line")
    words = whole.select(lines).select(F.regexp_extract("line", r"^\s*(\S*)", 1).alias("suffix"))
    return words.filter((F.col("suffix") != "") & ~F.col("suffix").startswith("//"))


def with_registered_domain(
    links: DataFrame,
    url: str = "audio_url",
    suffixes: DataFrame | None = None,
    out: str = "domain",
    rule: str | None = None,
) -> DataFrame:
    """Add the registered domain of a URL column.

    One lookup per possible rule depth against the same rule table; all of them are hash joins on a
    broadcast of checked size, so the links are neither exploded nor shuffled. A table over the bound is
    joined without the broadcast hint. Addresses stay whole. Under no rule the last label counts as the suffix, as the
    public list's own default rule has it. ``rule`` names a column that tells how the domain was found: ``listed``,
    ``unlisted``, ``address``, or ``none`` for a URL without host. The bundled list is a small one; pass the complete list
    (:func:`read_suffix_list`) where the unlisted hosts matter.
    """
    if suffixes is None:
        rules, size, depth = _bundled_rules(links.sparkSession)
    else:
        rules = suffix_rules(suffixes)
        size, depth = rules.agg(F.count("*"), F.max("depth")).first()
    small = size <= MAX_BROADCAST_RULES
    name = f"__{out}_host"
    host = F.col(name)
    label_count = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    hosts = links.withColumn(name, or_empty(url_host(F.col(url))))
    ends, exceptions = [], []
    for d in range(1, (depth or 0) + 1):
        level = rules.filter(F.col("depth") == d).select(
            F.col("rule_key").alias(f"__key{d}"),
            F.col("exact").alias(f"__exact{d}"),
            F.col("below").alias(f"__below{d}"),
            F.col("exception").alias(f"__exception{d}"),
        )
        # A host with fewer labels than the rule stays whole here and cannot equal its key.
        tail = F.lower(F.substring_index(host, ".", -d))
        hosts = hosts.join(F.broadcast(level) if small else level, tail == F.col(f"__key{d}"), "left")
        ends.append(F.when(F.col(f"__exact{d}"), F.lit(d)))
        ends.append(F.when(F.col(f"__below{d}") & (label_count > d), F.lit(d + 1)))
        exceptions.append(F.when(F.col(f"__exception{d}"), F.lit(d - 1)))
    known = F.coalesce(*exceptions, *ends) if ends else F.lit(None).cast("int")
    suffix_labels = F.coalesce(*exceptions[::-1], F.greatest(*ends, F.lit(1))) if ends else F.lit(1)
    by_labels = [
        F.when(suffix_labels == n, F.substring_index(host, ".", -(n + 1))) for n in range((depth or 0) + 2)
    ]
    is_address = host.rlike(r"^(\d{1,3}\.){3}\d{1,3}$") | host.startswith("[")
    domain = F.when(is_address, host).otherwise(F.coalesce(*by_labels))
    found = (
        F.when(host == "", F.lit("none"))
        .when(is_address, F.lit("address"))
        .when(known.isNotNull(), F.lit("listed"))
        .otherwise(F.lit("unlisted"))
    )
    added = [domain.alias(out)] + ([found.alias(rule)] if rule else [])
    return hosts.select(*[F.col(f"`{c}`") for c in links.columns], *added)
