"""URL filter: rules first, then words in names.

*Rules* are strings like ``example.com/en/`` with a verdict.  A rule fits its
host and all subdomains if the URL's path starts with the rule's; the longest
one that fits decides (of equally long ones that of the longer host).  Rules
are one expression of the plan: some hundred at most.

*Words.*  Names in hosts and paths (runs of letters) are split into words by
a unigram Viterbi: of all splits the most probable, by how often words occur
in the pages' visible texts and, set apart by hyphens, in hosts.  An unknown
word costs a factor of 10 for each letter.  Each distinct name is split once;
its substrings meet the word counts in a join, so tasks hold no dictionary.

*Scores.*  A multinomial naive Bayes scores the words of host and path (apart
from each other; a run of digits is one word).  Its block examples are the
URLs with a word of ``seeds`` in the host, its allow examples all others that
no block rule covers.  Words are smoothed with SMOOTHING occurrences of the
mean of all URLs, so a word that tells nothing counts nothing.  A URL without
a rule is blocked if its odds are above 1.  Without block examples, all are
allowed.  Hosts and paths are scored once each, however many pages they have.

Cases: a null URL, or one without ``://``, has an empty host and path, fits
no rule and is allowed; repeated rows and null ids keep a row each; an empty
table gives no rows; names of any length are split, in stretches of STRETCH
letters; other columns are ignored."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# The rules of the registered query.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: Words that name what filters commonly keep out.
SEEDS = ("adult", "betting", "casino", "gambling", "malware", "phishing", "pills", "porn", "spam", "viagra", "warez", "xxx")

LONGEST = 24
STRETCH = 256
SMOOTHING = 1000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKUP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"


def parsed(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with host and path."""
    begin = F.locate("://", F.col(url_col))
    rest = F.when(begin > 0, F.substring(F.col(url_col), begin + 3, F.length(url_col)))
    part = F.coalesce(rest, F.lit(""))
    return pages.withColumn("host", F.translate(F.regexp_extract(part, "^[^/?#]*", 0), _UPPER, _LOWER)) \
        .withColumn("path", F.regexp_extract(part, "^[^/?#]*([^?#]*)", 1))


def longest_rule(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _names(text: Column) -> Column:
    """The names in lower-cased text; a run of digits is the name 0."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), "[0-9]+", "0"), F.lit(r"\p{L}{1,%d}|0" % STRETCH), F.lit(0))


def word_counts(html: DataFrame, hosts: DataFrame, seeds) -> DataFrame:
    """(word, n) of the visible words in ``html`` (html) and of what hyphens
    set apart in ``hosts`` (host); seeds are known words."""
    seen = html.select(F.explode(F.regexp_extract_all(F.lower(F.regexp_replace("html", _MARKUP, " ")), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    apart = hosts.select(F.explode(F.split("host", r"\.")).alias("label")).filter(F.col("label").contains("-")) \
        .select(F.explode(F.regexp_extract_all("label", F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    known = html.sparkSession.createDataFrame([(w,) for w in seeds], "word string")
    return seen.union(apart).union(known).filter(F.length("word") <= LONGEST).groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of a name.  ``known``: (start, length) to the
    number of that substring's occurrences.  Of equally probable splits that
    of fewer words, then of the shorter last word."""
    best = [(0.0, 0, 0)]  # log probability, words, start of the last word
    for end in range(1, len(name) + 1):
        found = None
        for size in range(1, min(end, LONGEST) + 1):
            n = known.get((end - size, size))
            own = math.log(n / total) if n else -math.log(total) - (size - 1) * math.log(10) - math.log(10)
            before = best[end - size]
            this = (before[0] + own, -before[1] - 1)
            if found is None or this > found[:2]:
                found = (*this, end - size)
        best.append((found[0], -found[1], found[2]))
    words, end = [], len(name)
    while end:
        words.append(name[best[end][2]:end])
        end = best[end][2]
    return words[::-1]


def _splitter(total: int):
    def split(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            words = [best_split(name, {(p["at"], p["size"]): p["n"] for p in pieces or ()}, total)
                     for name, pieces in zip(names, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])
    return split


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct ``names`` (name) by ``counts`` (word, n)."""
    common.bound_batches(names.sparkSession)
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    size = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("at")))
    pieces = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("at")) \
        .select("name", "at", F.explode(size).alias("size")).withColumn("word", F.expr("substring(name, at + 1, size)"))
    known = pieces.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("at", "size", "n")).alias("pieces"))
    return names.join(known, "name", "left").select("name", "pieces").mapInArrow(_splitter(total), "name string, words array<string>")


def _weights(tokens: DataFrame, n_block: int, n_allow: int) -> tuple[DataFrame, float]:
    """(kind, word, weight): the logarithm of how much a word speaks for
    block; and the logarithm of the odds before any word.  ``tokens``: (kind,
    word, block, allow, n), numbers of its occurrences in examples and all."""
    counts = common.stage(tokens.groupBy("kind", "word").agg(*[F.sum(c).alias(c) for c in ("block", "allow", "n")]), "tokens")
    block, allow, n = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("block", "allow", "n")]).first()
    share = F.lit(SMOOTHING) * F.col("n") / F.lit(float(max(n, 1)))
    weight = F.log((F.col("block") + share) / (block + SMOOTHING)) - F.log((F.col("allow") + share) / (allow + SMOOTHING))
    return counts.select("kind", "word", weight.alias("weight")), math.log((n_block + 1) / (n_allow + 1))


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: (page_id, host, path, rule, verdict)."""
    urls = parsed(pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url")), "_url").drop("_url")
    rule, says = longest_rule(rules, F.col("host"), F.col("path"))
    urls = urls.withColumn("rule", rule).withColumn("says", says) \
        .withColumn("shape", F.regexp_replace(F.lower("path"), "[0-9]+", "0"))
    # hosts and paths, each once, with the numbers of their URLs
    each = common.stage(urls.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(F.col("says") == "block", F.lit(False))).alias("ruled_out")), "urls")
    hosts = each.select("host").distinct()
    text = lambda kind, column: each.select(F.lit(kind).alias("kind"), F.col(column).alias("part")).distinct()
    parts = text("host", "host").union(text("path", "shape")).filter("part != ''")
    named = common.stage(parts.select("kind", "part", F.explode(_names(F.col("part"))).alias("name")), "names")
    counts = common.stage(word_counts(pages.select(F.col(html_col).cast("string").alias("html")), hosts, seeds), "words")
    split = common.stage(segment(named.select("name").distinct(), counts), "split")
    words = common.stage(named.join(split, "name").select("kind", "part", F.explode("words").alias("word")), "parts")

    # examples: what a seed is in is to be blocked, other URLs of no block rule to be allowed
    seeded = words.filter((F.col("kind") == "host") & F.col("word").isin(*seeds)).select(F.col("part").alias("host")).distinct().withColumn("seed", F.lit(True))
    block = F.when(F.col("seed"), F.col("n")).otherwise(F.lit(0))
    allow = F.when(F.col("seed"), F.lit(0)).otherwise(F.col("n") - F.col("ruled_out"))
    examples = common.stage(each.join(seeded, "host", "left").select("host", "shape", "n", block.alias("block"), allow.alias("allow")), "examples")
    n_block, n_allow = examples.agg(F.sum("block"), F.sum("allow")).first()
    if n_block:
        def of(kind, column):
            sums = examples.groupBy(F.col(column).alias("part")).agg(*[F.sum(c).alias(c) for c in ("block", "allow", "n")])
            return words.filter(F.col("kind") == kind).join(sums, "part").select("kind", "word", "block", "allow", "n")
        weights, before = _weights(of("host", "host").unionByName(of("path", "shape")), n_block, n_allow)
        scored = words.join(weights, ["kind", "word"]).groupBy("kind", "part").agg(F.sum("weight").alias("score"))

        def scores(kind, column):
            return scored.filter(F.col("kind") == kind).select(F.col("part").alias(column), F.col("score").alias(kind + "_score"))
        odds = F.lit(before) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
        blocked = common.stage(each.join(scores("host", "host"), "host", "left").join(scores("path", "shape"), "shape", "left")
                               .filter(odds > 0).select("host", "shape", F.lit(True).alias("blocked")), "blocked")
        urls = urls.join(blocked, ["host", "shape"], "left")
    else:
        urls = urls.withColumn("blocked", F.lit(None).cast("boolean"))
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return urls.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("says", method).alias("verdict"))
