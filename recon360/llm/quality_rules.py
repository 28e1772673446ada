"""Quality rules whose cutoffs carry a risk guarantee.

Every rule compares a feature of the text with a cutoff. The cutoffs of all rules move together along one
sequence of levels from lenient to strict. Stratum by stratum, labelled good documents prove of each level
that its rules together reject few of them: an exact binomial test (the one that the Clopper-Pearson bound
inverts) at a level corrected for the strata. Along the sequence the losses only grow, so testing in its
order needs no correction, and all levels that pass are safe at once; of these the one in force rejects
most labelled bad documents, the most lenient of equal ones. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.llm.common import SPACE, let, log_factorial, pick, text_hash
from recon360.sources.store import TableStore

SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose feature lies beyond the cutoff; ``grid`` runs from lenient to strict."""

    name: str
    feature: str  # SQL over the columns of text_features()
    above: bool  # whether large values are bad
    grid: tuple[float, ...]


RULES = (
    Rule("symbols_per_word", "n_symbols / nullif(n_words, 0)", True, (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1)),
    Rule("repeated_words", "n_repeat_words / nullif(n_words, 0)", True, (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("duplicate_lines", "n_dup_lines / nullif(n_word_lines, 0)", True, (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("long_words", "word_chars / nullif(n_words, 0)", True, (100.0, 60.0, 40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0)),
    Rule("short_words", "word_chars / nullif(n_words, 0)", False, (1.0, 1.25, 1.5, 2.0, 2.5, 3.0)),
)


@dataclass(frozen=True)
class Risk:
    """At most ``rejected`` of a stratum's good documents are lost to all rules together, and this holds
    in every stratum at once with probability ``1 - error``."""

    rejected: float = 0.02
    error: float = 0.05


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more; ``hashes`` holds one hash per window."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated_starts(sorted_windows: Column) -> Column:
        def same(a: Column, i: Column) -> Column:
            return F.coalesce(F.get(sorted_windows, i)["h"] == a["h"], F.lit(False))

        found = F.filter(sorted_windows, lambda a, i: same(a, i - 1) | same(a, i + 1))
        return F.array_sort(F.transform(found, lambda a: a["i"]))

    def covered(starts: Column) -> Column:
        # each start covers the words up to the next start, five at most
        lengths = F.transform(
            starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)))
        )
        return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)

    return let(let(placed, repeated_starts), covered)


def with_features(flat: DataFrame, text: Column) -> DataFrame:
    """``flat`` plus the counts of the text; a null text counts as none.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal an
    earlier line), n_word_lines, n_repeat_words (words in windows of five words that occur twice or
    more, by a 64-bit hash of the window) and base_failed.
    """
    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(filled, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    out = flat.withColumns({"_words": _words(filled), "_lines": lines}).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate(filled, SPACE_CHARS, "")).cast("long"),
            "n_symbols": (F.length(filled) - F.length(F.translate(filled, SYMBOLS, ""))).cast("long"),
            "n_word_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(
                F.size("_words") >= WINDOW,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - F.lit(WINDOW)),
                    lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    all_differ = F.size(F.array_distinct("_windows")) == F.size("_windows")
    out = out.withColumn(
        "n_repeat_words", F.when(all_differ, F.lit(0).cast("long")).otherwise(_repeat_words(F.col("_windows")))
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_words", "_lines", "_windows")


FEATURES = ("n_words", "word_chars", "n_symbols", "n_word_lines", "n_dup_lines", "n_repeat_words", "base_failed")


def text_features(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (the language), _hash and the features, one row per document."""
    rows = pick(docs, "doc_id", "text", "lang")
    featured = with_features(rows, F.col("text"))
    return featured.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), text_hash(F.col("text")).alias("_hash"), *FEATURES
    )


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p).

    Sums downward from k, over ten standard deviations and fifty terms: what is left out is below
    double precision for every k under the mean, and from the mean on the answer is at least one half.
    """
    x, odds = k.cast("double"), (1.0 - p) / p
    top = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + x * F.log(F.lit(p)) + (n - k).cast("double") * F.log(F.lit(1.0 - p))
    )
    reach = F.least(k, F.ceil(10.0 * F.sqrt(n.cast("double") * p * (1.0 - p))) + F.lit(50))
    steps = F.when(k > 0, F.sequence(F.lit(0).cast("long"), reach - 1)).otherwise(F.array().cast("array<bigint>"))
    # term(i - 1) = term(i) * i / (n - i + 1) * odds, at i = k - step
    total = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda a, s: F.struct(
            (a["term"] * (k - s) / (n - (k - s) + 1) * odds).alias("term"),
            (a["total"] + a["term"] * (k - s) / (n - (k - s) + 1) * odds).alias("total"),
        ),
        lambda a: a["total"],
    )
    return F.when(k.cast("double") >= n.cast("double") * p, F.lit(1.0)).otherwise(F.exp(top + F.log(total)))


def level_cuts(rules: Sequence[Rule]) -> list[list[float]]:
    """Per level the cutoff of each rule; a rule whose grid is shorter stays at its last."""
    return [[rule.grid[min(t, len(rule.grid) - 1)] for rule in rules] for t in range(max(len(rule.grid) for rule in rules))]


def cutoffs(features: DataFrame, labels: DataFrame, risk: Risk = Risk(), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per stratum: n_good and one column ``cut_<rule>``, null where no level is safe.

    ``labels`` (doc_id, quality) marks good documents with 1 and bad ones with 0; those that pass the base
    conditions are the holdout. A level is safe if the rules together lose at most ``risk.rejected`` of the
    good ones, with the error divided among the strata: without a loss this takes
    ln(error / strata) / ln(1 - rejected) labelled good documents. Labels that are null or have no document
    are ignored; a document with several labels counts once, by the lowest. Without labels no rule rejects
    anything.
    """
    judged = (
        pick(labels, "doc_id", "quality")
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality in (0, 1)")
    )
    strata = features.select("stratum").distinct().count()
    levels = level_cuts(rules)
    rejects = [reduce(Column.__or__, [_beyond(rule, F.lit(cut)) for rule, cut in zip(rules, cuts, strict=True)]) for cuts in levels]
    good = F.col("quality") == 1
    counts = [
        F.count_if(which & rejected).alias(f"{name}_{t}") for t, rejected in enumerate(rejects) for name, which in (("lost", good), ("caught", ~good))
    ]
    counted = features.where("not base_failed").join(judged, "doc_id").groupBy("stratum").agg(F.count_if(good).alias("n_good"), *counts)
    steps = [F.struct(F.lit(t).alias("level"), F.col(f"lost_{t}").alias("lost"), F.col(f"caught_{t}").alias("caught")) for t in range(len(levels))]
    tested = counted.select("stratum", "n_good", F.inline(F.array(*steps)))
    safe = binomial_cdf(F.col("lost"), F.col("n_good"), risk.rejected) <= risk.error / max(1, strata)
    best = F.max(F.when(safe, F.struct("caught", (-F.col("level")).alias("place"))))["place"]
    chosen = tested.groupBy("stratum", "n_good").agg((-best).alias("level"))
    return chosen.select(
        "stratum",
        "n_good",
        *[F.get(F.array(*[F.lit(cuts[r]) for cuts in levels]), F.col("level")).alias(f"cut_{rule.name}") for r, rule in enumerate(rules)],
    )


def _beyond(rule: Rule, cut: Column) -> Column:
    value = F.expr(rule.feature)
    return F.coalesce(value > cut if rule.above else value < cut, F.lit(False))


def verdicts(features: DataFrame, cuts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``features`` plus rejected_by (names of the rules) and kept.

    A text that fails the base conditions is never kept. A stratum without labelled documents has no
    cutoffs, so there the base conditions decide alone.
    """
    joined = features.join(cuts, "stratum", "left")
    named = F.array(*[F.when(_beyond(rule, F.col(f"cut_{rule.name}")), F.lit(rule.name)) for rule in rules])
    by = F.array_compact(named)
    return joined.select(
        "doc_id", "_hash", "stratum", *FEATURES, by.alias("rejected_by"), (~F.col("base_failed") & (F.size(by) == 0)).alias("kept")
    )


def apply_rules(docs: DataFrame, labels: DataFrame, store: TableStore, risk: Risk = Risk()) -> DataFrame:
    """Features, cutoffs and verdict of every document; the texts are read once."""
    features = store("features", text_features(docs))
    return verdicts(features, store("cutoffs", cutoffs(features, labels, risk)))
