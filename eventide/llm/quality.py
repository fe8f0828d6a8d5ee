"""Quality rules by weak supervision.

Every rule looks at cheap statistics of one text and votes good (1), bad (-1)
or abstains (0).  No rule decides alone: a two-class latent-variable model
(independent rules given the class) is fitted by expectation-maximisation on
the histogram of vote patterns of *all* documents, which estimates how often
each rule votes which way on good and on bad text, i.e. its accuracy.  A
document is kept when the posterior probability of "good" reaches the
threshold.

Everything is DataFrame expressions.  The histogram has at most 3**9 rows
whatever the corpus; each EM step is one aggregation over it that returns a
single row of expected counts, and the fitted model is a plain column
expression, so scoring needs no join and no shuffle.

Defined results: null text has no words; texts without words have zero
statistics and fail the base rule; equal rows get equal verdicts; an empty
table keeps the prior model and yields no rows.  No column is added to the
documents, so extra columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import NOT_BLANK, staged, words

SYMBOL = "[#*$%&|<>]"

#: Frequent function words of the languages the rule knows.
STOPWORDS = (
    "the of and to in is that for it with as was on are be this "
    "der die das und in zu den von mit ist auf nicht sich im ein "
    "de la que el en y los se del un por con para una su "
    "le les des et est dans du une pour qui pas sur au avec"
).split()

RULES = ("length", "word_size", "symbols", "line_copies", "repeats", "capitals", "exclaims", "variety", "stopwords")


def let(value: Column, body) -> Column:
    """``body`` over ``value`` bound to a lambda variable: evaluated once per
    row however often the body names it.  A projection would not do: Spark
    copies a projected expression into every predicate that it pushes down."""
    return F.transform(F.array(value), body)[0]


def statistics(text: Column) -> Column:
    """Struct of the statistics of one text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))
    return let(words(text), lambda w: let(lines, lambda found: _statistics(text, w, found)))


def _statistics(text: Column, w: Column, lines: Column) -> Column:
    n = F.size(w)
    # 64-bit keys of the 3-word windows; equal windows have equal keys
    keys = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])),
    ).otherwise(F.array().cast("array<bigint>"))
    return F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        let(keys, _repeat_words).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long").alias("n_exclaims"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        F.size(F.filter(w, lambda x: x.isin(STOPWORDS))).cast("long").alias("n_stopwords"),
    )


FEW_KEYS = 64


def _repeat_words(keys: Column) -> Column:
    """Number of words in windows that occur twice or more.

    Sorting the keys shows which of them repeat.  The windows with a repeated
    key are then found by looking each key up in that list while it is short,
    else by sorting (key, position) pairs; both give the same positions."""

    def again(s: Column) -> Column:
        return F.array_distinct(F.filter(s, lambda k, j: F.coalesce(F.get(s, j + 1) == k, F.lit(False))))

    def by_list(found: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(keys) - 1), lambda i: F.array_contains(found, F.get(keys, i)))

    def by_order(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, j: F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)),
        )
        return F.sort_array(same["i"])

    def count(found: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        starts = F.when(F.size(found) <= FEW_KEYS, by_list(found)).otherwise(let(pairs, by_order))
        covered = F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )
        return F.when(F.size(found) > 0, covered).otherwise(F.lit(0))

    return let(let(F.sort_array(keys), again), count)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rule_votes(s: Column) -> Column:
    """Array of one vote for each rule, in the order of RULES.  All bounds are integer products, so
    any engine gives the same votes."""
    n, chars = s["n_words"], s["word_chars"]
    votes = {
        "length": _vote(n >= 100, n < 50),
        "word_size": _vote((chars >= 3 * n) & (chars <= 10 * n), (chars < 2 * n) | (chars > 15 * n)),
        "symbols": _vote(200 * s["n_symbols"] <= chars, 20 * s["n_symbols"] > chars),
        "line_copies": _vote(
            (s["n_lines"] >= 3) & (10 * s["n_dup_lines"] <= s["n_lines"]), 10 * s["n_dup_lines"] > 3 * s["n_lines"]
        ),
        "repeats": _vote(5 * s["n_repeat_words"] <= n, 10 * s["n_repeat_words"] > 4 * n),
        "capitals": _vote(10 * s["n_capitals"] <= chars, 10 * s["n_capitals"] > 4 * chars),
        "exclaims": _vote(20 * s["n_exclaims"] <= n, 10 * s["n_exclaims"] > 3 * n),
        "variety": _vote(10 * s["n_distinct"] >= 3 * n, (10 * s["n_distinct"] < n) & (n < 2000)),
        "stopwords": _vote(20 * s["n_stopwords"] >= n, (s["n_stopwords"] == 0) & (n > 0)),
    }
    return F.array(*[votes[r] for r in RULES])


#: Pseudo-counts: shares of the table's rows that the priors weigh.
PRIOR_SHARE = 0.01
PRIOR = {1: (0.8, 0.195, 0.005), -1: (0.65, 0.2, 0.15)}  # class -> shares of votes (1, 0, -1)
PRIOR_GOOD = 0.8
STEPS = 12


def prior_model() -> dict:
    return {
        "good": PRIOR_GOOD,
        "rules": {r: {c: dict(zip((1, 0, -1), PRIOR[c], strict=True)) for c in (1, -1)} for r in RULES},
    }


def _odds(votes: Column, model: dict) -> Column:
    """Log odds of "good" from an array of votes in the order of RULES."""
    weights = [math.log(model["rules"][r][1][v] / model["rules"][r][-1][v]) for r in RULES for v in (-1, 0, 1)]
    table = F.array(*map(F.lit, weights))
    found = F.transform(votes, lambda v, i: F.element_at(table, 3 * i + v + 2))
    return F.aggregate(found, F.lit(math.log(model["good"] / (1 - model["good"]))), lambda a, x: a + x)


def posterior(votes: Column, model: dict) -> Column:
    """P(good | votes) under the model."""
    return 1 / (1 + F.exp(-_odds(votes, model)))


def judged_statistics(stats: Column, model: dict, threshold: float = 0.5) -> Column:
    """Struct of the statistics (s), votes (v), posterior and verdict."""

    def verdict(s, v, p):
        failed = base_failed(s)
        kept = ~failed & (p >= threshold)
        return F.struct(s.alias("s"), v.alias("v"), p.alias("posterior"), failed.alias("base_failed"), kept.alias("kept"))

    return let(
        stats,
        lambda s: let(rule_votes(s), lambda v: let(posterior(v, model), lambda p: verdict(s, v, p))),
    )


def judged(text: Column, model: dict, threshold: float = 0.5) -> Column:
    return judged_statistics(statistics(text), model, threshold)


def fit(docs: DataFrame, steps: int = STEPS) -> dict:
    """Model of the rules, from the vote patterns of all rows of ``docs``."""
    return fit_statistics(docs.select(statistics(F.col("text")).alias("s")), steps)


def fit_statistics(stats: DataFrame, steps: int = STEPS) -> dict:
    """The same from a column ``s`` of statistics."""
    voted = stats.select(let(F.col("s"), rule_votes).alias("v"))
    # at most 3**9 patterns: one small partition, read again by every step
    pattern = staged(voted.groupBy("v").agg(F.count("*").alias("n")).coalesce(1), "quality-patterns")
    model = prior_model()
    for _ in range(steps):
        good = pattern.select("n", (F.col("n") * posterior(F.col("v"), model)).alias("good"), F.posexplode("v"))
        rows = good.groupBy("pos", "col").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
        if not rows:
            return model
        count = {(RULES[r["pos"]], r["col"]): {1: r["good"], -1: r["n"] - r["good"]} for r in rows}
        size = {c: sum(x[c] for (rule, _), x in count.items() if rule == RULES[0]) for c in (1, -1)}
        n = size[1] + size[-1]
        extra = PRIOR_SHARE * n
        model = {
            "good": (size[1] + extra * PRIOR_GOOD) / (n + extra),
            "rules": {
                r: {
                    c: {
                        v: (count.get((r, v), {c: 0.0})[c] + extra * PRIOR[c][i]) / (size[c] + extra)
                        for i, v in enumerate((1, 0, -1))
                    }
                    for c in (1, -1)
                }
                for r in RULES
            },
        }
    return model


def accuracies(model: dict) -> dict[str, float]:
    """Share of right votes among a rule's votes, under the model."""
    out = {}
    for r, m in model["rules"].items():
        g, b = model["good"], 1 - model["good"]
        right = g * m[1][1] + b * m[-1][-1]
        out[r] = right / (right + g * m[1][-1] + b * m[-1][1])
    return out


def filter_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (a ``text`` column is needed) that the rules keep."""
    model = fit(docs)
    return docs.where(judged(F.col("text"), model, threshold)["kept"])
