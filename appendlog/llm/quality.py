"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes low (-1), abstains (0) or votes good (1) on a text.  A
two-class latent model (low, good) with one vote distribution per rule and
class is fitted by expectation-maximisation over the counts of vote patterns
(at most 3 to the number of rules, whatever the input's size), over all rows.
An abstention says nothing about the class, so one reliable low vote is not
outvoted by rules that look for other faults.  The posterior probability of
"good" replaces all-must-pass filtering.

Null texts have no words; they and empty texts fail the base test (under 10
words).  Texts are read whole.  Repeated rows count as often as they occur; an
empty table gives an empty result.  Words are runs without ASCII white space.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlog.llm.common import let, pinned, sized

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
ITERATIONS = 12
#: Prior belief in votes (good texts, low texts), worth PRIOR_ROWS rows of each class.
PRIOR_ROWS = 20
BELIEF = {-1: (0.01, 0.5), 1: (0.5, 0.2)}
THRESHOLD = 0.5
_SPACE = r"[ \t-\r]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _windows(words: Column, size: int) -> Column:
    """64-bit hashes of the runs of ``size`` words, by position."""
    n = F.size(words)
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))
    return F.when(n >= size, F.slice(hashed, 1, F.greatest(n - (size - 1), F.lit(1)))).otherwise(
        F.array().cast("array<bigint>"))


def word_windows(text: Column, size: int = WINDOW) -> Column:
    """Hashes of the runs of ``size`` words of a text (null for a null text)."""
    return let(_words(text), lambda w: _windows(w, size))


def _covered(hashes: Column) -> Column:
    """Positions, ascending, of the windows whose hash occurs twice or more."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(z: Column) -> Column:
        return F.filter(z, lambda s, k: F.coalesce(s.h == F.get(z, k - 1).h, F.lit(False))
                        | F.coalesce(s.h == F.get(z, k + 1).h, F.lit(False)))

    return F.sort_array(F.transform(let(ordered, twice), lambda s: s.i))


def _spread(at: Column, size: int) -> Column:
    """Words under windows of ``size`` words that start at ``at`` (ascending)."""
    def steps(z: Column) -> Column:
        return F.transform(z, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(z, k + 1) - p, F.lit(size))))

    return F.aggregate(let(at, steps), F.lit(0).cast("bigint"), lambda a, x: a + x)


def features(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Word and line statistics of each row's whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    staged = df.select(F.col(key).alias("doc_id"), t.alias("t")).select(
        "doc_id", "t", _words(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"))
    staged = staged.select(
        "doc_id", F.size("w").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("t", _SPACE, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).cast("bigint").alias("n_letters"),
        F.length(F.regexp_replace("t", r"[^!?]+", "")).cast("bigint").alias("n_shouts"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"),
        _windows(F.col("w"), WINDOW).alias("h"))
    staged = staged.withColumn("at", F.when(F.size(F.array_distinct("h")) < F.size("h"), _covered(F.col("h"))))
    return staged.withColumn(
        "n_repeat_words", F.when(F.col("at").isNull(), F.lit(0).cast("bigint")).otherwise(
            _spread(F.col("at"), WINDOW))).drop("h", "at")


def _vote(low: Column, good: Column | None = None) -> Column:
    vote = F.when(low, -1)
    return F.coalesce(vote if good is None else vote.when(good, 1), F.lit(0)).cast("int")


def rules() -> dict[str, Column]:
    """Rule name -> vote (-1 low, 0 abstain, 1 good) over ``features``."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    lines, length = F.greatest(F.col("n_lines"), F.lit(1)), F.col("word_chars") / n
    return {
        "length": _vote(F.col("n_words") < MIN_WORDS, F.col("n_words") >= 50),
        "repeats": _vote(F.col("n_repeat_words") / n > 0.15, F.col("n_repeat_words") == 0),
        "symbols": _vote(F.col("n_symbols") / chars > 0.05),
        "capitals": _vote(F.col("n_upper") / letters > 0.3),
        "shouts": _vote(F.col("n_shouts") / n > 0.2),
        "letters": _vote(F.col("n_letters") / chars < 0.65, F.col("n_letters") / chars > 0.93),
        "lines": _vote((F.col("n_dup_lines") > 2) & (F.col("n_dup_lines") / lines > 0.4)),
        "word_length": _vote((length < 2.5) | (length > 14)),
    }


def fit(votes: DataFrame, names: list[str]) -> tuple[float, dict[tuple[str, int], float]]:
    """Prior log-odds of "good", and the log-odds that each vote adds.

    One aggregation counts the vote patterns of all rows (at most
    3 ** len(names) of them, so the driver holds a table of bounded size); the
    iterations run over that table.  The start is "low where any rule votes
    low"; patterns are read in a fixed order, so the fit is repeatable.
    """
    patterns = sorted((tuple(r[n] for n in names), r["count"]) for r in votes.groupBy(*names).count().collect())
    good = [0.02 if -1 in p else 0.98 for p, _ in patterns]
    prior, weight = 0.0, {(n, v): 0.0 for n in names for v in (-1, 0, 1)}
    for _ in range(ITERATIONS if patterns else 0):
        n_good = sum(c * g for (_, c), g in zip(patterns, good, strict=True))
        n_low = sum(c * (1 - g) for (_, c), g in zip(patterns, good, strict=True))
        prior = log((n_good + PRIOR_ROWS) / (n_low + PRIOR_ROWS))
        for i, name in enumerate(names):
            for v in (-1, 1):
                mine = [(c, g) for (p, c), g in zip(patterns, good, strict=True) if p[i] == v]
                a, b = BELIEF[v]
                p_good = (sum(c * g for c, g in mine) + a * PRIOR_ROWS) / (n_good + PRIOR_ROWS)
                p_low = (sum(c * (1 - g) for c, g in mine) + b * PRIOR_ROWS) / (n_low + PRIOR_ROWS)
                # rules are better than chance: a vote never counts for the other side
                weight[name, v] = max(0.0, log(p_good / p_low)) if v > 0 else min(0.0, log(p_good / p_low))
        odds = [prior + sum(weight[n, v] for n, v in zip(names, p, strict=True)) for p, _ in patterns]
        good = [1 / (1 + exp(-max(-500.0, min(500.0, o)))) for o in odds]
    return prior, weight


def _posterior(prior: float, weight: dict[tuple[str, int], float], names: list[str]) -> Column:
    odds = F.lit(prior)
    for n in names:
        odds = odds + F.when(F.col(n) == -1, weight[n, -1]).when(F.col(n) == 1, weight[n, 1]).otherwise(weight[n, 0])
    return 1 / (1 + F.exp(-odds))


def score(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Statistics, the base test, ``p_good`` and the verdict ``kept``."""
    voters = rules()
    names = [f"v_{n}" for n in voters]
    voted = pinned(features(df, key, text), "quality-features").select(
        "*", *[c.alias(f"v_{n}") for n, c in voters.items()])
    prior, weight = fit(voted, names)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return voted.withColumn("base_failed", failed).withColumn("p_good", _posterior(prior, weight, names)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass, with its own columns.

    A verdict depends on the text alone, so it goes by the text's hash (rows
    with equal ids and other texts are judged apart); the hashes of rejected
    texts are joined against ``df``.
    """
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    judged = score(df.select(mark.alias("__mark"), F.col(text).alias("__text")), "__mark", "__text")
    away = judged.where(~F.col("kept")).select(F.col("doc_id").alias("__mark")).distinct()
    return df.withColumn("__mark", mark).join(sized(pinned(away, "quality-rejected")), "__mark", "left_anti").select(*df.columns)
