"""Quality of texts by weak supervision: rules vote or abstain, their reliability is estimated."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import SPACES, numbered, position, saved, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3
GOOD, BAD, ABSTAIN = 1, -1, 0
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

ROUNDS = 100
SETTLED = 1e-9
FIRST_GOOD = 0.8  # share of good texts before any is seen
# What a rule's vote is expected to be like, and the number of documents that this opinion weighs.
FIRST_VOTES = {"good": {GOOD: 0.75, ABSTAIN: 0.24, BAD: 0.01}, "bad": {GOOD: 0.6, ABSTAIN: 0.1, BAD: 0.3}}
WEIGHT = 20.0
# Rules are written to spare good texts. Without this bound the two classes may settle on any one kind
# of junk against all the rest, and a rule that finds another kind would count for nothing.
FALSE_ALARM = 0.01


def count_of(text: Column, kind: str) -> Column:
    """How many characters are of the kind, a regular expression's class."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", "")).cast("long")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns c0, c1, ... of the input with the measures of the text; a null text has no words."""
    rows = numbered(docs).withColumn("body", F.coalesce(F.col(f"c{position(docs, text)}"), F.lit("")))
    rows = rows.withColumn("words", words_of(F.col("body"))).withColumn("lines", F.split("body", "\n", -1))
    rows = rows.withColumn("lines", F.filter("lines", lambda x: x.rlike(f"[^{SPACES}]")))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    starts = F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    window = F.transform(
        starts, lambda x, i: F.xxhash64(x, *[F.get("words", i + j) for j in range(1, WINDOW)])
    )
    rows = rows.withColumn("windows", window)
    rows = rows.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    rows = rows.withColumn("placed", F.when(F.col("repeats"), placed))
    twice = F.filter(
        "placed",
        lambda x, i: (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"]),
    )
    rows = rows.withColumn("twice", F.when(F.col("repeats"), F.sort_array(F.transform(twice, lambda x: x["at"]))))
    covered = F.aggregate(
        "twice",
        F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("at"), (a["n"] + F.least(F.lit(WINDOW), x - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    body = F.col("body")
    letters = F.length(body) - F.length(F.regexp_replace(body, r"\p{L}+", ""))
    return rows.select(
        *[f"c{i}" for i in range(len(docs.columns))],
        "n_words",
        (F.length(body) - count_of(body, SPACES)).alias("word_chars"),
        count_of(body, SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("repeats"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        letters.cast("long").alias("n_letters"),
        count_of(body, "A-Z").alias("n_capitals"),
        count_of(body, "0-9").alias("n_digits"),
        count_of(body, "!?").alias("n_calls"),
        count_of(body, ".,;:").alias("n_stops"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Each rule votes GOOD or BAD or abstains, by whole numbers only."""
    words, chars, letters = F.col("n_words"), F.col("word_chars"), F.col("n_letters")

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)

    capitals = F.col("n_capitals")
    return {
        "length": vote(words < MIN_WORDS, words >= 2 * MIN_WORDS),
        "word_length": vote((chars < 3 * words) | (chars > 12 * words), (chars >= 4 * words) & (chars <= 9 * words)),
        "symbols": vote(10 * F.col("n_symbols") > words, 100 * F.col("n_symbols") <= words),
        "lines": vote(
            10 * F.col("n_dup_lines") > 3 * F.col("n_lines"), (F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 3)
        ),
        "repeats": vote(100 * F.col("n_repeat_words") > 50 * words, 100 * F.col("n_repeat_words") <= 20 * words),
        "capitals": vote(2 * capitals > letters, 10 * capitals <= 2 * letters),
        "letters": vote(10 * letters < 6 * chars, 10 * letters >= 9 * chars),
        "digits": vote(10 * F.col("n_digits") > 3 * chars, 100 * F.col("n_digits") <= 3 * chars),
        "calls": vote(10 * F.col("n_calls") > words, 100 * F.col("n_calls") <= words),
        "stops": vote((100 * F.col("n_stops") < words) | (F.col("n_stops") > words), 30 * F.col("n_stops") >= words),
    }


@dataclass(frozen=True)
class Model:
    """Share of good texts; by rule the probability of each vote for good and for bad texts."""

    good: float
    votes: dict[str, dict[str, dict[int, float]]]

    def posterior(self) -> Column:
        """Probability that a text is good, from the columns `vote_<rule>`."""
        odds = F.lit(math.log(self.good) - math.log(1 - self.good))
        for name, table in self.votes.items():
            weight = {v: math.log(table["good"][v]) - math.log(table["bad"][v]) for v in (GOOD, BAD, ABSTAIN)}
            vote = F.col(f"vote_{name}")
            odds = odds + F.when(vote == GOOD, weight[GOOD]).when(vote == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
        return 1 / (1 + F.exp(-odds))


def estimated(counts: list[tuple[tuple[int, ...], int]], names: list[str]) -> Model:
    """Expectation-maximisation over vote patterns and how many documents have each."""
    counts = sorted(counts)
    total = sum(n for _, n in counts)
    good = FIRST_GOOD
    votes = {name: {c: dict(FIRST_VOTES[c]) for c in FIRST_VOTES} for name in names}
    for _ in range(ROUNDS if total else 0):
        mass = {name: {c: {v: WEIGHT * p for v, p in FIRST_VOTES[c].items()} for c in FIRST_VOTES} for name in names}
        sure = WEIGHT * FIRST_GOOD
        for pattern, n in counts:
            up, down = math.log(good), math.log(1 - good)
            for name, v in zip(names, pattern):
                up += math.log(votes[name]["good"][v])
                down += math.log(votes[name]["bad"][v])
            q = 1 / (1 + math.exp(min(700.0, down - up)))
            sure += n * q
            for name, v in zip(names, pattern):
                mass[name]["good"][v] += n * q
                mass[name]["bad"][v] += n * (1 - q)
        before, good = good, min(max(sure / (total + WEIGHT), 1e-6), 1 - 1e-6)
        votes = {
            name: {c: {v: m / sum(by.values()) for v, m in by.items()} for c, by in both.items()}
            for name, both in mass.items()
        }
        for both in votes.values():
            over = both["good"][BAD] - FALSE_ALARM
            if over > 0:
                both["good"] = {BAD: FALSE_ALARM, ABSTAIN: both["good"][ABSTAIN], GOOD: both["good"][GOOD] + over}
        if abs(good - before) < SETTLED:
            break
    return Model(good, votes)


def voted(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({f"vote_{name}": vote for name, vote in rules().items()})


def fitted(votes: DataFrame) -> Model:
    """From how often each pattern of votes occurs, over all rows. The patterns are the only rows that
    reach the driver: at most 3 to the power of the number of rules, whatever the input."""
    names = list(rules())
    columns = [f"vote_{name}" for name in names]
    found = votes.groupBy(*columns).count().collect()
    return estimated([(tuple(r[c] for c in columns), r["count"]) for r in found], names)


def judged(docs: DataFrame, text: str = "text", least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Adds the measures, `base_failed`, `quality` (posterior probability) and `kept`.

    `keep` names the input columns that are wanted (default: all); the others are not written. Kept are
    texts that pass the base rules with a posterior of at least `least`. A null text counts as empty
    and is not kept. Equal rows are judged alike. An input column named like an added one is replaced.
    An empty table gives an empty result. Windows of words are compared by 64-bit hashes within one
    text. Runs two passes: the measures are written once, then the votes are counted.
    """
    wanted = docs.columns if keep is None else keep
    metrics = measured(docs, text)
    places = [i for i, c in enumerate(docs.columns) if c in wanted]
    rows = saved(metrics.select(*[f"c{i}" for i in places], *metrics.columns[len(docs.columns):]), "measures")
    votes = voted(rows)
    quality = fitted(votes).posterior()
    result = votes.withColumns({"base_failed": base_failed(), "quality": quality})
    result = result.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    added = [*METRICS, "base_failed", "quality", "kept"]
    taken = {name.lower() for name in added}
    named = [F.col(f"c{i}").alias(docs.columns[i]) for i in places if docs.columns[i].lower() not in taken]
    return result.select(*named, *added)


def filtered(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that are kept, with the columns of the input."""
    rows = numbered(docs)
    result = judged(rows, f"c{position(docs, text)}", least)
    return result.where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
