"""Quality rules as weak supervision.

Every rule votes for a document (1), against it (-1) or abstains (0). How often each rule votes which
way on good and on poor documents is not given; expectation-maximisation estimates it from how the
rules agree over all documents. A document is kept by its posterior probability of being good, not
for passing every rule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayblotter.llm.common import carried, stored, table, without, words_of

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_ended_lines", "n_letters", "n_letter_words", "n_symbol_words", "n_unique_words"]
_WORKING = ["_text", "_words", "_lines", "_keys", "_low", "_again"]
_ADDED = [*BASE, *EXTRA, "base_failed", "votes", "quality", "kept", *_WORKING]
LEAST = 0.5
ROUNDS = 50
SETTLED = 1e-6
# A vote against is so many times as likely on a poor document as on a good one, at least: rules speak against
# gross flaws only. So a flaw that one rule or two see counts beside one that many see.
LIKELIER = 99.0
MOST_RULES = 12  # patterns of votes, 3^12 at most, are gone over on the driver
PSEUDO = 1.0  # documents added to each count of votes, so that no chance is 0
PRIORS = (0.5, 0.99)  # the share of good documents lies within


@dataclass(frozen=True)
class Rule:
    """SQL conditions on the columns of `measures`: when to vote for and when against a document."""

    name: str
    good: str
    poor: str


RULES = [
    Rule("length", "n_words >= 50", "n_words < 20"),
    Rule("repeats", "n_repeat_words <= 0.2 * n_words", "n_repeat_words > 0.4 * n_words"),
    Rule("symbols", "n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    Rule("lines", "n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("word_length", "word_chars between 3 * n_words and 10 * n_words", "word_chars not between 2 * n_words and 15 * n_words"),
    Rule("letters", "n_letters >= 0.85 * word_chars", "n_letters < 0.7 * word_chars"),
    Rule("letter_words", "n_letter_words >= 0.9 * n_words", "n_letter_words < 0.75 * n_words"),
    Rule("symbol_words", "n_symbol_words <= 0.05 * n_words", "n_symbol_words > 0.2 * n_words"),
    Rule("endings", "n_ended_lines >= 0.7 * n_lines", "n_ended_lines < 0.3 * n_lines"),
    Rule("variety", "n_unique_words >= 0.3 * n_words", "n_unique_words < 0.1 * n_words"),
]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with counts over their whole text; see `BASE` and `EXTRA`.

    Words are split at ASCII white space, a null text has none. A line counts if it has a word; it
    is a repeat if it equals an earlier one. Repeated words are those in a window of three words
    that occurs twice or more. Repeated rows are kept; input columns named like added ones give way.

    Windows are found by sorting, for each document, one number per window: a hash above the window's
    place. Neighbours with one hash are compared word by word, and are repeats both. Nothing leaves the
    row.
    """
    rows = without(docs, _ADDED)
    rows = rows.withColumn("_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = rows.withColumn("_words", words_of(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    )
    # The place takes as many low bits as the number of words needs.
    rows = rows.withColumn("_low", F.expr("shiftleft(1L, length(bin(size(_words))))")).withColumn(
        "_keys",
        F.expr(
            "sort_array(transform(if(size(_words) < 3, array(), sequence(0, size(_words) - 3)), "
            "i -> (xxhash64(_words[i], _words[i + 1], _words[i + 2]) & ~(_low - 1)) | i))"
        ),
    )
    # Two keys with one hash differ in their places alone.
    rows = rows.withColumn(
        "_again",
        F.expr(
            "filter(if(size(_keys) < 2, array(), sequence(0, size(_keys) - 2)), "
            "j -> (_keys[j] ^ _keys[j + 1]) between 0 and _low - 1 "
            "and slice(_words, int(_keys[j] & (_low - 1)) + 1, 3) = slice(_words, int(_keys[j + 1] & (_low - 1)) + 1, 3))"
        ),
    )
    rows = rows.withColumn(
        "_again",
        F.expr(
            "sort_array(array_distinct(flatten(transform(_again, "
            "j -> array(int(_keys[j] & (_low - 1)), int(_keys[j + 1] & (_low - 1)))))))"
        ),
    )
    covered = (
        "aggregate(zip_with(_again, slice(_again, 2, greatest(size(_again) - 1, 0)), "
        "(here, next) -> least(3, coalesce(next - here, 3))), 0L, (sum, n) -> sum + n)"
    )
    symbols = F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", ""))
    return rows.select(
        *[f"`{name}`" for name in rows.columns if name not in _WORKING],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_lines", lambda line: F.regexp_like(line, F.lit(r"""[.!?:;…。！？]["'”’»)\]]*\s*$"""))))
        .cast("long")
        .alias("n_ended_lines"),
        F.length(F.regexp_replace("_text", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.size(F.filter("_words", lambda word: F.regexp_like(word, F.lit(r"\p{L}")))).cast("long").alias("n_letter_words"),
        F.when(symbols > 0, F.size(F.filter("_words", lambda word: F.regexp_like(word, F.lit(r"[#*$%&|<>]")))))
        .otherwise(0)
        .cast("long")
        .alias("n_symbol_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_unique_words"),
    )


def _vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.poor), -1).when(F.expr(rule.good), 1).otherwise(0).cast("tinyint")


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and for each rule the chances that it votes, and against good and poor ones if so.

    Abstaining is as likely on good as on poor documents, and says nothing.
    """

    prior: float
    voting: Sequence[float]
    against_good: Sequence[float]
    against_poor: Sequence[float]

    def chances(self, place: int, good: bool) -> list[float]:
        """Of a rule's votes -1, 0 and 1 on good or on poor documents."""
        voting, against = self.voting[place], (self.against_good if good else self.against_poor)[place]
        return [voting * against, 1 - voting, voting * (1 - against)]

    def weights(self, place: int) -> list[float]:
        """What votes -1, 0 and 1 add to the log odds of being good."""
        good, poor = self.against_good[place], self.against_poor[place]
        return [math.log(good / poor), 0.0, math.log((1 - good) / (1 - poor))]

    def chance(self, votes: Sequence[int]) -> float:
        """Posterior probability of being good, of one pattern of votes."""
        odds = math.log(self.prior / (1 - self.prior)) + sum(self.weights(at)[vote + 1] for at, vote in enumerate(votes))
        return 1 / (1 + math.exp(-odds))

    def quality(self, votes: Column) -> Column:
        """Posterior probability of being good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for place in range(len(self.voting)):
            odds = odds + F.array(*map(F.lit, self.weights(place)))[votes[place].cast("int") + 1]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(votes: DataFrame, rules: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over all rows of `votes`, an array column of that name.

    Rows are counted by their pattern of votes; the counts, of 3^rules patterns at most however many
    documents there are, reach the driver, and the rounds go over them. Begins with four documents in
    five good, and rules that vote against a tenth of the good and two fifths of the poor. Each round
    takes the parameters that make the votes, and `PSEUDO` documents beside them, likeliest given the
    posteriors, among those that keep to `PRIORS` and `LIKELIER`; so the likelihood never falls, and
    good and poor cannot change places. At least half of all documents being good, a rule that is against
    more than half cannot be right about them: of it, only that votes against are no likelier on good
    documents is asked. Without rows: the beginning.
    """
    if rules > MOST_RULES:
        raise ValueError(f"{rules} rules have too many patterns of votes, {MOST_RULES} are the most")
    counts = [(tuple(row[0]), row[1]) for row in votes.groupBy("votes").agg(F.count(F.lit(1))).collect()]
    model = LabelModel(0.8, [1.0] * rules, [0.1] * rules, [0.4] * rules)
    for _ in range(rounds if counts else 0):
        after = _maximised([(pattern, n, n * model.chance(pattern)) for pattern, n in sorted(counts)], rules)
        moved = max(
            abs(a - b)
            for new, old in ((after.against_good, model.against_good), (after.against_poor, model.against_poor))
            for a, b in zip(new, old)
        )
        model = after
        if moved < SETTLED:
            break
    return model


def _maximised(weighed: Sequence[tuple[Sequence[int], float, float]], rules: int) -> LabelModel:
    """The likeliest parameters for patterns with their number of documents and of good ones among them."""
    n, good = (math.fsum(row[place] for row in weighed) for place in (1, 2))
    voting, goods, poors = [], [], []
    for rule in range(rules):
        counts = {
            (vote, of): math.fsum(row[of] for row in weighed if row[0][rule] == vote) for vote in (-1, 1) for of in (1, 2)
        }
        on_good = [counts[vote, 2] for vote in (-1, 1)]
        on_poor = [max(counts[vote, 1] - counts[vote, 2], 0.0) for vote in (-1, 1)]
        likelier = LIKELIER if counts[-1, 1] <= n / 2 else 1.0
        for_good, for_poor = likeliest(*[count + PSEUDO for count in (*on_good, *on_poor)], likelier)
        voting.append((counts[-1, 1] + counts[1, 1] + PSEUDO) / (n + 2 * PSEUDO))
        goods.append(for_good)
        poors.append(for_poor)
    prior = (good + PSEUDO) / (n + 2 * PSEUDO)
    return LabelModel(min(max(prior, PRIORS[0]), PRIORS[1]), voting, goods, poors)


def likeliest(
    against_good: float, for_good: float, against_poor: float, for_poor: float, likelier: float = LIKELIER
) -> tuple[float, float]:
    """Chances of a vote against good and against poor documents that make these counts likeliest.

    Where the shares themselves do not keep the second `likelier` times the first, it is just that: then
    the likelihood has one maximum in the second, where a quadratic is 0.
    """
    good, poor = against_good / (against_good + for_good), against_poor / (against_poor + for_poor)
    if good * likelier <= poor:
        return good, poor
    share, against = 1 / likelier, against_good + against_poor
    square = share * (against + for_good + for_poor)
    linear = against * (1 + share) + share * for_good + for_poor
    poor = (linear - math.sqrt(linear * linear - 4 * square * against)) / (2 * square)
    return share * poor, poor


def weak_quality(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] | None = None,
    rules: Sequence[Rule] = RULES,
    least: float = LEAST,
) -> DataFrame:
    """Documents with their measures, `base_failed`, `votes`, `quality` and `kept`.

    `carry` names the input columns to return, all by default. `base_failed`: under 50 words, or over
    half of the words repeated. `quality` is the posterior probability of being good; `kept` holds
    where it is `least` or more and the base has not failed. Null and empty texts fail the base. An
    empty table gives an empty one. Repeated rows are kept and judged alike. Input columns named like
    added ones give way to them.

    Texts are gone over once: what was measured is stored with the carried columns, the model is
    fitted to the stored votes, and judging reads them again.
    """
    wanted = carried(docs, carry, _ADDED)
    voted = stored(
        measures(docs, text)
        .withColumn("votes", F.array(*[_vote(rule) for rule in rules]))
        .select(*[F.col(f"`{name}`") for name in wanted], *BASE, *EXTRA, "votes"),
        "quality",
    )
    model = fit(voted.select("votes"), len(rules))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("quality", model.quality(F.col("votes")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )


def op10_weak_quality(spark, sf_dir):
    judged = weak_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return judged.select("doc_id", *BASE, "base_failed", "kept", "quality")
