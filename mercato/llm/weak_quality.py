"""Text quality by weak supervision: rules vote, their accuracies are estimated without labels.

Each rule looks at a few counts of a text and votes good or bad, or abstains. How far a rule can be
trusted is estimated by expectation-maximisation over all texts: a hidden class per text, and per
rule the chance that its vote names the class. A text's verdict is the posterior probability that
it is good, so one doubtful vote does not drop a text and several weak ones together do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.ragged import BASE, SPACE, Powers, Rolling, blocks, flat, mix, word_spans
from mercato.llm.tables import stage

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letter_words", "n_closed_words", "n_punctuation", "n_digits", "n_upper", "n_cased",
)


def table_of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


def counted(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> dict[str, np.ndarray]:
    """The features of every text of a block, as whole numbers.

    Words are runs of bytes other than space and 9 to 13. Lines, and windows of three words, are
    compared by 64-bit hashes.
    """
    m = len(offsets) - 1
    out = {name: np.zeros(m, dtype=np.int64) for name in FEATURES}
    if not len(data):
        return out

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])

    solid = ~SPACE[data]
    starts, ends, words = word_spans(data, offsets)
    owner = np.repeat(np.arange(m), words)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    out["n_words"] = words
    out["word_chars"] = per_text(solid & ((data & 0xC0) != 0x80))
    out["n_symbols"] = per_text(table_of(SYMBOLS)[data])
    out["n_punctuation"] = per_text(table_of(PUNCTUATION)[data])
    out["n_digits"] = per_text((data >= 48) & (data <= 57))
    out["n_upper"] = per_text(upper)
    out["n_cased"] = per_text(upper | lower)
    letters = np.concatenate([[0], np.cumsum(upper | lower | (data >= 128))])
    count = lambda mask: np.bincount(owner[mask], minlength=m)
    out["n_letter_words"] = count(letters[ends] > letters[starts])
    out["n_closed_words"] = count(table_of(b".!?")[data[ends - 1]])
    rolling = Rolling(data, powers)

    # Lines with a word: which equal an earlier one of the same text.
    feeds = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    begin = begin[begin < len(data)]
    end = np.minimum(np.append(begin[1:], len(data)), len(data))
    end = end - (data[end - 1] == 10)
    dense = np.concatenate([[0], np.cumsum(solid)])
    wordy = dense[end] > dense[begin]
    begin, end = begin[wordy], end[wordy]
    of = np.searchsorted(offsets, begin, "right") - 1
    out["n_lines"] = np.bincount(of, minlength=m)
    value = mix(rolling.of(begin, end) + mix(of.astype(np.uint64)))
    _, first = np.unique(value, return_index=True)
    again = np.ones(len(value), dtype=bool)
    again[first] = False
    out["n_dup_lines"] = np.bincount(of[again], minlength=m)

    # Words inside windows of three that the text has twice.
    if len(starts) > 2:
        word = rolling.of(starts, ends)
        at = np.flatnonzero(owner[2:] == owner[:-2])
        value = mix(mix((word[at] * BASE + word[at + 1]) * BASE + word[at + 2]) + mix(owner[at].astype(np.uint64)))
        order = np.argsort(value)
        v = value[order]
        same = np.zeros(len(v) + 1, dtype=bool)
        same[1:-1] = v[1:] == v[:-1]
        twice = at[order[same[:-1] | same[1:]]]
        covered = np.zeros(len(starts), dtype=bool)
        for k in range(3):
            covered[twice + k] = True
        out["n_repeat_words"] = count(covered)
    return out


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``FEATURES`` of every whole text (null: all 0). Other columns are not read."""
    slim = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches):
            found = counted(*flat(batch.column("text")), powers)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *[pa.array(found[n], pa.int64()) for n in FEATURES]], names=["_key", *FEATURES])

    made = slim.mapInArrow(run, ", ".join([f"_key {key_type}", *[f"{n} long" for n in FEATURES]]))
    return made.withColumnRenamed("_key", key)


@dataclass(frozen=True)
class Rule:
    """Two conditions over the features, as SQL; ``bad`` comes first, neither is an abstention."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        bad, good = F.coalesce(F.expr(self.bad), F.lit(False)), F.coalesce(F.expr(self.good), F.lit(False))
        return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


RULES = (
    Rule("length", "n_words < 20", "n_words >= 100"),
    Rule("word_length", "n_words > 0 and (word_chars < 2.5 * n_words or word_chars > 14 * n_words)", "word_chars between 3 * n_words and 11 * n_words and n_words > 0"),
    Rule("symbols", "n_symbols > 0.1 * word_chars", "n_symbols <= 0.02 * word_chars and n_words > 0"),
    Rule("punctuation", "n_punctuation > 0.15 * word_chars", "n_punctuation <= 0.08 * word_chars and n_words > 0"),
    Rule("repeated_words", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words and n_words >= 20"),
    Rule("repeated_lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines <= 0.05 * n_lines and n_lines >= 3"),
    Rule("letters", "n_letter_words < 0.7 * n_words", "n_letter_words >= 0.85 * n_words and n_words > 0"),
    Rule("digits", "n_digits > 0.3 * word_chars", "n_digits <= 0.1 * word_chars and n_words > 0"),
    Rule("capitals", "n_upper > 0.5 * n_cased", "n_upper <= 0.25 * n_cased and n_cased > 0"),
    Rule("sentence_ends", "n_closed_words > 0.5 * n_words", "n_closed_words between 0.01 * n_words and 0.3 * n_words and n_words >= 20"),
)


@dataclass(frozen=True)
class Model:
    """The share of good texts, and per rule how often its vote is right on good and on bad texts."""

    rules: tuple[Rule, ...]
    share: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]
    rounds: int

    def weights(self) -> list[tuple[float, float]]:
        """What a vote for good, and one for bad, adds to the log odds of good."""
        pairs = zip(self.right_on_good, self.right_on_bad, strict=True)
        return [(float(np.log(g / (1 - b))), float(np.log((1 - g) / b))) for g, b in pairs]


# Before any vote is seen: how often a rule's vote is right on good and on bad texts (a bad text has one or two faults, so most
# rules find nothing wrong with it), the share of good texts, and the weight of these guesses as a share of the texts.
PRIOR_ON_GOOD, PRIOR_ON_BAD, PRIOR_GOOD, PRIOR_MASS = 0.97, 0.3, 0.8, 0.002


def estimate(votes: np.ndarray, counts: np.ndarray, rules: Sequence[Rule], rounds: int = 200, tolerance: float = 1e-9) -> Model:
    """Expectation-maximisation over the distinct vote patterns and how many texts have each.

    An abstention says nothing of the class. A rule's votes keep meaning what they say: a vote for
    bad is never likelier on good texts than on bad ones. The prior grows with the texts, so it
    acts alike at every size.
    """
    n = float(counts.sum())
    good_vote, bad_vote = (votes == 1).astype(float), (votes == -1).astype(float)
    mass = PRIOR_MASS * max(n, 1.0)
    share, on_good, on_bad = PRIOR_GOOD, np.full(votes.shape[1], PRIOR_ON_GOOD), np.full(votes.shape[1], PRIOR_ON_BAD)
    last, made = -np.inf, 0
    for made in range(1, rounds + 1):
        odds = good_vote @ np.log(on_good / (1 - on_bad)) + bad_vote @ np.log((1 - on_good) / on_bad)
        good = 1 / (1 + np.exp(-(odds + np.log(share / (1 - share)))))
        weight_good, weight_bad = good * counts, (1 - good) * counts
        share = (weight_good.sum() + mass * PRIOR_GOOD) / (n + mass) if n else PRIOR_GOOD
        on_good = (weight_good @ good_vote + mass * PRIOR_ON_GOOD) / (weight_good @ (good_vote + bad_vote) + mass)
        on_bad = (weight_bad @ bad_vote + mass * PRIOR_ON_BAD) / (weight_bad @ (good_vote + bad_vote) + mass)
        on_good = np.clip(on_good, 0.5, 1 - 1e-4)
        on_bad = np.clip(on_bad, 1 - on_good, 1 - 1e-4)
        if abs(share - last) < tolerance:
            break
        last = share
    return Model(tuple(rules), float(share), tuple(on_good.tolist()), tuple(on_bad.tolist()), made)


def fit(found: DataFrame, rules: Sequence[Rule] = RULES) -> Model:
    """Accuracies from the votes on all texts of ``found`` (features).

    Only the distinct vote patterns and their counts reach the driver: three votes a rule, so never
    more than 3 to the number of rules, however many texts there are.
    """
    names = [f"_v{i}" for i in range(len(rules))]
    patterns = found.select(*[r.vote().alias(n) for r, n in zip(rules, names, strict=True)]).groupBy(*names).agg(F.count("*").alias("_n"))
    rows = sorted(tuple(r) for r in patterns.collect())
    table = np.array(rows, dtype=np.int64).reshape(len(rows), len(rules) + 1)
    return estimate(table[:, :-1], table[:, -1].astype(float), rules)


def posterior(model: Model) -> Column:
    """The probability that a text with these features is good, as one JVM expression."""
    odds = F.lit(float(np.log(model.share / (1 - model.share))))
    for rule, (good, bad) in zip(model.rules, model.weights(), strict=True):
        vote = rule.vote()
        odds = odds + F.when(vote == 1, F.lit(good)).when(vote == -1, F.lit(bad)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, least: float = 0.5) -> DataFrame:
    """One row per row: the key, the features, ``base_failed``, ``p_good`` and ``kept``.

    A text that is too short or repeats itself (``base_failed``) is never kept, another is kept if its
    posterior is ``least`` or more. Null and empty texts have no words and fail; equal
    texts get equal verdicts; a null key is a key like any other. An empty table gives no rows.
    """
    found = stage(features(docs, key, text), "quality-features")
    model = fit(found, rules)
    told = found.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("p_good", posterior(model))
    return told.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
