"""Quality rules as weak supervision.

Every rule looks at a few counts of a text and votes good (1), bad (-1) or abstains (0). How often each
rule votes right is not set by hand: expectation-maximisation over all documents' votes estimates, per
rule and class, the share of good and bad votes, and from them each document's posterior probability
of good quality. That replaces a filter in which every rule must pass.

A vote pattern is one of at most 3^6, so EM runs on the counted patterns (a bounded table), which
hold every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_batches, settle

MIN_WORDS = 50              # base: fewer words fail
MAX_REPEAT_PERCENT = 50     # base: a larger share of words in repeated 3-word windows fails
# fixed values: the characters counted as symbols
SYMBOLS = b"#*$%&|<>"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
         "n_letters", "n_upper", "n_exclaim"]


def repeat_words(ids: np.ndarray, window: int = 3) -> int:
    """Words that lie in a ``window``-word run found twice or more (all of its places count)."""
    n = len(ids)
    if n < window + 1:
        return 0
    code = ids[:n - window + 1]
    for k in range(1, window):
        code = np.unique(code * n + ids[k:n - window + 1 + k], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(window):
        covered[k:n - window + 1 + k] |= twice
    return int(covered.sum())


def text_stats(text: bytes) -> list[int]:
    """The counts of ``STATS`` for one text (words: runs without space and \\t\\n\\v\\f\\r)."""
    words = text.split()
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    joined = b" ".join(words).decode("utf-8", "replace")
    in_words = len(joined) - max(0, len(words) - 1)
    return [len(words), in_words, sum(text.count(bytes([s])) for s in SYMBOLS),
            len(lines) - len(set(lines)), repeat_words(ids), len(lines), len(seen),
            in_words - _count(joined, _NOT_LETTERS), _count(joined, _UPPER), text.count(b"!")]


_NOT_LETTERS = "0123456789.,;:!?'\"()[]{}-_/\\#*$%&|<>@=+~^`"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"


def _count(text: str, chars: str) -> int:
    return sum(text.count(c) for c in chars)


def document_stats(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([text_stats(t) for t in as_bytes(b.column(1))], dtype=np.int64).reshape(-1, len(STATS))
        return pa.RecordBatch.from_arrays([b.column(0), *[pa.array(rows[:, i]) for i in range(len(STATS))]],
                                          names=["doc_id", *STATS])
    return map_batches(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t")),
                       run, "doc_id long, " + ", ".join(f"{c} long" for c in STATS))


def rules() -> dict[str, tuple[Column, Column]]:
    """(good, bad) conditions per rule; neither: the rule abstains. Signs that always come together
    (capitals and exclamation marks, repeated windows and a small vocabulary) are one rule, since the model takes rules
    as independent given the class."""
    c = F.col
    per_word = lambda x: c(x) / F.greatest(c("n_words"), F.lit(1))
    length = per_word("word_chars")
    dup = c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1))
    upper = c("n_upper") / F.greatest(c("n_letters"), F.lit(1))
    return {
        "long_enough": (c("n_words") >= 100, c("n_words") < 30),
        "word_length": (length.between(3, 12), (length < 2) | (length > 18)),
        "symbols": (per_word("n_symbols") < 0.05, per_word("n_symbols") > 0.2),
        "line_repeats": ((dup < 0.1) & (c("n_lines") > 1), dup > 0.4),
        "repetition": ((per_word("n_repeat_words") < 0.1) & (per_word("n_distinct") > 0.25),
                       (per_word("n_repeat_words") > 0.3) | ((per_word("n_distinct") < 0.1) & (c("n_words") < 2000))),
        "shouting": ((upper < 0.2) & (per_word("n_exclaim") < 0.05), (upper > 0.5) | (per_word("n_exclaim") > 0.25)),
    }


def votes_column() -> Column:
    """The votes as one number, base 3 (a digit is vote + 1), first rule lowest."""
    total = F.lit(0)
    for i, (good, bad) in enumerate(rules().values()):
        total = total + F.when(bad, 0).when(good, 2).otherwise(1) * (3 ** i)
    return total.cast("int")


def fit_accuracies(patterns: np.ndarray, n: np.ndarray, rounds: int = 100,
                   prior_weight: float = 0.02, max_false_alarm: float = 0.01) -> tuple[np.ndarray, np.ndarray, float]:
    """EM for a two-class model with independent votes given the class.

    ``patterns`` (k, rules) in {-1, 0, 1} with counts ``n``. Returns the posterior of good per pattern,
    ``share[class, rule]`` (share of bad votes among a rule's votes; class 0 bad, 1 good) and the prior
    of good. EM starts from "one bad vote makes a document doubtful"; weak Beta priors worth ``prior_weight``
    of the documents say that a rule's bad votes are rare for good documents. Both fix which class is which. ``max_false_alarm`` bounds a
    rule's share of bad votes on good documents: a rule that errs more often is not worth having."""
    bad, good = (patterns == -1).astype(float), (patterns == 1).astype(float)
    weight = prior_weight * max(1.0, float(n.sum()))
    belief = np.array([[0.3], [0.002]])
    share = np.repeat(belief, patterns.shape[1], axis=1)
    posterior, prior = np.where(bad.any(axis=1), 0.1, 0.95), 0.8
    for _ in range(rounds):
        for k, w in enumerate(((1 - posterior) * n, posterior * n)):
            share[k] = (w @ bad + weight * belief[k]) / (w @ (bad + good) + weight)
        share = np.clip(share, 1e-4, np.array([[1 - 1e-4], [max_false_alarm]]))
        prior = float(np.clip((posterior @ n + 0.8 * weight) / (n.sum() + weight), 0.01, 0.99))
        log = [np.log(p) + bad @ np.log(s) + good @ np.log1p(-s) for p, s in zip((1 - prior, prior), share, strict=True)]
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return posterior, share, prior


def weak_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts of ``STATS``, votes, p_quality (posterior of good quality),
    base_failed and kept.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated 3-word windows. ``kept`` is
    false then, else whether ``p_quality`` reaches ``threshold``. A null, empty or blank text has
    no words and fails the base. Repeated rows are judged each; other columns are not read."""
    spark = docs.sparkSession
    stats = settle(document_stats(docs, doc_id, text).withColumn("votes", votes_column()), "rule-stats")
    counted = stats.groupBy("votes").count().orderBy("votes").collect()  # at most 3^6 rows
    codes = np.array([r["votes"] for r in counted], dtype=np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(rules()))[None, :] % 3 - 1
    posterior, _, _ = fit_accuracies(patterns, np.array([r["count"] for r in counted], dtype=float))
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)],
                                  "votes int, p_quality double")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (stats.join(F.broadcast(table), "votes", "left")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("p_quality") >= threshold)))
