"""Quality rules with a verdict per host.

Each document is measured by fixed text rules. Failures are summed by host, the
host's failure rate is pulled towards the rate of all hosts by a beta prior
whose strength comes from how much hosts differ (method of moments), and hosts
whose rate stays above a limit reject their documents too.

Defined cases: null or empty text has no words and fails; a null host has no
verdict of its own, so its documents stand on their own rules; repeated rows
count each time; an empty table gives an empty result; columns other than the
key, text and host are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import WORD, count_upto, let
from basketlens.sources.staging import Workspace

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength, in documents.
PRIOR_DOCS = (1.0, 1_000_000.0)


def _repeated_words(words: Column) -> Column:
    """Words inside a window of five words that the text holds twice or more."""

    def starts_at(windows: Column) -> Column:
        # windows: (what, at) sorted; those equal to a neighbour repeat.
        def twin(k: Column) -> Column:
            here = F.element_at(windows, k)["what"]
            left = (k > 1) & (F.element_at(windows, F.greatest(k - 1, F.lit(1)))["what"] == here)
            last = F.size(windows)
            right = (k < last) & (F.element_at(windows, F.least(k + 1, last))["what"] == here)
            return left | right

        return F.transform(
            F.filter(count_upto(F.size(windows)), twin),
            lambda k: F.element_at(windows, k)["at"],
        )

    def hashed(at: Column) -> Column:
        return F.xxhash64(*[F.element_at(words, at + k) for k in range(WINDOW)])

    def covered(starts: Column) -> Column:
        step = lambda k: F.when(
            k < F.size(starts),
            F.least(F.lit(WINDOW), F.element_at(starts, F.least(k + 1, F.size(starts))) - F.element_at(starts, k)),
        ).otherwise(WINDOW)
        return F.aggregate(
            count_upto(F.size(starts)), F.lit(0).cast("bigint"), lambda total, k: total + step(k)
        )

    # Hashes find the windows worth comparing; the texts of those decide.
    def exact(maybe: Column) -> Column:
        texts = F.transform(
            maybe,
            lambda at: F.struct(
                F.array_join(F.slice(words, at, WINDOW), " ").alias("what"), at.alias("at")
            ),
        )
        return let(F.array_sort(texts), lambda w: let(F.array_sort(starts_at(w)), covered))

    def suspicious(hashes: Column) -> Column:
        pairs = F.transform(
            hashes, lambda h, i: F.struct(h.alias("what"), (i + 1).alias("at"))
        )
        return let(
            F.array_sort(pairs), lambda w: let(starts_at(w), exact)
        )

    hashes = F.transform(count_upto(F.size(words) - (WINDOW - 1)), hashed)
    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"))
        .otherwise(suspicious(h)),
    )


def measured(documents: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Key, host and the rules' counts of every whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(
        F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    word_counts = let(
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"), _repeated_words(w).alias("n_repeat_words")
        ),
    )
    unspaced = F.translate(whole, " \t\n\x0b\x0c\r", "")
    counts = documents.select(
        F.col(key),
        F.col(host).alias("host"),
        word_counts.alias("by_word"),
        F.length(unspaced).cast("bigint").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return counts.select(
        key, "host", "by_word.n_words", "word_chars", "n_symbols", "n_dup_lines",
        "by_word.n_repeat_words",
    ).withColumn("base_failed", failed)


def host_rates(counts: DataFrame) -> DataFrame:
    """A row per host: documents, failures, and the shrunk failure rate."""
    hosts = counts.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("base_failed").cast("bigint")).alias("n_failed"),
    )
    rate = F.col("n_failed") / F.col("n_docs")
    # Three sums over hosts; n (f/n)^2 is the weighted second moment.
    docs, failed, squares = hosts.agg(
        F.sum("n_docs"), F.sum("n_failed"), F.sum(F.col("n_failed") * rate)
    ).first()
    low, high = PRIOR_DOCS
    mean = (failed or 0) / docs if docs else 0.0
    spread = squares / docs - mean * mean if docs else 0.0
    strength = high if spread <= 1e-12 else mean * (1 - mean) / spread - 1
    strength = min(high, max(low, round(strength, 6)))
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", F.round(shrunk, 9))


def host_filtered(
    documents: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """Counts, ``base_failed``, ``host_rate`` and ``kept`` for every row."""
    space = Workspace(documents.sparkSession, "host-rules")
    counts = space.save(measured(documents, key, text, host), "counts")
    rates = host_rates(counts).select("host", "host_rate")
    kept = ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= MAX_HOST_RATE)
    return counts.join(rates, "host", "left").select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept.alias("kept"), "host_rate",
    )
