"""Quality rules: base counts of a text, and the likelihood ratio of its hashed n-grams.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials over the buckets,
smoothed by one, are counted from whole texts: one from a trusted part of the corpus, one from
all of it. A document's score is the mean over its n-grams of ln(trusted / corpus), in whole
millionths, so that sums do not depend on their order. Documents at or above a fixed threshold
are kept; the same text always gets the same verdict from the same two multinomials.

Only DataFrame functions are used. The model is one array of ``buckets`` numbers whatever the size
of the corpus; it reaches the scan as a scalar subquery. Counting pre-aggregates in every task, so
no bucket is hot. Scoring needs no shuffle.

Defined cases: a null or blank text has no words, the base counts 0, score 0 and fails the base
rule. A text of one word has one n-gram. Without any trusted text all scores are 0. Repeated rows are each
counted and judged. Of rows with a null id none is trusted. Extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestead.llm.common import SPACE, SPACES, array_sum, bind, private, words, written

SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Few enough that a bucket's counts do not hang on single documents.
    buckets: int = 1 << 13
    #: Least mean log-likelihood ratio of a kept document, in millionths of a nat.
    min_score: int = -60_000


def _bucket(*parts: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets).cast("long")).cast("int")


def _ngrams(word_list: Column, buckets: int) -> Column:
    """Buckets of all words and all pairs of neighbours."""
    return bind(
        word_list,
        lambda w: F.concat(
            F.transform(w, lambda x: _bucket(x, buckets=buckets)),
            F.transform(
                F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                lambda x, i: _bucket(F.get(w, i), x, buckets=buckets),
            ),
        ),
    )


def ngram_counts(docs: DataFrame, text: str, trusted: Column, rules: Rules) -> DataFrame:
    """(bucket, corpus, trusted): one row for every bucket, also for those that do not occur."""
    grams = docs.select(
        F.explode(_ngrams(words(F.col(text)), rules.buckets)).alias("bucket"),
        F.lit(1).cast("long").alias("c"),
        F.coalesce(trusted, F.lit(False)).cast("long").alias("t"),
    )
    none = docs.sparkSession.range(rules.buckets).select(
        F.col("id").cast("int").alias("bucket"),
        F.lit(0).cast("long").alias("c"),
        F.lit(0).cast("long").alias("t"),
    )
    return grams.union(none).groupBy("bucket").agg(F.sum("c").alias("corpus"), F.sum("t").alias("trusted"))


def likelihood_ratios(counts: DataFrame, rules: Rules) -> DataFrame:
    """(bucket, ratio in millionths of a nat) of the two multinomials, smoothed by one."""
    totals = counts.agg(
        F.struct(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))
    ).scalar()
    b = F.lit(rules.buckets)
    ratio = F.log(
        ((F.col("trusted") + 1) / (totals["trusted"] + b))
        / ((F.col("corpus") + 1) / (totals["corpus"] + b))
    )
    ratio = F.when(totals["trusted"] > 0, F.round(ratio * 1e6)).otherwise(0)
    return counts.select("bucket", ratio.cast("long").alias("ratio"))


def _dense(ratios: DataFrame) -> Column:
    """The ratios as one array indexed by bucket."""
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "ratio")))
    return ratios.agg(F.transform(pairs, lambda x: x["ratio"])).scalar()


def _repeat_words(w: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the list w.

    Windows of one text are told apart by 64-bit hashes. Sorting brings equal ones together; the
    starts that remain, in order, each cover three words or as many as there are to the next start.
    """
    windows = F.transform(
        F.slice(w, 3, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), x),
    )

    def covered(v: Column) -> Column:
        def repeated(s: Column) -> Column:
            same = lambda x, i: F.get(s, i)["h"].eqNullSafe(x["h"])
            return F.sort_array(
                F.transform(
                    F.filter(s, lambda x, i: same(x, i + 1) | same(x, i - 1)), lambda x: x["i"]
                )
            )

        starts = bind(F.sort_array(F.transform(v, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)
        return bind(
            starts,
            lambda p: array_sum(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
            ),
        )

    none = F.lit(0).cast("long")
    return bind(
        windows, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), none).otherwise(covered(v))
    )


def judge(docs: DataFrame, text: str, ratios: DataFrame, rules: Rules) -> DataFrame:
    """docs with n_words, the four base counts, n_ngrams, score, base_failed and kept."""
    holder, model = private(docs, "judged", "model")
    t = F.coalesce(F.col(text), F.lit(""))

    def counts(w: Column) -> Column:
        n = F.size(w).cast("long")
        total = array_sum(F.transform(_ngrams(w, rules.buckets), lambda b: F.get(F.col(model), b)))
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        return F.struct(
            n.alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.greatest(2 * n - 1, F.lit(0)).alias("n_ngrams"),
            F.coalesce(total, F.lit(0).cast("long")).alias("log_ratio"),
        )

    # Used once below, so the optimizer puts the subquery in its place and no row carries the model.
    judged = docs.withColumn(model, _dense(ratios)).withColumn(holder, bind(words(t), counts))
    # Filters on the verdict stay above a generator; pushed below it they would judge every text again.
    judged = judged.withColumn(holder, F.explode(F.array(F.col(holder))))
    x = F.col(holder)
    failed = (x["n_words"] < rules.min_words) | (
        100 * x["n_repeat_words"] > rules.max_repeat_percent * x["n_words"]
    )
    trusted_like = x["log_ratio"] >= rules.min_score * x["n_ngrams"]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = {n: x[n] for n in names} | {
        "score": F.when(x["n_ngrams"] > 0, x["log_ratio"] / x["n_ngrams"] / 1e6).otherwise(0.0),
        "base_failed": failed,
        "kept": ~failed & trusted_like,
    }
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in fields]
    return judged.select(*keep, *[v.alias(k) for k, v in fields.items()])


def quality_rules(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    rules: Rules = Rules(),  # noqa: B008
) -> DataFrame:
    """docs with the counts and verdicts. trusted_ids: one column, the ids of the trusted documents."""
    mark = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("trusted_id")).distinct()
    # A merge join at every size: the texts are shuffled once, and the plan does not change with the labels.
    marked = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(
        mark.hint("merge"), F.col("id") == F.col("trusted_id"), "left"
    )
    counts = written(ngram_counts(marked, "text", F.col("trusted_id").isNotNull(), rules), "ngrams")
    return judge(docs, text, likelihood_ratios(counts, rules), rules)
