"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects a document whose signal reaches a cutoff. Cutoffs come from labelled holdouts:
in every stratum (language) and for every rule, cutoffs are tested from the most lenient to the
strictest. A cutoff passes while the exact binomial test shows, at its level, that the rule rejects
at most its share of the allowed rate of good documents (equivalently: while the Clopper-Pearson
upper bound of the false rejection rate is at most that share). The first failure ends the sequence
(fixed-sequence testing needs no correction along it); the level is divided by strata times rules,
and the allowed rate by the rules. So with the stated confidence, in all strata at once, at most
``max_false_rejection`` of the good documents are rejected by any rule. Among the cutoffs that passed, the
one with the largest surplus of bad over good rejections is used, or none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.session import materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SIGNALS = ("symbol_rate", "repeated_line_rate", "repeated_word_rate", "word_length")
STEPS = (4.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03,
         0.02, 0.01)
LENGTH_STEPS = (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0)
BROADCAST_STRATA = 10_000


@dataclass(frozen=True)
class RiskSettings:
    max_false_rejection: float = 0.05
    confidence: float = 0.95

    @property
    def rate(self) -> float:
        return self.max_false_rejection / len(SIGNALS)


def bound_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with the value computed once, also inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    A window becomes one long: its hash above, its place below; sorted, equal windows are neighbours, and
    neighbours with one hash are compared word by word.
    """

    def count(w: Column) -> Column:
        places = F.pow(F.lit(2.0), F.ceil(F.log2(F.size(w).cast("double")))).cast("bigint")

        def keyed(p: Column) -> Column:
            def key(i: Column) -> Column:
                h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
                return h.bitwiseAND(-p).bitwiseOR(i)

            return F.sort_array(F.transform(F.sequence(F.lit(0).cast("bigint"), (F.size(w) - 3).cast("bigint")), key))

        def repeated(s: Column, p: Column) -> Column:
            twins = F.filter(
                F.sequence(F.lit(1), F.size(s) - 1),
                lambda j: F.get(s, j).bitwiseXOR(F.get(s, j - 1)).bitwiseAND(-p) == 0)

            def pair(j: Column) -> Column:
                x, y = (F.pmod(F.get(s, j - d), p).cast("int") for d in (0, 1))
                same = F.slice(w, x + 1, 3) == F.slice(w, y + 1, 3)
                return F.when(same, F.array(x, x + 1, x + 2, y, y + 1, y + 2)).otherwise(F.array().cast("array<int>"))

            return F.when(F.size(s) < 2, F.lit(0)).otherwise(
                F.size(F.array_distinct(F.flatten(F.transform(twins, pair)))))

        return bound_once(places, lambda p: bound_once(keyed(p), lambda s: repeated(s, p)))

    return bound_once(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(count(w)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every document; a null text counts as empty.

    Works row by row, so ids may repeat or be null, and other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
    )
    inner = F.btrim(F.col("t"), F.lit(SPACES))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \t\n\x0b\f\r]+"))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    of_words = bound_once(words, lambda w: F.struct(
        F.size(w).cast("bigint").alias("n"),
        F.char_length(F.concat_ws("", w)).cast("bigint").alias("c"),
        repeated_window_words(w).cast("bigint").alias("r")))
    of_lines = bound_once(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("d")))
    symbols = F.char_length(F.regexp_replace(F.col("t"), f"[^{SYMBOLS}]+", "")).cast("bigint")
    return rows.select(
        "doc_id", "stratum", of_words.alias("w"), of_lines.alias("l"), symbols.alias("n_symbols"),
    ).select(
        "doc_id", "stratum", F.col("w.n").alias("n_words"), F.col("w.c").alias("word_chars"), "n_symbols",
        F.col("l.d").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"), F.col("l.n").alias("n_lines"),
    )


def with_signals(counts: DataFrame) -> DataFrame:
    """The four signals and the fixed base rule; the higher a signal, the worse."""
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumns({
        "symbol_rate": ratio("n_symbols", "n_words"),
        "repeated_line_rate": ratio("n_dup_lines", "n_lines"),
        "repeated_word_rate": ratio("n_repeat_words", "n_words"),
        "word_length": ratio("word_chars", "n_words"),
        "base_failed": base,
    })


def log_binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """ln P(Binomial(n, rate) <= k), exact to rounding.

    Terms are added from k downwards in units of the k-th; they shrink geometrically when k is below
    the mean (above it the test cannot pass, and 0 is returned), so 60 standard deviations hold all.
    """
    ln_k = F.aggregate(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
        F.lit(0.0),
        lambda acc, i: acc + F.when(k < 1, 0.0).otherwise(F.log((n - i + 1).cast("double") / i.cast("double"))),
    ) + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate))
    steps = F.least(k, F.ceil(60 * F.sqrt(n * rate)) + 60).cast("bigint")
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def add(acc: Column, j: Column) -> Column:
        top = (k - j + 1).cast("double")
        term = F.when(j < 1, F.lit(0.0)).otherwise(
            acc["t"] * top * (1 - rate) / ((n - k + j).cast("double") * rate))
        return F.struct(term.alias("t"), (acc["s"] + term).alias("s"))

    total = F.aggregate(F.sequence(F.when(steps < 1, F.lit(0).cast("bigint")).otherwise(F.lit(1).cast("bigint")), steps),
                        start, add, lambda acc: acc["s"])
    return F.when(k.cast("double") >= n * rate, F.lit(0.0)).otherwise(ln_k + F.log(total))


def certify(labelled: DataFrame, cfg: RiskSettings | None = None) -> DataFrame:
    """Every tested cutoff of every stratum and rule: counts, ln p-value, whether it passed.

    ``labelled`` has the signals, ``stratum`` and ``quality`` (1: good). One aggregation counts, per
    stratum, rule and grid step, the documents whose strictest unreached cutoff it is; sums over the few
    steps then give the rejections of each cutoff.
    """
    cfg = cfg or RiskSettings()
    hits = []
    for name in SIGNALS:
        grid = LENGTH_STEPS if name == "word_length" else STEPS
        level = F.lit(len(grid))
        for step in range(len(grid) - 1, -1, -1):
            level = F.when(F.col(name) >= grid[step], step).otherwise(level)
        hits.append(F.struct(F.lit(name).alias("rule"), level.alias("step")))
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    counted = (
        labelled.filter(~F.col("base_failed") & F.col("quality").isin(0, 1))
        .select("stratum", "quality", F.explode(F.array(*hits)).alias("h"))
        .groupBy("stratum", F.col("h.rule").alias("rule"), F.col("h.step").alias("first_step"))
        .agg(F.count_if(good).alias("good"), F.count_if(bad).alias("bad"))
    )
    gathered = counted.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
        F.collect_list(F.struct("first_step", "good", "bad")).alias("c"))  # one entry per grid step at most
    rejected = lambda c, step, part: F.aggregate(
        c, F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(x["first_step"] <= step, x[part]).otherwise(0))
    grids = F.create_map(*[x for name in SIGNALS for x in (
        F.lit(name), F.lit(list(LENGTH_STEPS if name == "word_length" else STEPS)))])
    tests = gathered.select("stratum", "rule", "n_good", "n_bad", "c",
                            F.posexplode(F.element_at(grids, F.col("rule"))).alias("step", "cutoff"))
    tests = tests.select("stratum", "rule", "step", "cutoff", "n_good", "n_bad",
                         rejected(F.col("c"), F.col("step"), "good").alias("good_rejected"),
                         rejected(F.col("c"), F.col("step"), "bad").alias("bad_rejected"))
    strata = gathered.select(F.count_distinct("stratum").alias("strata"))
    tests = tests.crossJoin(F.broadcast(strata))  # one row
    ln_p = log_binomial_tail(F.col("n_good"), F.col("good_rejected"), cfg.rate)
    limit = F.log((1 - cfg.confidence) / (F.col("strata") * len(SIGNALS)))
    tests = tests.withColumn("ln_p", ln_p).withColumn("ok", F.col("ln_p") <= limit)
    first_fail = tests.groupBy("stratum", "rule").agg(F.min(F.when(~F.col("ok"), F.col("step"))).alias("fail"))
    return tests.join(first_fail, ["stratum", "rule"]).withColumn(
        "passed", F.col("fail").isNull() | (F.col("step") < F.col("fail"))).drop("fail", "strata", "ok")


def choose_cutoffs(tests: DataFrame) -> DataFrame:
    """One row per stratum with the chosen cutoff of each rule (null: the rule is not used there)."""
    surplus = F.col("bad_rejected") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("good_rejected") / F.greatest(
        F.col("n_good"), F.lit(1))
    usable = tests.filter("passed").withColumn("surplus", F.round(surplus, 9)).filter(F.col("surplus") > 0)
    best = usable.groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct("surplus", -F.col("step"))).alias("cutoff"))
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"max_{name}") for name in SIGNALS])


def judge(docs: DataFrame, labels: DataFrame, cfg: RiskSettings | None = None) -> DataFrame:
    """Counts, base rule and verdict per row of ``docs`` (doc_id, text, lang); labels: doc_id, quality.

    The counts of all rows are written once and used for the holdouts and for the verdicts. Every row gets a
    verdict; a stratum without enough labels to certify a cutoff has only the base rule. Labels of unknown ids
    or other values are ignored; a repeated label counts once per row. Strata are few: their cutoffs are broadcast
    after a row count, beyond 10,000 the join is left to adaptive execution.
    """
    counts = materialize(measure(docs), "quality-counts")
    rows = with_signals(counts)
    labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    cutoffs = materialize(choose_cutoffs(certify(rows.join(labels, "doc_id"), cfg)), "quality-cutoffs")
    small = cutoffs.count() <= BROADCAST_STRATA
    judged = rows.join(F.broadcast(cutoffs) if small else cutoffs, "stratum", "left")
    rejected = F.lit(False)
    for name in SIGNALS:
        rejected = rejected | F.coalesce(F.col(name) >= F.col(f"max_{name}"), F.lit(False))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~rejected).alias("kept"))
