"""Quality rules with risk-controlled thresholds.

A rule rejects a text whose feature exceeds a cutoff.  Cutoffs are chosen per stratum from a fixed
ladder: for each cutoff the labelled good documents that it would reject are counted, and a cutoff
is allowed only if the exact binomial upper bound of its false-rejection rate is below the rule's
share of the allowed risk.  The confidence is divided by the number of cutoffs tried over all
strata and rules (Bonferroni), and the risk by the number of rules, so with probability
``confidence`` no stratum loses more than ``risk`` of its good documents.  Of the allowed cutoffs
the strictest is taken; a stratum with too few labels gets no rule at all.

``joint_thresholds`` spends the same risk on the rules together and needs far fewer labels; callers choose
it with ``quality_verdicts(..., choose=joint_thresholds)``.  Its cutoffs differ from those of ``thresholds``.

The bound needs no search: the upper bound of k rejections among n is below the risk r exactly when
P(Binomial(n, r) <= k) is at most the error allowed.

All of it is DataFrame work.  A text is read once; its features are written, as the counts and the
verdicts both need them.

Defined cases: null text has no words; a text without words fails the base rule; a null stratum is
a stratum of its own; labels of unknown documents and null labels are ignored; a document labelled
more than once counts as good if every label says so.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abundix.operators.scaling import join_on
from abundix.session import cut_lineage

# White space that parts words.
_SPACES = " \t\n\x0b\f\r"
_WORD = "[^\\x20\\x09-\\x0D]"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Feature (hundredths of a percent, or characters times 100 for word length) -> ladder of cutoffs, strictest first.
LADDERS: dict[str, Sequence[int]] = {
    "symbols": (200, 500, 1000, 2000),
    "capitals": (1500, 3000, 5000),
    "exclaims": (300, 1000),
    "word_length": (800, 1200),
    "repeats": (3000,),
}
RISK = 0.02


def text_counts() -> dict[str, Column]:
    """Word array and counts of ``_text``, as columns to be added one after the other."""
    shorter = F.greatest(F.size("_words") - 2, F.lit(0))
    return {
        "_words": F.split(F.trim("_text", F.lit(_SPACES)), "[\\x20\\x09-\\x0D]+"),
        "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(_WORD)),
        "n_words": F.when(F.get("_words", F.lit(0)) == "", F.lit(0)).otherwise(F.size("_words")).cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace("_text", "\\P{Lu}+", "")).cast("long"),
        "n_exclaims": (F.length("_text") - F.length(F.replace("_text", F.lit("!"), F.lit("")))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.transform(
            F.arrays_zip(*[F.slice("_words", F.lit(i), shorter).alias(f"w{i}") for i in (1, 2, 3)]), lambda w: F.xxhash64(w)
        ),
        "_repeated": F.size(F.array_distinct("_windows")) < F.size("_windows"),
    }


def _repeat_counts() -> dict[str, Column]:
    """Words inside windows found twice or more: windows are sorted next to their equals, and the places joined up.

    A text without a repeated window, as most are, skips the sort.
    """

    def same(k: Column, x: Column) -> Column:
        return F.get("_placed", k)["w"].eqNullSafe(x["w"])

    return {
        "_placed": F.when(
            F.col("_repeated"), F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        ),
        "_places": F.sort_array(
            F.transform(F.filter("_placed", lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"])
        ),
        "n_repeat_words": F.coalesce(
            F.aggregate(
                "_places",
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(3))).alias("n"), p.alias("last")),
                lambda a: a["n"],
            ),
            F.lit(0).cast("long"),
        ),
    }


def quality_features(docs: DataFrame, doc_id: str, text: str, stratum: str) -> DataFrame:
    """Counts of every text and the features the rules look at; one row per row of ``docs``."""
    out = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    for name, column in (text_counts() | _repeat_counts()).items():
        out = out.withColumn(name, column)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))

    def share(part: str, whole: str) -> Column:
        return F.expr(f"if({whole} = 0, 0L, ({part} * 10000) div {whole})")

    return out.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbols"),
        share("n_dup_lines", "n_lines").alias("dup_lines"),
        share("n_repeat_words", "n_words").alias("repeats"),
        share("n_capitals", "word_chars").alias("capitals"),
        share("n_exclaims", "word_chars").alias("exclaims"),
        F.expr("if(n_words = 0, 0L, (word_chars * 100) div n_words)").alias("word_length"),
    )


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series moved up by ten so that it holds for small n as well."""
    z = n + 11.0
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    shift = F.lit(0.0)
    for i in range(1, 11):
        shift = shift + F.log(n + float(i))
    return series - shift


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k <= n * p: the term at k, times the falling series below it.

    The series is cut where its terms can no longer matter: they fall at least as fast as a normal
    curve with the binomial's width, so 9 widths (and 64 terms) below k nothing is left.
    """
    n, k = n.cast("double"), k.cast("double")
    at = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log1p(F.lit(-p))
    terms = F.least(k, F.ceil(9 * F.sqrt(n * p * (1 - p))) + 64).cast("int")
    # 1 + r(k) * (1 + r(k-1) * (1 + ...)) from the innermost outwards, r(i) = i * (1-p) / ((n-i+1) * p)
    first = k - terms
    below = F.aggregate(
        F.sequence(F.lit(1), F.greatest(terms, F.lit(1))),
        F.lit(0.0),
        lambda s, j: (1 + s) * (first + j) * (1 - p) / ((n - (first + j) + 1) * p),
    )
    return F.exp(at) * (1 + F.when(terms > 0, below).otherwise(0.0))


def _good_marks(labels: DataFrame, label_id: str, good: str) -> DataFrame:
    marks = labels.where(F.col(good).isNotNull()).groupBy(F.col(label_id).alias("doc_id")).agg(F.min(good).alias("_good"))
    return marks.where("_good = 1").select("doc_id")


def thresholds(
    features: DataFrame,
    labels: DataFrame,
    label_id: str = "doc_id",
    good: str = "quality",
    ladders: Mapping[str, Sequence[int]] = LADDERS,
    risk: float = RISK,
    confidence: float = 0.95,
) -> DataFrame:
    """Per stratum the cutoff of each rule (null: no cutoff is safe)."""
    held = features.where("not base_failed").join(_good_marks(labels, label_id, good), "doc_id")
    tries = [(rule, cut) for rule, ladder in ladders.items() for cut in ladder]
    counted = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col(rule) > cut, 1)).alias(f"{rule}_{cut}") for rule, cut in tries],
    )
    counted = cut_lineage(counted)  # a row per stratum
    strata = counted.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).cast("double")).scalar()
    error = F.lit((1 - confidence) / max(1, len(tries))) / strata
    share = risk / max(1, len(ladders))
    out = counted.withColumn("_error", error)
    picked = []
    for rule, ladder in ladders.items():
        best = F.lit(None).cast("long")
        for cut in reversed(ladder):
            k = F.col(f"{rule}_{cut}")
            safe = F.when(k <= F.col("n") * share, binomial_tail(F.col("n"), k, share) <= F.col("_error")).otherwise(False)
            best = F.when(safe, F.lit(cut).cast("long")).otherwise(best)
        picked.append(best.alias(f"max_{rule}"))
    return out.select("stratum", F.col("n").alias("n_good"), *picked)


def joint_steps(ladders: Mapping[str, Sequence[int]]) -> list[tuple[str, int]]:
    """The order in which a rule set grows: the loosest cutoff of every rule, then the next stricter of every rule, and so on."""
    loosest_first = {rule: list(reversed(ladder)) for rule, ladder in ladders.items()}
    longest = max(map(len, ladders.values()), default=0)
    return [(rule, ladder[i]) for i in range(longest) for rule, ladder in loosest_first.items() if i < len(ladder)]


def joint_thresholds(
    features: DataFrame,
    labels: DataFrame,
    label_id: str = "doc_id",
    good: str = "quality",
    ladders: Mapping[str, Sequence[int]] = LADDERS,
    risk: float = RISK,
    confidence: float = 0.95,
) -> DataFrame:
    """Per stratum the cutoff of each rule, with the whole risk spent on the rules together.

    The rule set grows in the order of ``joint_steps``, and what it rejects altogether is tested until a
    set fails.  The order is fixed before the labels are seen, so every set is tested with the stratum's
    whole share of the error; the shares are equal parts over the strata with labels and their pool.

    A stratum in which no set could pass even without a false rejection takes the sets that pass on the
    labels of all strata together (``pooled``), as long as its own labels lose no more than ``risk``.
    For such a stratum the bound holds on the pool, not on its own documents.
    """
    steps = joint_steps(ladders)
    marks = _good_marks(labels, label_id, good).withColumn("_held", F.lit(True))
    held = F.col("_held") & ~F.col("base_failed")
    failing, grown = F.lit(False), []
    for i, (rule, cut) in enumerate(steps):
        failing = failing | (F.col(rule) > cut)
        grown.append(F.count(F.when(held & failing, 1)).alias(f"k{i}"))
    counted = features.join(marks, "doc_id", "left").groupBy("stratum").agg(F.count(F.when(held, 1)).alias("n"), *grown)
    counted = cut_lineage(counted)  # a row per stratum
    tested = counted.agg((F.count(F.when(F.col("n") > 0, 1)) + 1).cast("double")).scalar()
    error = F.lit(1 - confidence) / tested

    def passed(safe: list[Column]) -> Column:
        """How many sets pass before the first that fails."""
        return (F.array_position(F.array(*safe, F.lit(False)), F.lit(False)) - 1).cast("int")

    def lost_little(i: int) -> Column:
        return F.col(f"k{i}") <= F.col("n") * risk

    def safe(i: int) -> Column:
        # without labels nothing is safe
        return F.when((F.col("n") > 0) & lost_little(i), binomial_tail(F.col("n"), F.col(f"k{i}"), risk) <= F.col("_error")).otherwise(False)

    numbers = range(len(steps))
    total = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *[f"k{i}" for i in numbers])])
    pool = cut_lineage(total.withColumn("_error", error).select(passed([safe(i) for i in numbers]).alias("passed"))).scalar()
    out = counted.withColumn("_error", error).withColumn("pooled", F.col("n") * F.log1p(F.lit(-risk)) > F.log("_error"))
    own = passed([safe(i) for i in numbers])
    lent = F.least(pool, passed([lost_little(i) for i in numbers]))
    out = out.withColumn("_passed", F.when(F.col("pooled"), lent).otherwise(own))
    picked = []
    for rule in ladders:
        best = F.lit(None).cast("long")
        for i, (name, cut) in enumerate(steps):
            if name == rule:
                best = F.when(F.col("_passed") > i, F.lit(cut).cast("long")).otherwise(best)
        picked.append(best.alias(f"max_{rule}"))
    return out.select("stratum", F.col("n").alias("n_good"), "pooled", *picked)


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    ladders: Mapping[str, Sequence[int]] = LADDERS,
    choose: Callable[..., DataFrame] = thresholds,
    **options,
) -> DataFrame:
    """Counts, ``base_failed``, the rules that reject (``rejected_by``) and ``kept``, per row of ``docs``.

    ``choose`` gives the cutoffs: ``thresholds``, or ``joint_thresholds``.
    """
    features = cut_lineage(quality_features(docs, doc_id, text, stratum))
    cutoffs = cut_lineage(choose(features, labels, ladders=ladders, **options))
    judged = join_on(features, cutoffs, ["stratum"], "left", null_safe=True)
    hits = [F.when(F.col(rule) > F.col(f"max_{rule}"), F.lit(rule)) for rule in ladders]
    judged = judged.withColumn("rejected_by", F.array_compact(F.array(*hits)))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"),
        F.array_join("rejected_by", ",").alias("rejected_by"),
    )
