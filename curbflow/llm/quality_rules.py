"""Operator 1: quality rules as a learned decision list, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import stored

_GAP = r"[\x20\x09-\x0D]+"
_IN_WORD = r"[^\x20\x09-\x0D]"
# Shares of the labelled rows at which thresholds are tried.
CUTS = (0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99, 0.995)
# What rules may test: name and definition on the statistics.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "exclaims_per_word": "n_exclaims / greatest(n_words, 1)",
    "capitals_per_char": "n_capitals / greatest(word_chars, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / 1.0",
    "words": "n_words / 1.0",
}


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text (long): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and more.

    Words are runs of anything but ASCII white space; NULL has none. n_repeat_words counts words in three-word windows
    that occur twice or more: the windows are sorted with their places, neighbours compared, and the places of equal ones
    merged. All of it is array functions within the row, so nothing is exploded or shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("words", F.array_remove(F.split("text", _GAP), ""))
    rows = rows.withColumn("n", F.size("words"))
    count = F.greatest(F.col("n") - 2, F.lit(0))
    windows = F.arrays_zip(
        F.slice("words", F.lit(1), count).alias("a"),
        F.slice("words", F.lit(2), count).alias("b"),
        F.slice("words", F.lit(3), count).alias("c"),
        F.slice(F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(1))), F.lit(1), count).alias("at"),
    )
    rows = rows.withColumn("sorted", F.when(count > 0, F.sort_array(windows)).otherwise(F.sort_array(F.slice(windows, 1, 0))))
    equal = F.zip_with(
        "sorted",
        F.slice("sorted", F.lit(2), F.greatest(F.size("sorted"), F.lit(1))),
        lambda x, y: F.when((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.array(x["at"], y["at"])),
    )
    rows = rows.withColumn("places", F.sort_array(F.array_distinct(F.flatten(F.array_compact(equal)))))
    reach = F.zip_with("places", F.slice("places", F.lit(2), F.greatest(F.size("places"), F.lit(1))), lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3))))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(_IN_WORD))
    rows = rows.withColumn("lines", lines)
    count_of = {
        "n_words": F.col("n"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.aggregate(reach, F.lit(0), lambda total, x: total + x),
        "n_distinct": F.size(F.array_distinct("words")),
        "n_exclaims": F.regexp_count("text", F.lit("!")),
        "n_capitals": F.regexp_count("text", F.lit("[A-Z]")),
    }
    return rows.select("doc_id", *[value.cast("long").alias(name) for name, value in count_of.items()])


@dataclass(frozen=True)
class Test:
    """One threshold on a feature."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def rule_column(rule: Rule) -> Column:
    """The conjunction of the rule's tests."""
    return reduce(lambda a, b: a & b, [test.column() for test in rule])


def decision_list(rules: list[Rule]) -> Column:
    """The text of the first rule that holds, or NULL: an ordered conditional expression."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F
    for rule in rules:
        chain = chain.when(rule_column(rule), F.lit(" and ".join(map(str, rule))))
    return chain


def learn_rules(
    labelled: DataFrame, max_rules: int = 8, max_tests: int = 3, precision: float = 0.9, least_share: float = 0.001
) -> list[Rule]:
    """Rules that reject, by sequential covering of labelled statistics (`bad` boolean beside them).

    Two thirds of the rows (by hash of the id) grow a rule: the threshold with the highest information gain is added
    until no bad row is gained. The rest prunes it to the prefix with the best precision. The rule is kept if that is
    at least `precision` on the pruning rows and it covers `least_share` of the bad rows there; its rows leave, and the next one is
    grown. All rows count; each step is one aggregate to a fixed number of rows (features by thresholds), which is all
    the driver sees. NULL labels don't count; without bad rows there are no rules.
    """
    features = [F.expr(f"cast({text} as double)").alias(name) for name, text in FEATURES.items()]
    rows = stored(labelled.filter("bad is not null").select("*", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("fold"), *features))
    cuts = rows.agg(*[F.percentile_approx(name, list(CUTS), 10000).alias(name) for name in FEATURES]).first()
    thresholds = {name: sorted(set(cuts[name] or [])) for name in FEATURES}
    rules: list[Rule] = []
    total_bad = rows.filter("bad and fold = 0").count()
    while len(rules) < max_rules and total_bad:
        left = rows
        for rule in rules:
            left = left.filter(~rule_column(rule))
        rule = _grow(left.filter("fold <> 0"), thresholds, max_tests)
        rule = _prune(left.filter("fold = 0"), rule, precision, least_share * total_bad) if rule else ()
        if not rule:
            break
        rules.append(rule)
    return rules


def _grow(rows: DataFrame, thresholds: dict[str, list[float]], max_tests: int) -> Rule:
    import math

    rule: Rule = ()
    while len(rule) < max_tests:
        covered = rows.filter(rule_column(rule)) if rule else rows
        # The bin of a value is the number of thresholds below it: one row per feature, bin and label.
        bins = []
        for name, cuts in thresholds.items():
            bin_number = reduce(lambda a, b: a + b, [(F.col(name) > c).cast("int") for c in cuts], F.lit(0))
            bins.append(F.struct(F.lit(name).alias("feature"), bin_number.alias("bin")))
        counted = covered.select("bad", F.explode(F.array(*bins)).alias("x")).groupBy("x.feature", "x.bin")
        counted = counted.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
        bad = sum(r["bad"] for r in counted if r["feature"] == "words")
        good = sum(r["good"] for r in counted if r["feature"] == "words")
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for name, cuts in thresholds.items():
            by_bin = {r["bin"]: (r["bad"], r["good"]) for r in counted if r["feature"] == name}
            low_bad = low_good = 0
            for k, cut in enumerate(cuts):
                low_bad += by_bin.get(k, (0, 0))[0]
                low_good += by_bin.get(k, (0, 0))[1]
                for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                    gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, Test(name, above, float(cut)))
        if best[1] is None:
            break
        rule += (best[1],)
    return rule


def _prune(rows: DataFrame, rule: Rule, precision: float, least: float) -> Rule:
    sums = []
    for k in range(1, len(rule) + 1):
        own = rule_column(rule[:k])
        sums += [F.count_if(own & F.col("bad")).alias(f"bad{k}"), F.count_if(own & ~F.col("bad")).alias(f"good{k}")]
    counted = rows.agg(*sums).first()
    scored = [((counted[f"bad{k}"] + 1) / (counted[f"bad{k}"] + counted[f"good{k}"] + 2), -k) for k in range(1, len(rule) + 1)]
    best, k = max(scored)
    bad, good = counted[f"bad{-k}"], counted[f"good{-k}"]
    return rule[:-k] if bad >= max(1.0, least) and bad >= precision * (bad + good) else ()


def quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", **options) -> DataFrame:
    """The statistics of every row of docs, base_failed, `rule` (the first learned rule that holds, else NULL) and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word windows. Labels are joined on doc_id;
    a row is bad if its label (averaged, where an id has several) is below one half. The statistics are computed once and stored
    (eight numbers a row). NULL and empty texts have zero everywhere and fail the base; repeated rows are judged one by one; other
    columns are not read. Without labels no rule is learned.
    """
    statistics = stored(text_statistics(docs))
    known = labels.select(F.col("doc_id").alias("labelled"), F.col(label).cast("double").alias("y")).dropna()
    known = known.groupBy("labelled").agg((F.avg("y") < 0.5).alias("bad"))
    rules = learn_rules(statistics.join(known, F.col("doc_id") == F.col("labelled")).drop("labelled"), **options)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = statistics.withColumn("base_failed", base).withColumn("rule", decision_list(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
