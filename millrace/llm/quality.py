"""Quality rules: text statistics and decision lists learned from labels. DataFrame functions only.

Rules are conjunctions of thresholds on statistics. They are learned one after the other
(sequential covering): a rule is grown by the condition with the best information gain, pruned on
labels that it was not grown on, and what it covers is taken out before the next. The list comes
out as one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.lines import SPACES
from millrace.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

# Thresholds are values that labelled documents have, told apart to a thousandth of the value (and to a
# millionth near 0): under 1,000 for each factor e, so some 20,000 per statistic at most.
FINENESS = 1000
NEAR_ZERO = 1000
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9  # of a rule on the labels it is pruned with
MIN_COVERED = 5  # bad documents that a rule has to cover there

# What rules may look at, by name.
FEATURES = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "n_dup_lines": "n_dup_lines",
    "repeat_share": "n_repeat_words / n_words",
}
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (bigint) and ``base_failed``.

    Words are runs of anything but ``[\\x20\\x09-\\x0D]``. Repeated words are those in five-word windows
    found twice or more in the text; windows are compared by 64-bit hash, and only texts with
    two equal windows are looked at further. NULL text has no words and no lines; so has an empty
    one. Columns with these names are replaced; rows stay as they are. No shuffle.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    kept = [c for c in docs.columns if c not in (*STATISTICS, "base_failed")]
    step = docs.select(
        F.struct(*kept).alias("_row"),
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("_words"),
        lines.alias("_lines"),
        F.char_length(F.translate(whole, SPACES, "")).alias("_word_chars"),
        (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).alias("_symbols"),
    )
    at = lambda i, k: F.get("_words", i + k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])
    )
    step = step.select(
        "_row",
        "_word_chars",
        "_symbols",
        F.size("_words").alias("_n"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup"),
        F.when(F.size("_words") >= WINDOW, windows).alias("_windows"),
    )
    step = step.withColumn("_twice", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_sorted", F.when(F.col("_twice"), F.array_sort(numbered))).drop("_windows")
    near = lambda x, k: F.get("_sorted", k)["h"].eqNullSafe(x["h"])
    again = F.transform("_sorted", lambda x, k: F.when(near(x, k - 1) | near(x, k + 1), x["i"]))
    step = step.withColumn("_again", F.array_sort(F.filter(again, lambda i: i.isNotNull()))).drop("_sorted")
    reach = F.transform("_again", lambda i, k: F.least(F.coalesce(F.get("_again", k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)))
    repeated = F.coalesce(F.aggregate(reach, F.lit(0), lambda total, n: total + n), F.lit(0))
    whole_row = step.select(
        "_row.*",
        F.col("_n").cast("bigint").alias("n_words"),
        F.col("_word_chars").cast("bigint").alias("word_chars"),
        F.col("_symbols").cast("bigint").alias("n_symbols"),
        F.col("_dup").cast("bigint").alias("n_dup_lines"),
        repeated.cast("bigint").alias("n_repeat_words"),
    )
    return whole_row.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )


@dataclass(frozen=True)
class Condition:
    """A statistic at a bin or above, or below it. ``threshold`` is the smallest value in the bin."""

    feature: str
    bin: int
    above: bool
    threshold: float

    def covers_bin(self) -> Column:
        return F.col(self.feature) >= self.bin if self.above else F.col(self.feature) < self.bin

    def covers(self) -> Column:
        value = F.expr(FEATURES[self.feature]).cast("double")
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def every(columns: Sequence[Column]) -> Column:
    out = F.lit(True)
    for column in columns:
        out = out & column
    return out


def cells(labelled: DataFrame, label: str, doc: str) -> tuple[DataFrame, dict[str, dict[float, int]]]:
    """Labelled documents counted by the bins of their statistics, and each bin by its smallest value.

    All labels count. Bins are as narrow for rare values as for frequent ones. Documents are dealt
    by the hash of their id: two of three to grow rules on, the third to prune them.
    """
    values = labelled.select(
        (F.col(label) == 0).alias("bad"),
        (F.pmod(F.xxhash64(doc), F.lit(3)) < 2).alias("grow"),
        *[F.expr(e).cast("double").alias(f) for f, e in FEATURES.items()],
    )
    binned = {f: F.floor(F.log1p(F.col(f) * NEAR_ZERO) * FINENESS).cast("int") for f in FEATURES}
    each = F.array(*[F.struct(F.lit(f).alias("feature"), b.alias("bin"), F.col(f).alias("value")) for f, b in binned.items()])
    lowest = values.select(F.explode(each).alias("f")).groupBy("f.feature", "f.bin").agg(F.min("f.value").alias("least"))
    edges: dict[str, dict[float, int]] = {f: {} for f in FEATURES}
    for r in lowest.where("bin is not null").orderBy("bin").collect():
        edges[r["feature"]][r["least"]] = r["bin"]
    counted = values.select("bad", "grow", *[b.alias(f) for f, b in binned.items()])
    counted = counted.groupBy("bad", "grow", *FEATURES).agg(F.count("*").alias("n"))
    return stored(counted, "labelled-cells"), edges


def counts(table: DataFrame, rule: Sequence[Condition]) -> list[tuple[int, int]]:
    """Bad and good documents to prune on that each beginning of a rule covers."""
    sums = []
    for k in range(1, len(rule) + 1):
        covered = every([c.covers_bin() for c in rule[:k]])
        for bad in (F.col("bad"), ~F.col("bad")):
            sums.append(F.coalesce(F.sum(F.when(covered & bad, F.col("n"))), F.lit(0)).alias(f"s{len(sums)}"))
    found = table.where(~F.col("grow")).agg(*sums).first() if sums else ()
    return [(found[i], found[i + 1]) for i in range(0, len(sums), 2)]


def best_condition(table: DataFrame, rule: Sequence[Condition], edges: dict[str, dict[float, int]]) -> Condition | None:
    """The condition with the largest information gain (FOIL) over the documents a rule covers.

    Of thresholds that part these documents alike, the one that covers most of the other values
    counts: a rule reaches from the bad documents up to the next ones.
    """
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES])).alias("f")
    covered = table.where(F.col("grow") & every([c.covers_bin() for c in rule])).select("bad", "n", each)
    sums = [F.sum(F.when(F.col("bad") == b, F.col("n")).otherwise(0)).alias(name) for b, name in ((True, "bad"), (False, "good"))]
    by_bin: dict[str, dict[int, tuple[int, int]]] = {}
    for r in covered.groupBy("f.feature", "f.bin").agg(*sums).collect():
        by_bin.setdefault(r["feature"], {})[r["bin"]] = (r["bad"], r["good"])
    best, chosen = 1e-9, None
    for feature, bounds in edges.items():
        rows = by_bin.get(feature, {})
        bad, good = (sum(n[i] for n in rows.values()) for i in (0, 1))
        if not bad or not good:
            continue
        before = math.log2(bad / (bad + good))
        low = [0, 0]  # of the bins before
        for threshold, k in bounds.items():
            for above, (p, n) in ((False, low), (True, [bad - low[0], good - low[1]])):
                gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                wider = gain == best and chosen is not None and (chosen.feature, chosen.above, above) == (feature, False, False)
                if gain > best or wider:
                    best, chosen = gain, Condition(feature, k, above, threshold)
            low = [low[i] + rows.get(k, (0, 0))[i] for i in (0, 1)]
    return chosen


def learn_rules(
    labelled: DataFrame, label: str = "quality", doc: str = "doc_id", min_precision: float = MIN_PRECISION
) -> list[Rule]:
    """Rules for bad documents (label 0), in order. ``labelled`` has the statistics and a label.

    No labels, or labels of one kind, give no rules.
    """
    table, edges = cells(labelled, label, doc)
    left = table
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS and (condition := best_condition(left, rule, edges)):
            rule.append(condition)
        # prune: the beginning of the rule that does best on labels it was not grown on
        tried = [(rule[:k], *n) for k, n in enumerate(counts(left, rule), 1)]
        good = [(r, p, n) for r, p, n in tried if p >= MIN_COVERED and p >= min_precision * (p + n)]
        if not good:
            break
        pruned = max(good, key=lambda x: ((x[1] - x[2]) / (x[1] + x[2]), x[1], -len(x[0])))[0]
        rules.append(tuple(pruned))
        left = left.where(~every([c.covers_bin() for c in pruned]))
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list: false for a document that a rule covers, tried in order, else true."""
    out = None
    for rule in rules:
        covered = every([c.covers() for c in rule])
        out = F.when(covered, False) if out is None else out.when(covered, False)
    return F.lit(True) if out is None else out.otherwise(True)


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``doc``, the statistics, ``base_failed`` and ``kept`` of every document.

    Rules are learned from all labelled documents that pass the base rules. A document labelled
    more than once is bad if most of its labels are 0; NULL labels and ids do not count. Texts are
    read once: statistics are written to the shared folder, and learning and judging use them.
    ``kept`` is false where the base rules fail or a learned rule covers the document.
    """
    numbers = stored(with_statistics(docs.select(doc, text), text).drop(text), "text-statistics")
    one = labels.where(F.col(label).isNotNull()).groupBy(doc).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    rules = learn_rules(numbers.where(~F.col("base_failed")).join(one, doc), "_label", doc)
    return numbers.withColumn("kept", ~F.col("base_failed") & verdict(rules))
