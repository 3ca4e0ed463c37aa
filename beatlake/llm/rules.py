"""Quality rules as a learned decision list, applied as one ordered Spark conditional expression.

Sequential covering: a conjunction of thresholds is grown on two thirds of the labelled statistics, pruned on
the rest, and kept if it is precise there and on all; the rows that it covers leave, and the next one is grown.
A threshold lies halfway between two neighbouring values; every such place is tried. The list rejects a document at the first conjunction that holds and keeps it if none does.

Statistics are built-in expressions over each text; only labelled statistics (numbers, at most ``LIMIT`` rows
a class) come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import SPACE_CLASS, SPACES, free_name, lowest, numbered_rows, saved

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LIMIT = 6_000
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVER = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Shares that rules are learned from; counts alone would make every long text look alike.
SHARES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    value: float

    def column(self) -> Column:
        return F.col(self.name) >= self.value if self.above else F.col(self.name) < self.value

    def holds(self, row: dict[str, float]) -> bool:
        return (row[self.name] >= self.value) == self.above

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.value:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class DecisionList:
    """Conjunctions that reject, in order."""

    rules: Sequence[Rule] = field(default_factory=tuple)

    def keeps(self) -> Column:
        """The list as one conditional expression over the statistics; never NULL."""
        verdict = None
        for rule in self.rules:
            holds = rule[0].column()
            for condition in rule[1:]:
                holds = holds & condition.column()
            verdict = F.when(holds, F.lit(False)) if verdict is None else verdict.when(holds, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def keep(self, row: dict[str, float]) -> bool:
        return not any(all(condition.holds(row) for condition in rule) for rule in self.rules)


def with_statistics(documents: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Counts and shares of each text after the frame's own columns, their names led by ``prefix``.

    Three-word windows are compared by their 64-bit hash within one text. They are sorted only in texts that
    have an equal pair; the words that equal windows cover are counted once each.
    """
    p = prefix
    source = F.coalesce(F.col(text), F.lit(""))
    space = SPACE_CLASS.replace("\\", "\\\\")
    step = documents.withColumn(f"{p}t", source)
    step = step.withColumn(f"{p}w", F.expr(f"array_remove(split({p}t, '{space}'), '')"))
    lines = f"filter(split({p}t, '\\n'), line -> line rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    step = step.withColumn(f"{p}l", F.expr(lines)).withColumn(
        f"{p}h",
        F.expr(
            f"CASE WHEN size({p}w) < 3 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size({p}w) - 3), "
            f"i -> xxhash64(get({p}w, i), get({p}w, i + 1), get({p}w, i + 2))) END"
        ),
    )
    step = step.withColumn(
        f"{p}s",
        F.expr(
            f"CASE WHEN size(array_distinct({p}h)) < size({p}h) "
            f"THEN sort_array(transform({p}h, (x, i) -> struct(x AS x, i AS i))) END"
        ),
    )
    step = step.withColumn(
        f"{p}d", F.expr(f"filter({p}s, (e, k) -> e.x <=> get({p}s, k + 1).x OR e.x <=> get({p}s, k - 1).x)")
    )
    length = f"length({p}t)"
    step = step.withColumns(
        {
            f"{p}n_words": F.expr(f"bigint(size({p}w))"),
            f"{p}word_chars": F.length(F.translate(F.col(f"{p}t"), SPACES, "")).cast("long"),
            f"{p}n_symbols": F.expr(f"bigint({length} - length(translate({p}t, '{SYMBOLS}', '')))"),
            f"{p}n_dup_lines": F.expr(f"bigint(size({p}l) - size(array_distinct({p}l)))"),
            f"{p}n_repeat_words": F.expr(
                f"CASE WHEN {p}d IS NULL THEN 0L ELSE bigint(size(array_distinct(flatten("
                f"transform({p}d, e -> array(e.i, e.i + 1, e.i + 2)))))) END"
            ),
            f"{p}n_lines": F.expr(f"bigint(size({p}l))"),
            f"{p}n_upper": F.expr(f"bigint({length} - length(translate({p}t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))"),
            f"{p}n_marks": F.expr(f"bigint({length} - length(translate({p}t, '!?.,;:', '')))"),
            f"{p}n_distinct": F.expr(f"bigint(size(array_distinct({p}w)))"),
        }
    )
    counts = [f"{p}{name}" for name in (*BASE, "n_lines", "n_upper", "n_marks", "n_distinct")]
    step = step.select(*[F.col(f"`{name}`") for name in documents.columns], *counts)
    return step.withColumns(
        {f"{p}{name}": F.col(f"{p}{part}") / F.greatest(f"{p}{whole}", F.lit(1)) for name, (part, whole) in SHARES.items()}
    )


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def learn(rated: DataFrame, labels: DataFrame, prefix: str = "", limit: int = LIMIT) -> DecisionList:
    """A decision list for label ``quality`` from at most ``limit`` labelled rows a class, lowest hashes first.

    Rows that fail the base rules are left out, as those rules come first. Without rows of both classes the
    list is empty and keeps everything.
    """
    names = list(SHARES)
    truth = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    )
    # Filtered only once written: a filter that Spark pushes below the statistics repeats them for every window.
    numbers = rated.select(
        "doc_id", base_failed(prefix).alias("failed"), *[F.col(f"{prefix}{name}").alias(name) for name in names]
    )
    joined = saved(numbers.join(truth, "doc_id").withColumn("turn", F.xxhash64("doc_id")), "rules-labelled")
    joined = joined.where("NOT failed")
    rows = [
        (row.turn, row.label == 0, {f"{prefix}{name}": row[name] for name in names})
        for value in (0, 1)
        for row in lowest(joined.where(F.col("label") == value), limit, *names)
    ]
    grow = [(bad, row) for turn, bad, row in rows if turn % 3]
    prune = [(bad, row) for turn, bad, row in rows if not turn % 3]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(bad for bad, _ in grow):
        rule = _pruned(_grown(grow, [f"{prefix}{name}" for name in names]), prune)
        if not rule:
            break
        hit = [bad for bad, row in grow + prune if _all(rule, row)]
        unseen = [bad for bad, row in prune if _all(rule, row)]
        if len(hit) < MIN_COVER or not unseen:
            break
        if sum(hit) < MIN_PRECISION * len(hit) or sum(unseen) < MIN_PRECISION * len(unseen):
            break
        rules.append(rule)
        grow = [(bad, row) for bad, row in grow if not _all(rule, row)]
        prune = [(bad, row) for bad, row in prune if not _all(rule, row)]
    return DecisionList(tuple(rules))


def _all(rule: Rule, row: dict[str, float]) -> bool:
    return all(condition.holds(row) for condition in rule)


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """FOIL's gain of going from all rows to those that a condition leaves."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _grown(rows: list[tuple[bool, dict[str, float]]], names: list[str]) -> Rule:
    rule: list[Condition] = []
    left = rows
    while len(rule) < MAX_CONDITIONS:
        all_bad = sum(bad for bad, _ in left)
        all_good = len(left) - all_bad
        if not all_bad or not all_good:
            break
        best, chosen = 0.0, None
        for name in names:
            ordered = sorted((row[name], bad) for bad, row in left)
            below = 0
            for seen, (value, bad) in enumerate(ordered):
                before = ordered[seen - 1][0] if seen else value
                if before < value:
                    for above, b, n in ((True, all_bad - below, len(left) - seen), (False, below, seen)):
                        gain = _gain(b, n - b, all_bad, all_good)
                        if gain > best:
                            best, chosen = gain, Condition(name, above, (before + value) / 2)
                below += bad
        if chosen is None:
            break
        rule.append(chosen)
        left = [(bad, row) for bad, row in left if chosen.holds(row)]
    return tuple(rule)


def _pruned(rule: Rule, rows: list[tuple[bool, dict[str, float]]]) -> Rule:
    """The shortest front of the rule with the best (bad - good) / (bad + good) on rows not grown on."""
    best, chosen = -2.0, rule
    for size in range(1, len(rule) + 1):
        hit = [bad for bad, row in rows if _all(rule[:size], row)]
        worth = (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0
        if worth > best:
            best, chosen = worth, rule[:size]
    return chosen


def rate(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row a document: doc_id, n_words, the four base counts, base_failed and kept.

    A NULL text counts as empty; empty texts and texts under fifty words fail the base rules. Repeated rows are
    rated alike. Without labels of both classes only the base rules decide. No rows give no rows. Further
    columns are neither read nor returned.
    """
    rated = saved(with_statistics(documents.select("doc_id", "text")).drop("text"), "rules-statistics")
    verdict = learn(rated, labels).keeps()
    return rated.select("doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & verdict).alias("kept"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rules and the learned list, with all their columns as they are.

    Only numbers are written where ids are unique, as what a stage leaves behind lies beside all later ones.
    """
    names = documents.columns
    prefix = free_name("rules_", [name[:6] for name in names])
    row = free_name(f"{prefix}row", names)
    numbered = numbered_rows(documents, row, "rules-documents")
    rated = saved(with_statistics(numbered.select(row, "doc_id", "text"), prefix=prefix).drop("text"), "rules-statistics")
    verdict = learn(rated, labels, prefix).keeps()
    good = rated.where(~base_failed(prefix) & verdict).select(row)
    return numbered.join(good, row, "left_semi").select(*[F.col(f"`{name}`") for name in names])
