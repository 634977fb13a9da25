"""Quality rules: counts of every text, and a decision list learned from labelled rows by sequential covering.

All of it is column expressions and aggregates.  The counts of a text are written once; labelled rows
join them by ``doc_id``.  One aggregate gives the histogram of each measure by label, from which at most
``CUTS`` thresholds a measure are chosen by information gain; a second one counts labels in the cells that
those thresholds cut out, so that what reaches the driver is bounded by the number of measures and cuts
and covers all labelled rows.  From these statistics a rule is grown, condition by condition, on two folds
of three, pruned on the third, and what it covers is taken away before the next one.  The list becomes
one chain of ``when`` conditions over the counts; a document that no rule meets is kept.

Words in repeated windows are found within the row: every window of three words gets ``HASH_BITS`` bits of hash.  Where
a hash comes twice, hash and place go into one number, the numbers are sorted, and neighbours of one hash are
repeated windows.  Their words are compared; a text in which two windows share a hash without sharing their
words, or with too many words for the places, has its windows sorted as text instead, so the count is exact.

Edge cases: a null text counts as one without words and fails the base rule as empty and short ones do; lines
without a word are no repeated lines; very long texts are read whole; a label without its document, a null label and a null
``doc_id`` teach nothing; several labels of one document each count; without labels of both kinds the list is
empty and the base rule decides; an empty table gives an empty result; repeated rows are judged each on its own, and
columns other than the identifier and the text are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import documents, shared_dir

SPACES = " \t\n\x0b\f\r"
GAPS, WORD_IN = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
WINDOW = 3
HASH_BITS, PLACE_BITS = 40, 24
CUTS, FOLDS, LEVELS = 4, 3, 1000
MAX_RULES, MAX_CONDITIONS = 12, 4
#: A rule has to hold for so large a share of the labelled rows it meets, and to meet so many of the class it is for.
PRECISION, LEAST_MET = 0.95, 3
LEAST_WORDS, REPEAT_PERCENT = 50, 50

#: Measures of a text in thousandths, from its counts; ratios of nothing are 0.
MEASURES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "line_share": ("n_lines", "n_words"),
}


def _window_hashes(hashes: Column) -> Column:
    """``HASH_BITS`` bits for every window of three words, from the hashes of its words."""
    later = lambda i, k: F.coalesce(F.get(hashes, i + k), F.lit(0))
    joined = lambda x, i: x.bitwiseXOR(F.shiftrightunsigned(later(i, 1), 7)).bitwiseXOR(F.shiftleft(later(i, 2), 9))
    mixed = lambda x, i: F.shiftrightunsigned(joined(x, i), 64 - HASH_BITS)
    return F.slice(F.transform(hashes, mixed), 1, F.size(hashes) - (WINDOW - 1))


def _repeated(windows: Column) -> Column:
    """Hash and place, from 1, of the windows whose hash comes twice and more, in one number, sorted."""
    packed = F.sort_array(F.transform(windows, lambda x, i: F.shiftleft(x, PLACE_BITS).bitwiseOR((i + 1).cast("long"))))
    of = lambda x: F.shiftrightunsigned(x, PLACE_BITS)
    # No hash is below 0, so the ends of the list have no equal beside them.
    beside = lambda s, i: F.coalesce(of(F.get(s, i)), F.lit(-1))
    kept = lambda s: F.filter(s, lambda x, i: (of(x) == beside(s, i - 1)) | (of(x) == beside(s, i + 1)))
    return F.flatten(F.transform(F.array(packed), kept))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _clash(repeated: Column, words: Column) -> Column:
    """Whether two neighbours of one hash differ in their words."""
    at = lambda x, k: F.element_at(words, (_place(x) + k).cast("int"))
    differ = lambda x, y: reduce(lambda a, b: a | b, [at(x, k) != at(y, k) for k in range(WINDOW)])
    hash_of = lambda x: F.shiftrightunsigned(x, PLACE_BITS)
    before = lambda i: F.get(repeated, i - 1)
    checked = F.transform(repeated, lambda x, i: (i > 0) & (hash_of(x) == hash_of(before(i))) & differ(x, before(i)))
    return F.exists(checked, lambda x: F.coalesce(x, F.lit(False)))


def _places_by_text(words: Column, n: Column) -> Column:
    """Places of repeated windows by sorting the windows themselves."""
    place = F.sequence(F.lit(1).cast("long"), n - (WINDOW - 1))
    window = lambda i: F.struct(F.array_join(F.slice(words, i.cast("int"), WINDOW), " ").alias("w"), i.alias("i"))
    ordered = F.array_sort(F.transform(place, window))
    same = lambda x, s, i: F.coalesce(x["w"] == F.get(s, i)["w"], F.lit(False))
    kept = lambda s: F.filter(s, lambda x, i: same(x, s, i - 1) | same(x, s, i + 1))
    return F.sort_array(F.transform(F.flatten(F.transform(F.array(ordered), kept)), lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words under windows at sorted ``places``."""
    new = F.transform(places, lambda x, i: F.least(F.lit(WINDOW).cast("long"), x - F.coalesce(F.get(places, i - 1), x - WINDOW)))
    return F.aggregate(new, F.lit(0).cast("long"), lambda total, x: total + x)


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row's text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    less = lambda pattern: (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")
    trimmed = F.btrim(F.col("text"), F.lit(SPACES))
    rows = rows.withColumn("words", F.when(trimmed != "", F.split(trimmed, GAPS)).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_IN)))
    rows = rows.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        less(r"[#*$%&|<>]+").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        less(r"\p{Lu}+").alias("n_upper"),
        less(r"\p{P}+").alias("n_marks"),
    )
    n, words = F.col("n_words"), F.col("words")
    none = F.array().cast("array<bigint>")
    fits = (n >= WINDOW) & (n < (1 << PLACE_BITS))
    rows = rows.withColumn("hashes", F.when(fits, F.transform(words, lambda w: F.xxhash64(w))).otherwise(none))
    rows = rows.withColumn("windows", F.when(F.size("hashes") > 0, _window_hashes(F.col("hashes"))).otherwise(none)).drop("hashes")
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("repeated", F.when(twice, _repeated(F.col("windows"))).otherwise(none)).drop("windows")
    by_text = (n >= (1 << PLACE_BITS)) | _clash(F.col("repeated"), words)
    places = F.when(by_text, _places_by_text(words, n)).otherwise(F.sort_array(F.transform("repeated", _place)))
    rows = rows.withColumn("places", F.when((n >= (1 << PLACE_BITS)) | (F.size("repeated") > 0), places).otherwise(none))
    return rows.withColumn("n_repeat_words", _covered(F.col("places"))).drop("words", "repeated", "places")


def measured() -> dict[str, Column]:
    """Each measure as a whole number of thousandths, ``LEVELS`` at most, and the mean length of words in tenths."""
    share = lambda over, of: F.coalesce(F.floor(F.lit(1000) * F.col(over) / F.nullif(F.col(of), F.lit(0))), F.lit(0))
    out = {name: share(*parts) for name, parts in MEASURES.items()}
    out["word_length"] = F.coalesce(F.floor(F.lit(10) * F.col("word_chars") / F.nullif(F.col("n_words"), F.lit(0))), F.lit(0))
    return {name: F.least(F.greatest(value, F.lit(0)), F.lit(LEVELS)).cast("int") for name, value in out.items()}


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: int

    def holds(self, values: dict[str, int]) -> bool:
        return (values[self.measure] > self.threshold) == self.above

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that marks a text as of low quality."""

    conditions: tuple[Condition, ...]

    def meets(self, values: dict[str, int]) -> bool:
        return all(c.holds(values) for c in self.conditions)

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))

    def column(self, measures: dict[str, Column]) -> Column:
        one = [measures[c.measure] > c.threshold if c.above else measures[c.measure] <= c.threshold for c in self.conditions]
        return reduce(lambda a, b: a & b, one)


def _entropy(bad: int, good: int) -> float:
    total = bad + good
    return -sum(n / total * math.log2(n / total) for n in (bad, good) if n)


def cut_points(histogram: dict[int, tuple[int, int]], most: int) -> list[int]:
    """Up to ``most`` thresholds, each the best split of the interval in which it lies; those that gain the most come first."""
    values, found = sorted(histogram), []

    def best(low: int, high: int):
        """The split of ``values[low:high]`` that lowers the entropy most: bits gained over all its rows, and place."""
        bad, good = (sum(histogram[v][k] for v in values[low:high]) for k in (0, 1))
        total, left, top = bad + good, [0, 0], (0.0, None)
        if not bad or not good:
            return top
        whole = total * _entropy(bad, good)
        for i in range(low, high - 1):
            left = [left[0] + histogram[values[i]][0], left[1] + histogram[values[i]][1]]
            rest = whole - sum(left) * _entropy(*left) - (total - sum(left)) * _entropy(bad - left[0], good - left[1])
            top = max(top, (rest, i + 1), key=lambda x: (x[0], -(x[1] or 0)))
        return top

    spans = [(*best(0, len(values)), 0, len(values))]
    while spans and len(found) < most:
        gain, at, low, high = spans.pop(max(range(len(spans)), key=lambda i: (spans[i][0], -spans[i][2])))
        # A split has to pay for naming itself.
        if at is None or gain <= math.log2(max(2, len(values))):
            break
        found.append((values[at - 1] + values[at]) // 2)
        spans += [(*best(low, at), low, at), (*best(at, high), at, high)]
    return sorted(found)


Cell = tuple[dict[str, int], int, int, int]


def _met(rule: Rule, cells: list[Cell]) -> tuple[int, int]:
    bad = good = 0
    for values, _, b, g in cells:
        if rule.meets(values):
            bad, good = bad + b, good + g
    return bad, good


def _grown(cells: list[Cell], choices: list[Condition]) -> Rule:
    """Conditions are added while they gain, until no good row is met."""
    rule, (bad, good) = Rule(()), _met(Rule(()), cells)
    while good and len(rule.conditions) < MAX_CONDITIONS:
        before, top = math.log2(bad / (bad + good)), (0.0, None, 0, 0)
        for choice in choices:
            b, g = _met(Rule((choice,)), cells)
            if b and b + g < bad + good and (gain := b * (math.log2(b / (b + g)) - before)) > top[0] + 1e-9:
                top = (gain, choice, b, g)
        if top[1] is None:
            break
        _, choice, bad, good = top
        rule = Rule((*rule.conditions, choice))
        cells = [c for c in cells if choice.holds(c[0])]
    return rule


def _pruned(rule: Rule, cells: list[Cell]) -> Rule:
    """The shortest beginning of the conditions that does best on rows the rule was not grown on."""

    def worth(size: int):
        bad, good = _met(Rule(rule.conditions[:size]), cells)
        return ((bad - good) / (bad + good) if bad + good else -1.0, -size)

    return Rule(rule.conditions[: max(range(1, len(rule.conditions) + 1), key=worth)])


def covering(cells: list[Cell], cuts: dict[str, list[int]]) -> list[Rule]:
    """The ordered rules for the bad rows of ``cells``: measures of a cell, its fold, bad and good rows."""
    choices = [Condition(m, above, t) for m in sorted(cuts) for t in cuts[m] for above in (True, False)]
    rules: list[Rule] = []
    for _ in range(MAX_RULES):
        grow, prune = [c for c in cells if c[1]], [c for c in cells if not c[1]]
        if not any(c[2] for c in grow):
            break
        grown = _grown(grow, choices)
        if not grown.conditions:
            break
        # Of the pruned rule and the whole one the first that is right often enough is taken.
        for rule in dict.fromkeys((_pruned(grown, prune), grown)):
            bad, good = _met(rule, cells)
            if bad >= LEAST_MET and bad >= PRECISION * (bad + good):
                break
        else:
            break
        rules.append(rule)
        cells = [c for c in cells if not rule.meets(c[0])]
    return rules


def learned(counts: DataFrame, labels: DataFrame) -> list[Rule]:
    """The decision list for rows that pass the base rule; ``labels`` has ``doc_id, quality`` with 0 for a bad text."""
    measures = measured()
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).alias("bad")).filter("doc_id is not null and bad is not null")
    rows = counts.filter(~base_failed()).select("doc_id", *[v.alias(k) for k, v in measures.items()]).join(known, "doc_id")
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias("value")) for k in measures])).alias("p")
    tall = rows.select("bad", pairs).groupBy("p.measure", "p.value").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    histograms: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
    for r in tall.collect():
        histograms[r["measure"]][r["value"]] = (r["bad"], r["good"])
    cuts = {m: found for m, h in histograms.items() if (found := cut_points(h, CUTS))}
    if not cuts:
        return []
    level = lambda m: sum((F.when(F.col(m) > t, 1).otherwise(0) for t in cuts[m]), start=F.lit(0)).alias(m)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    names = sorted(cuts)
    cube = rows.select("bad", fold, *[level(m) for m in names]).groupBy("fold", *names).agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    cells = []
    for r in sorted(cube.collect(), key=lambda r: tuple(r[m] for m in ["fold", *names])):
        # A cell stands for values above the threshold below it.
        values = {m: cuts[m][r[m] - 1] + 1 if r[m] else cuts[m][0] for m in names}
        cells.append((values, r["fold"], r["bad"], r["good"]))
    return covering(cells, cuts)


def decided(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``counts`` with ``base_failed``, the first rule that a row meets, and ``kept``."""
    measures, none = measured(), F.lit(None).cast("string")
    first = none
    for rule in reversed(rules):
        first = F.when(rule.column(measures), F.lit(str(rule))).otherwise(first)
    rows = counts.withColumns({"base_failed": base_failed(), "rule": first})
    return rows.withColumns({"rule": F.when(~F.col("base_failed"), F.col("rule")), "kept": ~F.col("base_failed") & F.col("rule").isNull()})


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every row of ``docs``; the counts are written once, as learning and judging both read them."""
    path = shared_dir(docs.sparkSession, "quality-counts")
    counted(docs).write.parquet(path)
    counts = docs.sparkSession.read.parquet(path)
    return decided(counts, learned(counts, labels))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
