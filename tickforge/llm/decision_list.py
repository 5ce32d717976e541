"""Quality rules: a decision list learned by sequential covering, applied as Spark conditions.

Statistics of each text are built-in expressions.  From labelled rows, rules that reject are
learned one after another: a rule grows, threshold by threshold, on two thirds of the rows
that no earlier rule covers (FOIL's gain), and is pruned on the rest; learning ends when a
rule isn't precise enough there.  The result is an ordered list of threshold conjunctions
that becomes one CASE expression; what no rule covers is kept.

Learning sees at most `sample` labelled rows of each class (the first by a hash of the id; a
bounded fit, stated here), whose statistics are stored once.  A growing step is one
aggregation of counts by statistic, bin and label over them; the driver sees only these
counts.  Everything else covers all rows, in one pass without a shuffle.  No Python runs on
executors.

Words are runs of all but spaces (20, 09-0D); lines are parted by \\n.  Null and empty texts
have zero statistics and fail the base rules.  Without labelled rows of both classes the list
is empty and the base rules alone decide.  Of thresholds of equal gain the first statistic
and lowest threshold is taken.  Repeated rows are judged alike; null labels and ids are not
learned from.  A very long text is one row of built-in expressions, in memory in proportion
to it.  An empty table gives no rows.  Further columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored, table

WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
SAMPLE, BINS, MOST_RULES, MOST_CONDITIONS = 6000, 24, 8, 3
LEAST_PRECISION, LEAST_COVER = 0.9, 5
RATES = ("symbols_per_word", "bangs_per_word", "upper_share", "dup_line_share", "repeat_share", "word_length", "n_words")


def _let(value: Column, use) -> Column:
    """use(value) with value worked out once."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more."""
    n = F.size(words) - 2
    windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("at")))

    def covered(w: Column) -> Column:
        last = F.size(w) - 1
        twice = F.filter(w, lambda x, k: ((k > 0) & (F.get(w, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(w, k + 1)["h"] == x["h"])))
        starts = F.array_sort(F.transform(twice, lambda x: x["at"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(starts, start, lambda a, at: F.struct((a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"), at.alias("last")))["n"]

    return F.when(n < 2, 0).otherwise(_let(F.sort_array(windows), covered))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bangs, n_upper, n_lines) of every row, and the columns to keep."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *keep)
    counted = _let(words, lambda w: F.struct(F.size(w).alias("n"), F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)).alias("chars"), _repeated(w).alias("repeated")))
    lined = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    found = own.select("doc_id", *keep, counted.alias("w"), lined.alias("l"), F.regexp_count("text", F.lit("[#*$%&|<>]")).alias("n_symbols"), F.regexp_count("text", F.lit("!")).alias("n_bangs"), F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"))
    columns = {"n_words": "w.n", "word_chars": "w.chars", "n_symbols": "n_symbols", "n_dup_lines": "l.again", "n_repeat_words": "w.repeated", "n_bangs": "n_bangs", "n_upper": "n_upper", "n_lines": "l.n"}
    return found.select("doc_id", *keep, *(F.col(c).cast("long").alias(n) for n, c in columns.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rates() -> dict[str, Column]:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return dict(zip(RATES, (per("n_symbols", "n_words"), per("n_bangs", "n_words"), per("n_upper", "word_chars"), per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("word_chars", "n_words"), F.col("n_words").cast("double"))))


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = rates()[self.rate]
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.rate} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions: Rule) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _sample(docs: DataFrame, labels: DataFrame, sample: int, label_col: str) -> DataFrame:
    """Statistics of at most `sample` labelled rows of each class, with bad (1 or 0) and grow."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    some = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    few = F.broadcast(some[0].unionByName(some[1]).withColumnRenamed("doc_id", "of"))  # 2 * sample rows at most
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few, F.col("doc_id") == F.col("of")).select("doc_id", "text", "label")
    # stored first: a condition on statistics would be pushed below the join, and be worked out for all rows
    counted = stored(statistics(found, keep=("label",)), "labelled")
    return counted.where(~base_failed()).withColumns({"bad": 1 - F.col("label"), "grow": F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) > 0})


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    at = [(k + 1) / (bins + 1) for k in range(bins)]
    marks = rows.groupBy("bad").agg(*(F.percentile_approx(F.when(c > 0, c), at, 1000).alias(n) for n, c in rates().items())).collect()
    return {n: sorted({x for r in marks for x in r[n] or ()}) for n in RATES}


def _bin(value: Column, marks: list[float]) -> Column:
    """How many of the marks are at or below the value."""
    return F.size(F.filter(F.array(*map(F.lit, marks)), lambda mark: mark <= value))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    from math import log2

    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else float("-inf")


def _grow(rows: DataFrame, marks: dict[str, list[float]], most: int) -> Rule:
    """The rule of best gain over rows, condition by condition."""
    rule: Rule = ()
    for _ in range(most):
        bins = [F.struct(F.lit(n).alias("rate"), _bin(c, marks[n]).alias("bin")) for n, c in rates().items() if marks[n]]
        counts = rows.where(_all(rule)).select("bad", F.explode(F.array(*bins)).alias("b")).groupBy("b.rate", "b.bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
        by: dict[str, list] = {}
        for r in counts:
            by.setdefault(r["rate"], []).append((r["bin"], r["p"], r["n"]))
        p0, n0 = (sum(x[k] for x in next(iter(by.values()), [])) for k in (1, 2))
        if not p0 or not n0:
            break
        best = None
        for rate, found in ((n, by[n]) for n in rates() if n in by):
            for i, mark in enumerate(marks[rate]):
                p, n = (sum(x[k] for x in found if x[0] > i) for k in (1, 2))
                for above, a, b in ((True, p, n), (False, p0 - p, n0 - n)):
                    if a >= LEAST_COVER and (best is None or _gain(a, b, p0, n0) > best[0]):
                        best = (_gain(a, b, p0, n0), Condition(rate, above, mark))
        if best is None or best[0] <= 1e-9:
            break
        rule = (*rule, best[1])
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, float, int]:
    """The beginning of the rule that is best on rows held out, its precision, and how many it covers there."""
    sums = [F.sum(F.when(_all(rule[: k + 1]), x)).alias(f"{s}{k}") for k in range(len(rule)) for s, x in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
    got = rows.agg(*sums).first()
    ends = [((got[f"p{k}"] or 0), (got[f"n{k}"] or 0), k + 1) for k in range(len(rule))]
    p, n, k = max(ends, key=lambda x: ((x[0] - x[1]) / max(1, x[0] + x[1]), x[0], -x[2]))
    return rule[:k], p / max(1, p + n), p + n


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, bins: int = BINS, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS) -> list[Rule]:
    """Rules, in order, that reject documents (label 0)."""
    rows = _sample(docs, labels, sample, label_col)
    marks = _thresholds(rows, bins)
    rules: list[Rule] = []
    for _ in range(most_rules):
        rest = rows
        for r in rules:
            rest = rest.where(~_all(r))
        rule = _grow(rest.where("grow"), marks, most_conditions)
        if not rule:
            break
        rule, precision, covered = _prune(rest.where("not grow"), rule)
        if precision < LEAST_PRECISION or covered < 2:
            break
        rules.append(rule)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where the list keeps a row: the first rule that covers it decides."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(_all(rule), False).otherwise(out)
    return out


def judged(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of every row of docs, base_failed, and kept."""
    found = statistics(docs, id_col, text_col).withColumn("base_failed", base_failed())
    return found.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = judged(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
