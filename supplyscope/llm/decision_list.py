"""Quality rules: text statistics and a learned decision list, as plain Spark expressions.

``text_statistics`` measures every text within its own row. ``learn`` grows a decision list by sequential
covering over labelled statistics: each rule is a conjunction of thresholds, grown condition by condition
on two thirds of the labelled rows and pruned on the rest; rows that a rule covers leave before the next
is grown. Every growing step is one aggregation over the written statistics that returns a count for each
feature and threshold; only those counts and the rules are on the driver. The list becomes an ordered
conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.sources import materialise

_SPACES = r"[\x20\x09-\x0D]+"
_SPACE_CHARS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The integers every text gets; ``FEATURES`` are ratios of them.
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct", "n_upper", "n_marks"]
FEATURES = {
    "words": "CAST(n_words AS DOUBLE)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
}
#: Words are few or mostly repeated: such texts fail without a learned rule.
BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"


@dataclass(frozen=True)
class Rule:
    """Texts for which all ``(feature, is_upper_bound, threshold)`` hold are of low quality."""

    conditions: tuple[tuple[str, bool, float], ...]
    covered: int
    precision: float

    def sql(self) -> str:
        return " AND ".join(f"{f} {'<=' if below else '>'} {t!r}D" for f, below, t in self.conditions)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``BASE`` and ``MORE`` (all long) for the whole text of each row.

    Words are runs of characters other than space and 0x09 to 0x0D; null or empty text gives zeros. A repeated
    line counts if it has a word; ``n_repeat_words`` counts the words inside any window of five words that
    the text has twice or more. The time for a text of n words is that of sorting n numbers.
    """
    keep = [c for c in docs.columns if c not in BASE + MORE]
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    q = docs.select(*[F.col(f"`{c}`") for c in keep], whole.alias("_text"))
    q = q.withColumn("_w", F.array_remove(F.split("_text", _SPACES), ""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, _SPACE_CHARS, "")) > 0)
    q = q.withColumn("_lines", lines)

    def without(chars: str) -> Column:
        return F.length(F.translate("_text", chars, ""))

    q = q.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("_w").cast("long").alias("n_words"),
        without(_SPACE_CHARS).cast("long").alias("word_chars"),
        (F.length("_text") - without(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.length("_text") - without(_UPPER)).cast("long").alias("n_upper"),
        (F.length("_text") - without("!?.,;:")).cast("long").alias("n_marks"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    windows = "CASE WHEN size(_h) < 5 THEN array() ELSE transform(sequence(0, size(_h) - 5), i -> xxhash64(_h[i], _h[i + 1], _h[i + 2], _h[i + 3], _h[i + 4])) END"
    q = q.withColumn("_g", F.expr(windows)).withColumn("_s", F.sort_array("_g"))
    q = q.withColumn("_twice", F.expr("exists(transform(_s, (x, i) -> x = get(_s, i - 1)), e -> e)"))
    # For the few texts with repeats: windows in hash order with their places, then the places in text order.
    q = q.withColumn("_p", F.expr("CASE WHEN _twice THEN array_sort(transform(_g, (x, i) -> struct(x AS h, i AS i))) END"))
    q = q.withColumn("_p", F.expr("sort_array(transform(filter(_p, (p, k) -> p.h = get(_p, k - 1).h OR p.h = get(_p, k + 1).h), p -> p.i))"))
    covered = "aggregate(_p, struct(-5 AS last, 0L AS n), (a, i) -> struct(i AS last, a.n + least(5, i - a.last) AS n), a -> a.n)"
    q = q.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0)).cast("long"))
    q = q.withColumn("n_distinct", F.size(F.array_distinct("_h")).cast("long"))
    # As the rows of a generator, so that a filter on a count is not rewritten into the expressions behind it.
    return q.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.struct(*BASE, *MORE))))


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    """FOIL gain of narrowing ``p0`` low and ``n0`` good texts to ``p`` and ``n``."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def learn(
    stats: DataFrame,
    labels: DataFrame,
    max_rules: int = 8,
    max_conditions: int = 3,
    thresholds: int = 32,
    min_precision: float = 0.95,
    min_covered: int = 5,
) -> list[Rule]:
    """Ordered rules for low quality. ``stats`` has ``doc_id``, ``BASE`` and ``MORE``; ``labels`` has ``doc_id``
    and ``quality`` (0 low, 1 good).

    All labelled rows are used; texts that fail the base rules are not, since no rule is needed for them. Rows
    without id or label are left out; an id with several labels counts as low if most of them are. No low
    texts, no good texts or no labels give no rules. Ties go to the first feature and lower threshold.
    """
    low = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    low = low.agg((F.avg(F.col("quality").cast("double")) < 0.5).cast("int").alias("low"))
    rows = stats.where(f"doc_id IS NOT NULL AND NOT {BASE_FAILED}").join(low, "doc_id")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    rows = rows.select("low", part.alias("held"), *[F.expr(e).alias(f) for f, e in FEATURES.items()])
    rows = materialise(rows, "labelled")
    shares = [(k + 0.5) / thresholds for k in range(thresholds)]
    cuts = rows.agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(cuts[f] or [])) for f in FEATURES}
    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule = _grow(left, cuts, max_conditions, min_precision, min_covered)
        rule = rule and _prune(left.where("held"), rule)
        if not rule or rule.precision < min_precision or rule.covered < min_covered:
            break
        rules.append(rule)
        left = left.where(f"NOT ({rule.sql()})")
    return rules


def _grow(left: DataFrame, cuts: dict[str, list[float]], most: int, precision: float, least: int) -> Rule | None:
    conditions: tuple[tuple[str, bool, float], ...] = ()
    best: Rule | None = None
    while len(conditions) < most:
        rows = left.where("NOT held")
        if best:
            rows = rows.where(best.sql())
        # How many thresholds a value exceeds, by feature: counts for all conditions in one pass.
        places = [
            F.struct(F.lit(f).alias("f"), sum((F.lit(c) < F.col(f)).cast("int") for c in cuts[f]).alias("k"))
            for f in FEATURES
            if cuts[f]
        ]
        if not places:
            return None
        counts = rows.select("low", F.explode(F.array(*places)).alias("x")).groupBy("x.f", "x.k")
        found: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
        for r in counts.agg(F.sum("low").alias("p"), F.count("*").alias("n")).collect():
            found[r.f][r.k] = (r.p, r.n - r.p)
        whole = next((x for x in found.values() if x), {})
        p0, n0 = sum(p for p, _ in whole.values()), sum(n for _, n in whole.values())
        if not p0 or not n0:
            return best
        choice = None
        for f in FEATURES:
            p = n = 0
            for k, cut in enumerate(cuts[f]):
                dp, dn = found[f].get(k, (0, 0))
                p, n = p + dp, n + dn  # value <= cut
                for below, a, b in ((True, p, n), (False, p0 - p, n0 - n)):
                    if a + b >= least and (choice is None or _gain(p0, n0, a, b) > choice[0] + 1e-9):
                        choice = (_gain(p0, n0, a, b), (f, below, cut), a, b)
        if choice is None or choice[0] <= 0:
            return best
        conditions += (choice[1],)
        best = Rule(conditions, choice[2], choice[2] / (choice[2] + choice[3]))
        if best.precision >= max(precision, 0.995):
            break
    return best


def _prune(held: DataFrame, rule: Rule) -> Rule:
    """The leading conditions of a rule that are worth most on rows it was not grown on, with their precision there."""
    heads = [Rule(rule.conditions[: k + 1], 0, 0.0) for k in range(len(rule.conditions))]
    sums = [(F.sum(F.expr(f"IF({h.sql()}, low, 0)")), F.sum(F.expr(f"IF({h.sql()}, 1, 0)"))) for h in heads]
    row = held.agg(*[x.alias(f"c{i}") for i, x in enumerate(y for pair in sums for y in pair)]).first()
    scored = []
    for k, head in enumerate(heads):
        p, n = row[f"c{2 * k}"] or 0, row[f"c{2 * k + 1}"] or 0
        scored.append(((2 * p - n) / (n + 2), Rule(head.conditions, n, p / n if n else 0.0)))
    return max(scored, key=lambda x: x[0])[1]


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a text with its ``BASE`` and ``MORE`` columns, 0 for none; rule -1
    is the base failure."""
    out = F.when(F.expr(BASE_FAILED), F.lit(-1))
    for k, rule in enumerate(rules, 1):
        sql = " AND ".join(f"({FEATURES[f]}) {'<=' if below else '>'} {t!r}D" for f, below, t in rule.conditions)
        out = out.when(F.expr(sql), F.lit(k))
    return out.otherwise(F.lit(0))


def judged(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, list[Rule]]:
    """``doc_id``, ``BASE``, ``MORE``, ``base_failed``, ``rule`` and ``kept`` for each row of ``docs``, and the rules.

    Writes the statistics once; rules are learned from them and applied to them. Rows with null ``doc_id`` or
    repeated rows are judged like others; other columns are ignored; no rows give no rows.
    """
    stats = materialise(text_statistics(docs.select(F.col("doc_id").cast("long"), F.col("text"))), "statistics")
    rules = learn(stats, labels, **options)
    out = stats.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rule", verdict(rules))
    return out.withColumn("kept", F.col("rule") == 0), rules


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text no rule rejects, with their columns. Rules are learned from ``docs`` itself."""
    stats = materialise(text_statistics(docs.select(F.col("doc_id").cast("long"), F.col("text"))), "statistics")
    rules = learn(stats, labels, **options)
    names = [f"c{k}" for k in range(len(docs.columns))]
    apart = docs.toDF(*names)
    judged_rows = text_statistics(apart, f"c{docs.columns.index('text')}").where(verdict(rules) == 0)
    return judged_rows.select(*names).toDF(*docs.columns)
