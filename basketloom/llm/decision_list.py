"""Quality rules: decision lists learned by sequential covering."""

from __future__ import annotations

from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm import statistics as st
from basketloom.llm import text as t
from basketloom.sources.stage import discard, settle

#: Features of the learner, as rates and counts of the statistics.
FEATURES = ["n_words", "word_length", "symbol_rate", "dup_lines", "repeat_rate", "upper_rate", "mark_rate"]
#: Bounds of the list, and what a rule must reach on the pruning rows.
MAX_RULES, MAX_CONDITIONS, SUPPORT, PRECISION = 16, 4, 10, 0.9

Rule = list[tuple[str, str, float]]


def quality_statistics(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_marks) per row.

    n_repeat_words counts the words in 5-word windows that the text has twice
    or more. Windows are hashed words; only texts with a repeated window sort
    them. A null or blank text has zeros everywhere.
    """
    counted = st.base_counts(docs, [key])
    filled = F.filter(t.lines(F.col("__t")), lambda line: F.length(st.without(line, t.SPACE_CHARS)) > 0)
    step = counted.select(
        "*", filled.alias("__l"), F.transform("__w", lambda w: F.xxhash64(w)).alias("__h")
    ).drop("__t", "__w", "n_distinct")
    step = step.withColumn("__runs", t.runs("__h", 5, lambda *w: F.xxhash64(*w)))
    twice = F.size(F.array_distinct("__runs")) < F.size("__runs")
    step = step.withColumn("__s", F.when(twice, F.array_sort(F.transform("__runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def same(i: Column, k: int) -> Column:
        return F.coalesce(F.get(F.col("__s"), i + k)["h"] == F.get(F.col("__s"), i)["h"], F.lit(False))

    repeated = F.filter("__s", lambda s, i: same(i, 1) | same(i, -1))
    step = step.withColumn("__p", F.array_sort(F.transform(repeated, lambda s: s["i"])))
    gaps = F.aggregate(
        F.transform("__p", lambda p, i: F.least(F.lit(5), F.coalesce(F.get(F.col("__p"), i + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"),
        lambda total, gap: total + gap,
    )
    return step.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(gaps, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_marks",
    )


def features(stats: DataFrame) -> DataFrame:
    return stats.select(
        "*",
        st.rate("word_chars", "n_words").alias("word_length"),
        st.rate("n_symbols", "n_words").alias("symbol_rate"),
        F.col("n_dup_lines").alias("dup_lines"),
        st.rate("n_repeat_words", "n_words").alias("repeat_rate"),
        st.rate("n_upper", "word_chars").alias("upper_rate"),
        st.rate("n_marks", "n_words").alias("mark_rate"),
    )


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [(F.col(f) >= c) if op == ">=" else (F.col(f) < c) for f, op, c in rule])


def learn(rows: DataFrame, names: list[str] = FEATURES, label: str = "bad", key: str = "doc_id") -> list[Rule]:
    """Ordered rules that tell bad rows (label 1) from good ones (0).

    Sequential covering: two thirds of the rows, by hash of the key, grow a
    rule by the condition of highest information gain until it covers no good
    row or gains nothing more; the last third prunes it back to the prefix with
    the best share of bad over good. A rule that is not precise enough there
    ends the list; covered rows leave. Only histograms of the fixed thresholds
    reach the driver. Rows without label or key are ignored; without bad rows
    there are no rules.
    """
    known = rows.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    cuts = st.thresholds(known, names, label)
    grow = F.pmod(F.xxhash64(key), F.lit(3)) != 0
    binned = settle(
        known.select(
            F.col(label).cast("int").alias("__y"), grow.alias("__grow"), *names,
            F.array(*[F.struct(F.lit(k).alias("f"), st.bin_of(F.col(f), cuts[f]).alias("bin")) for k, f in enumerate(names)]).alias("__b"),
        ),
        "labelled",
    )
    rules: list[Rule] = []
    left = binned
    while len(rules) < MAX_RULES:
        rule: Rule = []
        covered = left.filter("__grow")
        while len(rule) < MAX_CONDITIONS:
            cells = covered.select("__y", F.explode("__b").alias("b")).groupBy("b.f", "b.bin", "__y").count().collect()
            best = _best(cells, [cuts[f] for f in names])
            if best is None:
                break
            k, op, cut, clean = best
            rule.append((names[k], op, cut))
            covered = covered.filter(holds(rule[-1:]))
            if clean:
                break
        if not rule:
            break
        prefixes = range(1, len(rule) + 1)
        sums = left.filter("not __grow").agg(
            *[F.count_if(holds(rule[:n]) & (F.col("__y") == y)).alias(f"c{n}_{y}") for n in prefixes for y in (0, 1)]
        ).first()
        worth = {n: (sums[f"c{n}_1"] - sums[f"c{n}_0"]) / max(1, sums[f"c{n}_1"] + sums[f"c{n}_0"]) for n in prefixes}
        n = max(prefixes, key=lambda n: (worth[n], -n))
        bad, good = sums[f"c{n}_1"], sums[f"c{n}_0"]
        if bad < min(SUPPORT, 3) or bad < PRECISION * (bad + good):
            break
        rules.append(rule[:n])
        left = left.filter(~holds(rules[-1]))
    discard(binned)
    return rules


def _best(cells: list, cuts: list[list[float]]) -> tuple[int, str, float, bool] | None:
    """The condition of highest gain from counts per (feature, bin, label)."""
    count: dict[tuple[int, int], list[int]] = {}
    for f, b, y, n in cells:
        count.setdefault((f, b), [0, 0])[y] += n
    total = [sum(c[y] for (f, _), c in count.items() if f == 0) for y in (0, 1)]
    if not total[1] or not total[0]:
        return None
    start, best, top = log2(total[1] / sum(total)), None, 1e-9
    for f, own in enumerate(cuts):
        below = [0, 0]
        for b, cut in enumerate(own):  # bin b holds values under cut b
            for y in (0, 1):
                below[y] += count.get((f, b), (0, 0))[y]
            for op, c in ((">=", [total[y] - below[y] for y in (0, 1)]), ("<", below)):
                if c[1] and c != total:
                    gain = c[1] * (log2(c[1] / (c[0] + c[1])) - start)
                    if gain > top:
                        best, top = (f, op, cut, c[0] == 0), gain
    return best


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        out = F.when(holds(rules[i - 1]), F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base_failed, rule (number, null: none) and kept per row of ``docs``.

    Learns from the labels of these documents (doc_id, quality); a doc_id with
    several labels counts as its lowest. Null doc_ids are judged, not learned
    from. Blank texts fail the base.
    """
    stats = settle(features(quality_statistics(docs)), "statistics")
    marks = labels.groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    rules = learn(stats.dropDuplicates(["doc_id"]).join(marks, "doc_id"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = stats.select("*", failed.alias("base_failed"), verdict(rules).alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
