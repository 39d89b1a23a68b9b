"""Secrets in documents: candidates by shape, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm import text as t
from basketloom.sources.stage import settle

# The shape of a candidate, and names that announce credentials.
SHAPE = r"[A-Za-z0-9+/_=\-]{16,}"
NAMES = r"(?i)(key|token|secret|passw|passwd|pwd|credential|auth|api)"
#: The name of a credential and its sign of assignment, at the end of what stands before a run.
NAMED_AT_END = NAMES + r"[A-Za-z0-9_\-]*[\"'`]?[=:][\"'`]?$"
PROVIDERS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9\-]{10,})$"
#: Shapes of mixed letters and digits that are no secret unless a name says so: UUIDs, hex hashes, paths of plain words and short numbers.
UUID = r"(?i)^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"
HASH = r"^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$"
SEGMENT = r"([A-Za-z]?[a-z]+([_\-][a-z]+)*[0-9]{0,4}|[0-9]{1,4})"
PATH = rf"^/*({SEGMENT}/+)+({SEGMENT})?$"
#: A value is no secret if it stands, unnamed, between so many different neighbours; copies of a text have the same ones.
PLACES = 5
#: Trigrams of a-z; one is in the dictionary if it has at least the share that all would have in random letters.
TRIGRAMS = 26**3
#: Labelled findings that train the forest: the lowest hashes, at most so many.
MAX_FINDINGS = 200_000
FEATURES = [
    "length", "digit_rate", "upper_rate", "lower_rate", "transition_rate", "coverage", "named_before", "named_inside",
    "assigned", "quoted", "name_far", "path_rate",
]
KEYS = ["doc_id", "version", "pos", "run"]


def _rate(value: Column, drop: str) -> Column:
    return 1 - F.length(F.regexp_replace(value, drop, "")) / F.length(value)


def candidates(docs: DataFrame) -> DataFrame:
    """Every run of 16 or more token characters, with its place and neighbours.

    Columns doc_id, version (hash of the text), source, pos (number of the
    word), run (number of the run in its word), word (the part of the word from
    the run before to the run after), before (what stands directly before the
    run, with the end of the run before), finding (the run, without a name in
    front of ``=``), near (the three runs or words before and two after). Null
    texts have none.
    """
    split = docs.select("doc_id", "source", F.xxhash64("text").alias("version"), t.words(F.col("text")).alias("__w"))
    long = F.filter(F.transform("__w", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda s: (F.length(s["word"]) >= 16) & s["word"].rlike(SHAPE))
    word = lambda i, k: F.coalesce(F.get(F.col("__w"), i + k), F.lit(""))
    placed = F.transform(long, lambda s: F.struct(s["pos"].alias("pos"), s["word"].alias("word"), F.array(*[word(s["pos"], k) for k in (-3, -2, -1, 1, 2)]).alias("near")))
    rows = split.select("doc_id", "version", "source", F.explode_outer(placed).alias("c")).filter("c is not null").select("doc_id", "version", "source", "c.*")
    # a word has one gap more than runs; only runs at its ends see other words, so long words are not repeated per run
    cut = rows.select("*", F.regexp_extract_all("word", F.lit(SHAPE), F.lit(0)).alias("__r"), F.split("word", SHAPE, -1).alias("__g")).drop("word")
    run, gap, other = (lambda i, c=c: F.get(F.col(c), i) for c in ("__r", "__g", "near"))
    before = lambda i, k: F.coalesce(run(i - k), other(i + (3 - k)))
    after = lambda i, k: F.coalesce(run(i + k), other(i + (3 + k) - F.size("__r")))
    runs = F.transform(
        "__r",
        lambda r, i: F.struct(
            i.alias("run"),
            F.concat(gap(i), r, gap(i + 1)).alias("word"),
            F.concat(F.coalesce(F.right(run(i - 1), F.lit(40)), F.lit("")), gap(i)).alias("before"),
            r.alias("__run"),
            F.array(before(i, 3), before(i, 2), before(i, 1), after(i, 1), after(i, 2)).alias("near"),
        ),
    )
    each = cut.select("doc_id", "version", "source", "pos", F.explode_outer(runs).alias("c")).select("doc_id", "version", "source", "pos", "c.*")
    named = F.regexp_extract("__run", r"^[A-Za-z_\-]{2,30}=(.{8,})$", 1)
    return each.select("*", F.when(named != "", named).otherwise(F.col("__run")).alias("finding")).drop("__run").distinct()


def _grams(c: Column) -> Column:
    """All trigrams of letters a-z, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit("(?=([a-z]{3}))"), F.lit(1))


def dictionary(docs: DataFrame) -> DataFrame:
    """(g, hit): the trigrams that are more frequent in all words of all documents than in random letters.

    A share, so more documents of the same kind have the same dictionary. Equal
    words are counted first; at most TRIGRAMS rows remain.
    """
    words = docs.select(t.words(F.col("text")).alias("__w")).select(F.explode_outer("__w").alias("w")).filter("w is not null")
    each = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).select("n", F.explode_outer(_grams(F.col("w"))).alias("g")).filter("g is not null")
    counts = settle(each.groupBy("g").agg(F.sum("n").alias("n")), "trigrams")
    return counts.filter(F.col("n") * TRIGRAMS >= counts.agg(F.sum("n").alias("n")).select("n").scalar()).select("g", F.lit(1.0).alias("hit"))


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """The features of the forest, as doubles.

    ``coverage`` is the share of the finding's letter trigrams that are in the
    dictionary ``known`` of :func:`dictionary`; ``path_rate`` the share of the
    candidates of a source that look random, counted over all rows.
    """
    parts = found.select(*KEYS, F.explode_outer(_grams(F.col("finding"))).alias("g"))
    total = F.greatest(F.length("finding") - 2, F.lit(1))
    covered = parts.join(known, "g", "left").groupBy(*KEYS).agg(F.sum("hit").alias("hits"))
    same = [F.col("doc_id").eqNullSafe(F.col("__d")), F.col("version") == F.col("__v"), F.col("pos") == F.col("__p"), F.col("run") == F.col("__n")]
    rows = found.join(covered.toDF("__d", "__v", "__p", "__n", "hits"), same, "left").drop("__d", "__v", "__p", "__n")
    value = F.col("finding")
    runs = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "9")
    near = lambda k: F.get(F.col("near"), k)
    as_double = lambda c: c.cast("int").cast("double")
    rows = rows.select(
        *found.columns,
        F.length(value).cast("double").alias("length"),
        _rate(value, "[0-9]").alias("digit_rate"),
        _rate(value, "[A-Z]").alias("upper_rate"),
        _rate(value, "[a-z]").alias("lower_rate"),
        ((F.length(runs) - 1) / F.length(value)).alias("transition_rate"),
        (F.coalesce("hits", F.lit(0.0)) / total).alias("coverage"),
        as_double(near(2).rlike(NAMES) | near(1).rlike(NAMES)).alias("named_before"),
        as_double((F.regexp_replace("word", r"=.*$", "").rlike(NAMES) & F.col("word").contains("=")) | F.col("before").rlike(NAMED_AT_END)).alias("named_inside"),
        as_double(near(2).rlike("[=:]$") | F.col("word").rlike(r"^\W?[A-Za-z_\-]+[=:]") | F.col("before").rlike("[=:][\"'`]?$")).alias("assigned"),
        as_double(F.col("word").rlike("[\"'`]")).alias("quoted"),
        as_double(near(0).rlike(NAMES)).alias("name_far"),
    )
    random = F.avg(((F.col("digit_rate") > 0.1) & (F.col("digit_rate") < 1)).cast("double")).alias("path_rate")
    paths = rows.groupBy("source").agg(random).withColumnRenamed("source", "__s")
    return rows.join(paths, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")


def sure_label() -> Column:
    """The label of a finding that its format and place decide, null for what needs the forest.

    1 for a provider's format or a named assignment of mixed letters and
    digits. 0, if no name stands before, for plain words and numbers, UUIDs,
    hashes, paths, and values in ``places`` different neighbourhoods. A named
    assignment of letters or digits alone stays open: it may be a passphrase.
    """
    value = F.col("finding")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    named = (F.col("named_inside") == 1) | ((F.col("named_before") == 1) & (F.col("assigned") == 1))
    unnamed = (F.col("named_inside") == 0) & (F.col("named_before") == 0) & (F.col("name_far") == 0)
    ordinary = value.rlike(UUID) | value.rlike(HASH) | value.rlike(PATH) | (F.col("places") >= PLACES)
    return F.when(value.rlike(PROVIDERS) | (mixed & named), 1.0).when(~mixed & ~named, 0.0).when(mixed & unnamed & ordinary, 0.0)


def scan(docs: DataFrame, findings: DataFrame, trees: int = 32, depth: int = 6, least: float = 0.5) -> DataFrame:
    """(doc_id, pos, run, finding, score, is_secret) of all candidates in ``docs``.

    ``findings`` has doc_id, pos, run, and label (1: secret, 0: false positive)
    of reviewed candidates; without a column run, the first run of a word is
    meant. The forest trains on at most
    MAX_FINDINGS of them, those with the lowest hash, and scores every
    candidate. With labels of one kind only, or none, the score is that label,
    or 1. Documents need doc_id, text, source; repeated rows count once, null
    doc_ids are scanned but never trained on, empty tables give no rows.
    """
    rows = settle(with_features(settle(candidates(docs), "candidates"), dictionary(docs)), "features")
    findings = findings if "run" in findings.columns else findings.withColumn("run", F.lit(0))
    marks = findings.filter("label is not null").groupBy("doc_id", "pos", "run").agg(F.max("label").cast("double").alias("label"))
    train = rows.join(marks, ["doc_id", "pos", "run"]).orderBy(F.xxhash64("doc_id", "pos", "run", "version"), "doc_id", "pos", "run").limit(MAX_FINDINGS)
    train = settle(train.select("label", *FEATURES), "findings")
    kinds = [r[0] for r in train.select("label").distinct().collect()]
    if len(kinds) < 2:
        score = F.lit(kinds[0] if kinds else 1.0)
        scored = rows.select("doc_id", "pos", "run", "finding", score.alias("score"))
    else:
        gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=7).fit(gather.transform(train))
        scored = forest.transform(gather.transform(rows)).select("doc_id", "pos", "run", "finding", vector_to_array("probability")[1].alias("score"))
    return scored.withColumn("is_secret", F.col("score") >= least)


def reviewed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Findings of the labelled documents, labelled by :func:`sure_label`: stands in for human review."""
    own = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    rows = settle(with_features(settle(candidates(own), "reviewed"), dictionary(docs)), "reviewed-features")
    # counted over neighbourhoods first, so a value of many copies is combined before the shuffle
    around = rows.select("finding", F.xxhash64("near").alias("at")).distinct()
    often = settle(around.groupBy(F.col("finding").alias("__f")).agg(F.count(F.lit(1)).alias("places")).filter(F.col("places") >= PLACES), "places")
    placed = rows.join(often, F.col("finding") == F.col("__f"), "left").withColumn("places", F.coalesce("places", F.lit(1)))
    return placed.select("doc_id", "pos", "run", sure_label().alias("label"))
