"""Collocation mining by best-first growth of phrases from their first words.

A phrase a of words w1 .. wm has a score of at most 1000 * n / f(w1), since the
rest behind its first word occurs at least as often as the phrase. So phrases
grow to the right from single words in waves, rarest first words, which have
the highest bounds, first. In a wave each level extends the frequent prefixes
of the level before by one word. When a wave is scored, the score of each
language's ``top``-th survivor bounds what is still wanted: first words whose
bound is below it are never expanded, and grown phrases whose own bound, from
the counts of their prefixes and of their last word, is below it need no
counts of their other ends.

Texts are read once: the table behind all waves holds 64-bit word hashes (the
language is part of a hash) with 0 between pieces, in rows of bounded size with
a few words of context, so a very long text, or piece, is spread over rows.
Phrases are counted by NumPy inside tasks before they are shuffled. The sets
that decide what a task counts travel as bit fields of at most MOST_BITS bits;
a bit set by chance costs a row that a join on the exact hashes drops.

A word is told from another by its 64-bit hash; if a frequent hash stands for
two words, the job fails instead of giving a wrong row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.llm.hashing import PLACES, _LOWER, mix, prefix_hashes, range_hashes, signed
from basketloom.sources.stage import discard, settle

LONGEST, LEAST, TOP = 5, 100, 2000
#: Language of rows without one.
UNKNOWN = "und"
#: Bytes of text hashed at once, words of a row, and phrases held by a task before it counts them.
TOGETHER, ROW_WORDS, HELD = 1 << 21, 1 << 16, 1 << 19
#: Bits of a bit field: at least 16 for each entry, within these limits.
LEAST_BITS, MOST_BITS = 18, 26
#: Shares of a language's frequent word occurrences, rarest words first, at which a new wave begins.
WAVES = (1 / 8, 1 / 2)

# The characters that end a piece (. , ; : ! ? and U+000A to U+000D), and the blanks between words.
_STOP, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_STOP[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True
_BITS_OF_A_ROW = 1 << 15  # of bitmap_construct_agg


def _hashed(data: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with a 0 between pieces; starts and ends of the words in ``data``, which is lower-cased."""
    stop = _STOP[data]
    apart = stop | _GAP[data]
    edge = np.flatnonzero(np.diff(apart, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    seed = np.frombuffer(lang.encode("utf-8", "surrogatepass"), np.uint8)
    zero, full = np.zeros(1, np.int64), np.array([len(seed)])
    words = mix(range_hashes(prefix_hashes(data), start, end) + range_hashes(prefix_hashes(seed), zero, full) * PLACES[1])
    words[words == 0] = 1
    piece = np.cumsum(stop)[start]
    breaks = np.zeros(len(start), np.int64)
    breaks[1:] = np.cumsum(piece[1:] != piece[:-1])
    out = np.zeros(len(start) + (int(breaks[-1]) if len(start) else 0), np.uint64)
    out[np.arange(len(start)) + breaks] = words
    return out, start, end


def _tokens(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: (lang, words, first, behind) and (lang, key, word, hits).

    The first hold word hashes; phrases may start at places first .. behind - 1,
    the other words are context. The second count the words of a part of a task.
    """
    names = ["lang", "words", "first", "behind", "key", "word", "hits"]
    types = [pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64()]

    def rows(lang, texts):
        data = _LOWER[np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)]
        words, start, end = _hashed(data, lang)
        for low in range(0, len(words), ROW_WORDS):
            high, before = min(low + ROW_WORDS, len(words)), min(low, 1)
            part = words[low - before : high + LONGEST]
            yield lang, part.tobytes(), before, before + high - low, None, None, None
        if len(start):
            found, at, hits = np.unique(words[words != 0], return_index=True, return_counts=True)
            spelled = [data[s:e].tobytes().decode("utf-8", "surrogatepass") for s, e in zip(start[at].tolist(), end[at].tolist())]
            for key, word, k in zip(signed(found).tolist(), spelled, hits.tolist()):
                yield lang, None, None, None, key, word, k

    def run(batches):
        held: dict[str, list[str]] = {}
        size = 0

        def packed():
            found = [row for lang, texts in held.items() for row in rows(lang, texts)]
            columns = zip(*found) if found else [[]] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)
            held.clear()
            return batch

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                if text:
                    held.setdefault(UNKNOWN if lang is None else lang, []).append(text)
                    size += len(text)
                if size >= TOGETHER:
                    yield packed()
                    size = 0
        if held:
            yield packed()

    return docs.select("lang", "text").mapInArrow(run, "lang string, words binary, first int, behind int, key long, word string, hits long")


def _vocabulary(tokens: DataFrame) -> DataFrame:
    """(lang, key, word, f, n, wave, v0 .. v4) of the frequent words.

    ``n`` counts all words of the language; ``v`` are the hash's parts in a
    phrase, by place. Waves are cut between powers of two of ``f``.
    """
    words = settle(tokens.filter("key is not null").groupBy("lang", "key").agg(F.sum("hits").alias("f"), F.min("word").alias("low"), F.max("word").alias("high")), "words")
    whole = words.groupBy("lang").agg(F.sum("f").alias("n"))
    spelled = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(F.lit("one hash stands for two words")))
    often = words.filter(F.col("f") >= LEAST).select("lang", "key", spelled.alias("word"), "f", F.floor(F.log2("f")).cast("int").alias("step"))
    steps = often.groupBy("lang", "step").agg(F.sum("f").alias("k"))
    own = Window.partitionBy("lang")
    before = F.coalesce(F.sum("k").over(own.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wave = sum((before >= share * F.sum("k").over(own)).cast("int") for share in WAVES)
    steps = settle(steps.select("lang", "step", wave.alias("wave")).join(whole, "lang"), "steps")

    def run(batches):
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            parts = [pa.array(signed(key * PLACES[i])) for i in range(LONGEST)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *parts], names=[*batch.schema.names, *_PARTS])

    rows = often.join(steps, ["lang", "step"]).drop("step")
    longs = ", ".join(f"{v} long" for v in _PARTS)
    out = settle(rows.mapInArrow(run, f"lang string, key long, word string, f long, wave int, n long, {longs}"), "vocabulary")
    discard(words, steps)
    return out


_PARTS = [f"v{i}" for i in range(LONGEST)]
_WORDS = [f"w{i}" for i in range(LONGEST)]
_HEADS = [f"l{i}" for i in range(1, LONGEST)]


def _field(hashes: DataFrame, name: str) -> tuple[int, np.ndarray]:
    """Bit field of the upper bits of a column of hashes: how many bits, and the bits."""
    bits = min(max((16 * hashes.count()).bit_length(), LEAST_BITS), MOST_BITS)
    at = F.shiftrightunsigned(name, 64 - bits) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(at).alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows:
        begin = (row["row"] - 1) * _BITS_OF_A_ROW // 8
        out[begin : begin + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)[: len(out) - begin]
    return bits, out


def _in(field: tuple[int, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    bits, table = field
    at = hashes >> np.uint64(64 - bits)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _phrase(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the phrases of ``size`` words that start at the places."""
    out = words[at] * PLACES[0]
    for j in range(1, size):
        out ^= words[at + j] * PLACES[j]
    return out


def _rows(batches):
    """Words of a row, and where phrases start that have at least two words."""
    for batch in batches:
        for words, first, behind in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = np.frombuffer(words.as_buffer(), np.uint64)
            at = np.arange(first, min(behind, len(words) - 1))
            yield words, at[(words[at] != 0) & (words[at + 1] != 0)]


def _longer(words: np.ndarray, at: np.ndarray, place: int) -> np.ndarray:
    """The starts whose phrase goes on to the word at ``place``."""
    at = at[at + place < len(words)]
    return at[words[at + place] != 0]


def _grown(tokens: DataFrame, size: int, first: tuple, prefix: tuple, last: tuple) -> DataFrame:
    """(prefix, part, a, closed) of the phrases of ``size`` words that occur LEAST times.

    Counted are phrases whose first word, prefix of size - 1 words and last word
    are in the bit fields. ``part`` is the last word's part in the hash.
    ``closed`` if all occurrences have the same word to their left, or to their
    right: then a longer phrase occurs as often.
    """
    shared = tokens.sparkSession.sparkContext.broadcast((first, prefix, last))
    names = ["prefix", "part", "k", "left", "right"]

    def run(batches):
        first, prefix, last = shared.value
        held, total = [], 0

        def packed():
            head, part, left, right = (np.concatenate(c) for c in zip(*held))
            whole = head ^ part
            order = np.argsort(whole)
            whole = whole[order]
            begin = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
            alike = []
            for side in (left[order], right[order]):
                low, high = np.minimum.reduceat(side, begin), np.maximum.reduceat(side, begin)
                alike.append(signed(np.where(low == high, low, np.uint64(0))))
            k = np.diff(np.append(begin, len(whole)))
            one = order[begin]
            columns = [signed(head[one]), signed(part[one]), k.astype(np.int64), *alike]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for words, at in _rows(batches):
            at = at[_in(first, words[at])]
            for place in range(2, size):
                at = _longer(words, at, place)
            at = at[_in(last, words[at + size - 1])]
            head = _phrase(words, at, size - 1)
            if size > 2:
                keep = _in(prefix, head)
                at, head = at[keep], head[keep]
            if not len(at):
                continue
            left = np.where(at > 0, words[at - 1], np.uint64(0))
            right = np.where(at + size < len(words), words[np.minimum(at + size, len(words) - 1)], np.uint64(0))
            held.append((head, words[at + size - 1] * PLACES[size - 1], left, right))
            total += len(at)
            if total >= HELD:
                yield packed()
                held, total = [], 0
        if held:
            yield packed()

    rows = tokens.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    ends = [f(c).alias(f"{name}_{c}") for c in ("left", "right") for name, f in (("low", F.min), ("high", F.max))]
    counted = rows.groupBy("prefix", "part").agg(F.sum("k").alias("a"), *ends).filter(F.col("a") >= LEAST)
    same = lambda c: (F.col(f"low_{c}") == F.col(f"high_{c}")) & (F.col(f"low_{c}") != 0)
    return counted.select("prefix", "part", "a", (same("left") | same("right")).alias("closed"))


def _counts_of(tokens: DataFrame, wanted: tuple) -> DataFrame:
    """(phrase, size, f) of all phrases of 2 to LONGEST - 1 words whose hash is in the bit field."""
    shared = tokens.sparkSession.sparkContext.broadcast(wanted)
    names = ["phrase", "size", "k"]

    def run(batches):
        wanted = shared.value
        held: dict[int, list] = {s: [] for s in range(2, LONGEST)}
        total = 0

        def packed():
            columns = [[], [], []]
            for size, parts in held.items():
                if parts:
                    found, k = np.unique(np.concatenate(parts), return_counts=True)
                    columns[0].append(signed(found))
                    columns[1].append(np.full(len(found), size, np.int64))
                    columns[2].append(k.astype(np.int64))
                    parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)

        for words, at in _rows(batches):
            for size in range(2, LONGEST):
                if size > 2:
                    at = _longer(words, at, size - 1)
                phrase = _phrase(words, at, size)
                phrase = phrase[_in(wanted, phrase)]
                if len(phrase):
                    held[size].append(phrase)
                    total += len(phrase)
            if total >= HELD:
                yield packed()
                total = 0
        if total:
            yield packed()

    rows = tokens.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return rows.groupBy("phrase", "size").agg(F.sum("k").alias("f"))


def _exactly(value: str) -> Column:
    return F.col(value).cast("decimal(20,0)")


def _score(left: str, right: str) -> Column:
    """floor(1000 * a * n / (left * right)), in decimals of 38 digits; an error if a * n has more than 35."""
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * _exactly("a") * _exactly("n"), _exactly(left) * _exactly(right))


def _levels(tokens: DataFrame, first: DataFrame, vocabulary: DataFrame, last: tuple) -> list[DataFrame]:
    """Per size from 2 the frequent phrases that begin with a word of ``first``.

    (phrase, size, lang, n, least, a, closed, w0 .., l1 .., end): the words, the counts of
    the prefixes and that of the last word.
    """
    shared = ["lang", "n", "least"]
    level = first.select(F.col("v0").alias("phrase"), *shared, F.col("f").alias("a"), F.col("key").alias("w0"))
    begin, out = _field(first, "key"), []
    for size in range(2, LONGEST + 1):
        prefix = _field(level, "phrase") if size > 2 else begin
        counted = settle(_grown(tokens, size, begin, prefix, last), "counted")
        added = vocabulary.select(F.col(f"v{size - 1}").alias("part"), F.col("key").alias(f"w{size - 1}"), F.col("f").alias("end"))
        parents = level.select(F.col("phrase").alias("prefix"), *shared, F.col("a").alias(f"l{size - 1}"), *_WORDS[: size - 1], *_HEADS[: size - 2])
        rows = counted.join(parents, "prefix").join(added, "part")
        level = settle(
            rows.select(
                F.col("prefix").bitwiseXOR(F.col("part")).alias("phrase"), F.lit(size).cast("long").alias("size"), *shared, "a",
                (F.col("closed") & F.lit(size < LONGEST)).alias("closed"), "end", *_WORDS[:size], *_HEADS[: size - 1],
            ),
            "level",
        )
        discard(counted)
        out.append(level)
        if level.isEmpty():
            break
    return out


def _cuts(rows: DataFrame) -> DataFrame:
    """(phrase, size, cut, l, rest, rest_size) for every cut whose rest has two words or more; other columns kept."""
    names, fields = rows.columns, rows.schema
    kept = [c for c in names if c not in _HEADS]

    def run(batches):
        for batch in batches:
            size = batch.column("size").to_numpy()
            words = [batch.column(w).fill_null(0).to_numpy().view(np.uint64) for w in _WORDS]
            for cut in range(1, LONGEST - 1):
                at = np.flatnonzero(size - cut >= 2)
                if not len(at):
                    continue
                rest = np.zeros(len(at), np.uint64)
                for j in range(cut, LONGEST):
                    rest ^= words[j][at] * PLACES[j - cut]  # no word is 0
                part = batch.take(pa.array(at))
                new = [pa.array(np.full(len(at), cut, np.int64)), part.column(f"l{cut}"), pa.array(signed(rest)), pa.array(size[at] - cut)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *new], names=[*kept, "cut", "l", "rest", "rest_size"])

    kinds = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{kinds}, cut long, l long, rest long, rest_size long")


def _scored(tokens: DataFrame, levels: list[DataFrame], known: DataFrame | None, pool: DataFrame | None, top: int) -> tuple[DataFrame, DataFrame]:
    """Open phrases of the levels that can still count, with score and cut; and the known counts (phrase, size, f) extended.

    The rest behind a cut occurs no more often than its last word, which bounds
    a score from below. The ``top``-th of these bounds and of the scores found
    before settles which phrases need the counts of their rests at all.
    """
    own = levels[0].select("phrase", "size", F.col("a").alias("f"))
    for level in levels[1:]:
        own = own.unionByName(level.select("phrase", "size", F.col("a").alias("f")))
    known = own if known is None else known.unionByName(own)
    kept = ["phrase", "size", "lang", "n", "a", "end"]
    wide = None
    for k, level in enumerate(levels):
        bound = F.least(_score(f"l{k + 1}", "end"), F.expr("1000 * n div l1"))
        rows = level.filter(~F.col("closed")).select("*", bound.alias("bound"), _score("l1", "end").alias("low"))
        rows = rows.filter("least is null or bound >= least").drop("least", "closed")
        wide = rows if wide is None else wide.unionByName(rows, allowMissingColumns=True)
    missing = [c for c in (*_WORDS, *_HEADS) if c not in wide.columns]
    every = settle(wide.select("*", *[F.lit(None).cast("long").alias(c) for c in missing]), "open")
    sure = every.select("lang", F.col("low").alias("score"))
    least = settle(_settled(sure if pool is None else sure.unionByName(pool.select("lang", "score")), top), "least")
    wide = settle(every.join(least, "lang", "left").filter("least is null or bound >= least").select(*kept, *_WORDS, *_HEADS), "open")
    discard(every)
    cuts = settle(_cuts(wide), "cuts")
    wanted = cuts.select(F.col("rest").alias("phrase"), F.col("rest_size").alias("size")).distinct()
    unknown = settle(wanted.join(known, ["phrase", "size"], "left_anti"), "unknown")
    if not unknown.isEmpty():
        more = _counts_of(tokens, _field(unknown, "phrase")).join(unknown, ["phrase", "size"], "left_semi")
        known = known.unionByName(settle(more, "suffixes").select("phrase", "size", "f"))
    rests = known.select(F.col("phrase").alias("rest"), F.col("size").alias("rest_size"), F.col("f").alias("r"))
    inner = cuts.join(rests, ["rest", "rest_size"]).select(*kept, *_WORDS, "cut", "l", "r")
    final = F.coalesce(*[F.when(F.col("size") == k + 1, F.col(f"l{k}")) for k in range(1, LONGEST)])
    outer = wide.select(*kept, *_WORDS, (F.col("size") - 1).alias("cut"), final.alias("l"), F.col("end").alias("r"))
    each = inner.unionByName(outer).withColumn("score", _score("l", "r"))
    worst = F.min(F.struct("score", "cut", "l", "r"))
    same = [F.min(c).alias(c) for c in ("lang", "n", "a", *_WORDS)]
    scored = each.groupBy("phrase", "size").agg(worst.alias("worst"), *same)
    return scored.select("phrase", "size", "lang", "n", "a", *_WORDS, "worst.*"), known


def _settled(pool: DataFrame, top: int) -> DataFrame:
    """(lang, least): the top-th score of each language that has so many."""
    spec = Window.partitionBy("lang").orderBy(F.desc("score"))
    best = pool.select("lang", "score", F.row_number().over(spec).alias("rank")).filter(F.col("rank") <= top)
    return best.groupBy("lang").agg(F.count(F.lit(1)).alias("k"), F.min("score").alias("least")).filter(F.col("k") == top).drop("k")


def _spelled(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The rows with their phrase in words instead of its hash."""
    each = rows.select("phrase", "size", F.posexplode(F.array(*_WORDS)).alias("at", "key")).filter("key is not null")
    named = each.join(vocabulary.select("key", "word"), "key").groupBy("phrase", "size").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    text = named.select("phrase", "size", F.array_join("words.word", " ").alias("text"))
    return rows.drop(*_WORDS).join(text, ["phrase", "size"]).drop("phrase", "size").withColumnRenamed("text", "phrase")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut): each language's best ``top`` phrases of 2 to LONGEST words.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and U+000A to U+000D into
    pieces and at blanks and tabs into words. A phrase counts from LEAST
    occurrences (``a``), overlapping ones included. Of its cuts into a first
    part (``l`` occurrences) and a rest (``r``) the one with the lowest score
    floor(1000 * a * n / (l * r)) counts, ``n`` being the language's words, the
    first of equals. A phrase goes if a longer one that holds it occurs as
    often. Ranks go by score, then ``a``, both descending, then by phrase.

    Needs lang and text; other columns are ignored. A null lang is ``und``; null
    and blank texts have no words; rows that repeat count each. No frequent
    phrases, or no rows, give no rows.
    """
    tokens = settle(_tokens(docs), "tokens")
    vocabulary = _vocabulary(tokens)
    tokens = tokens.filter("words is not null").select("words", "first", "behind")
    pool, known, least = None, None, None
    last = _field(vocabulary, "key")
    for wave in range(len(WAVES) + 1):
        first = vocabulary.filter(F.col("wave") == wave)
        if least is None:
            first = first.withColumn("least", F.lit(None).cast("long"))
        else:
            first = first.join(least, "lang", "left").filter("least is null or 1000 * n div f >= least")
        first = settle(first, "first")
        if first.isEmpty():
            continue
        levels = _levels(tokens, first, vocabulary, last)
        scored, known = _scored(tokens, levels, known, pool, top)
        rows = scored if pool is None else pool.unionByName(scored)
        fresh = settle(rows, "scored")
        least = settle(_settled(fresh, top), "least")
        kept = fresh.join(least, "lang", "left").filter("least is null or score >= least").drop("least")
        pool = settle(kept, "pool")
        discard(first, fresh)
    if pool is None:
        kinds = "lang string, rank long, phrase string, a long, l long, r long, n long, score long, cut long"
        return docs.sparkSession.createDataFrame([], kinds)
    spec = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _spelled(pool, vocabulary).withColumn("rank", F.row_number().over(spec).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
