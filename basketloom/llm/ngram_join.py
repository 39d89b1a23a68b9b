"""Near-duplicate join on word shingles: rare-first prefixes, filters, one exact check per pair."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm.components import components, extended
from basketloom.llm.hashing import mix, shingles, signed, text_rows
from basketloom.sources.stage import discard, settle

#: Shingles with an exact place in the global order; all others count as rare and follow their hash.
FREQUENT = 1 << 17
#: A task reports shingles that it has met this often; bounds what counting ships.
LOCAL = 4
#: Hashes held by a task before it counts them.
HELD = 1 << 22
#: Cells of the histogram behind the suffix filter.
CELLS = 16
#: 64-bit words of the parity sketch of a set, and of the one folded from it for the join condition.
SKETCH = [f"s{i}" for i in range(16)]
FOLDED = [f"f{i}" for i in range(4)]
#: Members compared with one text in one task.
CHUNK = 256
#: Sets of a component, and their shingles, that a task which counts links holds per side, about.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
#: Shingles compared at once there.
WIDTH = 4096
#: What names a distinct set.
SET = ["n", "key", "key2"]
#: Members compared with per prefix shingle in each of the first rounds, before all remaining pairs.
STARS = (1, 4)


def _profiles(docs: DataFrame) -> DataFrame:
    """Per document its set (size, 128-bit key, histogram, parity sketch), and per task its frequent shingles."""
    names = ("doc_id", "n", "key", "key2", "cells", "hits", *SKETCH)
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), *[pa.int64()] * len(SKETCH))

    def run(batches):
        rows: dict[str, list] = {n: [] for n in names}
        held, size, chars = [], 0, 0

        def put(**row):
            for name, values in rows.items():
                values.append(row.get(name))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=names)
            for values in rows.values():
                values.clear()
            return out

        def count():
            found, times = np.unique(np.concatenate(held), return_counts=True)
            for h, k in zip(signed(found[times >= LOCAL]).tolist(), times[times >= LOCAL].tolist()):
                put(key=h, hits=k)
            held.clear()

        for doc_id, text in text_rows(batches):
            have = shingles(text)
            if len(have):
                mixed = mix(have)
                odd = np.bincount((mixed & np.uint64(64 * len(SKETCH) - 1)).astype(np.int64), minlength=64 * len(SKETCH)) & 1
                put(
                    doc_id=doc_id,
                    n=len(have),
                    key=int(signed(have.sum(keepdims=True, dtype=np.uint64))[0]),
                    key2=int(signed(mixed.sum(keepdims=True, dtype=np.uint64))[0]),
                    cells=np.bincount((mixed >> np.uint64(60)).astype(np.int64), minlength=CELLS).astype("<u4").tobytes(),
                    **dict(zip(SKETCH, np.packbits(odd.astype(bool)).view("<i8").tolist())),
                )
                held.append(have)
                size += len(have)
            else:
                put(doc_id=doc_id, n=0, key=0, key2=0)
            if size >= HELD:
                count()
                size = 0
            if len(rows["n"]) >= 10_000:
                yield flush()
        if held:
            count()
        yield flush()

    sketch = ", ".join(f"{s} long" for s in SKETCH)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n int, key long, key2 long, cells binary, hits long, {sketch}")


def _order(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, at most FREQUENT, sorted by hash, and their counts.

    A histogram over powers of two gives the count from which they fit.
    """
    held = settle(counts.groupBy("key").agg(F.sum("hits").alias("hits")), "frequent")
    steps = held.groupBy(F.floor(F.log2("hits")).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in steps:
        total += row["count"]
        if total > FREQUENT:
            break
        least = 1 << row["step"]
    if least is None:
        discard(held)
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = held.filter(F.col("hits") >= least).toArrow()
    discard(held)
    keys = top["key"].to_numpy().view(np.uint64)
    at = np.argsort(keys)
    return keys[at], top["hits"].to_numpy()[at]


def _least_size(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def _postings(docs: DataFrame, counts: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """(token, doc_id, n, pos): the rare-first prefix of every set."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        keys, hits = shared.value
        out: list[list] = [[], [], [], []]
        size = 0

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["token", "doc_id", "n", "pos"])
            for c in out:
                c.clear()
            return batch

        for doc_id, text in text_rows(batches):
            have = shingles(text)
            n = len(have)
            if not n or doc_id is None:
                continue
            if len(keys):
                at = np.minimum(np.searchsorted(keys, have), len(keys) - 1)
                have = have[np.argsort(np.where(keys[at] == have, hits[at], 0), kind="stable")]
            p = n - (n * percent + 99) // 100 + 1
            out[0].append(signed(have[:p]))
            out[1].append(np.full(p, doc_id, np.int64))
            out[2].append(np.full(p, n, np.int32))
            out[3].append(np.arange(p, dtype=np.int32))
            size += p
            if size > 1 << 17:
                yield flush()
                size = 0
        if size:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, "token long, doc_id long, n int, pos int")


def _least_shared(percent: int) -> Column:
    """The smallest intersection of a link of sets of n and m."""
    return F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent) - 1e-9)


def _may_link(percent: int) -> Column:
    """Length and positional filter of a pair that shares a prefix shingle.

    ``least`` is the smallest intersection of a link; the shared shingle and all
    behind it must be able to reach it. It holds for the first shared shingle,
    so a pair passes if any of its shared shingles passes.
    """
    reach = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("pos2"))
    return (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent) & (reach >= _least_shared(percent))


def _folded() -> list[Column]:
    """Folding a parity sketch by XOR gives the sketch of fewer bits."""
    fold = lambda a, b: a.bitwiseXOR(b)
    return [reduce(fold, map(F.col, SKETCH[i :: len(FOLDED)])).alias(name) for i, name in enumerate(FOLDED)]


def _sketches_near(percent: int, sketch: list[str]) -> Column:
    """Sketch filter: every bit in which two parity sketches differ stands for at least one element of only one set."""
    differ = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"{s}_b"))) for s in sketch), F.lit(0))
    return differ <= F.col("n") + F.col("m") - 2 * _least_shared(percent)


def _other_side(sets: DataFrame) -> DataFrame:
    """The sets under the names that a pair's second side has."""
    names = {"doc_id": "b", "n": "m", "pos": "pos2", "root": "root2", "token": "token_b", "cells": "cells_b"} | {s: f"{s}_b" for s in SKETCH + FOLDED}
    return sets.select(*[F.col(c).alias(names.get(c, c)) for c in sets.columns])


def _suffix_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Drop pairs whose sets differ too much in a histogram over fixed hash pivots.

    Both sets are cut at the same pivots, as a suffix filter does four levels
    deep; the differences of the cells bound the symmetric difference from below.
    """

    def run(batches):
        for batch in batches:
            n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, CELLS).astype(np.int64) for i in (4, 5)
            )
            differ = np.abs(a - b).sum(1)
            # 100 * same >= percent * (n + m - same), with same <= (n + m - differ) / 2
            keep = (n + m - differ) * (100 + percent) >= 2 * percent * (n + m)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    sets = sets.select("doc_id", "n", "cells", *SKETCH)
    both = pairs.join(sets.withColumnRenamed("doc_id", "a"), "a").join(_other_side(sets), "b").filter(_sketches_near(percent, SKETCH))
    return both.select("a", "b", "n", "m", "cells", "cells_b").mapInArrow(run, "a long, b long").distinct()


def _between(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components that share a prefix shingle and pass the filters.

    Per shingle the members outside its largest component meet all members, so
    a component never meets itself at large. The filters are the join's
    condition: a pair that fails them is no row.
    """
    groups = rest.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = groups.groupBy("token").agg(F.max(F.struct("k", "root"))["root"].alias("largest"))
    full = settle(rest.join(sets.select("doc_id", "n", *_folded()), ["doc_id", "n"]).join(largest, "token"), "members")
    few = full.filter("root <> largest").drop("largest").withColumnRenamed("doc_id", "a")
    pairs = few.join(
        _other_side(full),
        (F.col("token") == F.col("token_b"))
        & (F.col("root") != F.col("root2"))
        & ((F.col("root2") == F.col("largest")) | (F.col("root") < F.col("root2")))
        & _may_link(percent)
        & _sketches_near(percent, FOLDED),
    )
    return pairs.select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by their exact sets.

    Texts travel once per pair and side. A text with many partners is sent to
    as many tasks as it has chunks of partners.
    """

    def run(batches):
        place, left = None, []
        for batch in batches:
            a, b = [], []
            for key, chunk, role, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if role == 0:
                    if (key, chunk) != place:
                        place, left = (key, chunk), []
                    left.append(shingles(text))
                    continue
                right = shingles(text)
                for have in left if (key, chunk) == place else ():
                    same = len(np.intersect1d(have, right, assume_unique=True))
                    if same and 100 * same >= percent * (len(have) + len(right) - same):
                        a.append(key)
                        b.append(doc_id)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    spark = docs.sparkSession
    sizes = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    rows = pairs.join(sizes, "b").select(
        F.col("b").alias("key"), F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int").alias("chunk"), F.col("a").alias("doc_id")
    )
    asked = settle(
        rows.select("key", "chunk", F.lit(1).alias("role"), "doc_id").unionByName(
            rows.select("key", "chunk").distinct().select("key", "chunk", F.lit(0).alias("role"), F.col("key").alias("doc_id"))
        ),
        "asked",
    )
    # a few wanted documents reach the scan as a Bloom filter, so other texts are not shuffled
    setting, before = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", None
    before = spark.conf.get(setting)
    spark.conf.set(setting, "0")
    try:
        placed = asked.join(docs.select("doc_id", "text"), "doc_id").select("key", "chunk", "role", "doc_id", "text")
        dealt = placed.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "role")
        found = settle(dealt.mapInArrow(run, "a long, b long"), "verified")
    finally:
        spark.conf.set(setting, before)
    discard(asked)
    return found


def near_links(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Links and sets of near-duplicate documents.

    Returns ``links`` (a, b), enough to connect every two documents of which
    100 * intersection >= percent * union, and ``sets`` (doc_id, n), one row per
    input row. Equal sets are linked to their smallest doc_id first. Then, in
    each round, every document of a prefix shingle is compared with one or a few
    others; shingles whose documents are all connected are done; last, all remaining
    pairs from different components are compared. No link between different
    sets that matters to the components is lost, and a large group of copies
    never makes all its pairs.

    Needs doc_id (bigint) and text; other columns are ignored. Rows with a null
    doc_id take no part; rows that share a doc_id count as one document, linked
    wherever one of its texts is. Null or blank texts have empty sets and link
    with nothing.
    """
    links, sets, roots = _linked(docs, percent)
    discard(roots)
    return links, sets.select("doc_id", "n")


def _linked(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The links and sets of :func:`near_links`, and the roots of the links."""
    profiles = settle(_profiles(docs), "profiles")
    sets = profiles.filter("hits is null").drop("hits")
    frequent = _order(profiles.filter("hits is not null").select("key", "hits"))
    real = sets.filter("n > 0 and doc_id is not null")
    # several rows only for a doc_id with several texts
    one = real.dropDuplicates(["doc_id", "n", "key", "key2"])
    # written first, so that the join below stands alone and a large group of copies can be split
    same = settle(real.groupBy("n", "key", "key2").agg(F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k"), "same")
    copies = settle(real.join(same, ["n", "key", "key2"]).filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b"), "copies")

    postings = settle(_postings(docs, frequent, percent), "postings")
    # the smaller set of a link has a shared shingle so early that sets of its own size could link
    early = F.col("n") - F.col("pos") >= F.ceil(F.col("n") * 2 * percent / (100 + percent) - 1e-9)
    counted = postings.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.max(early).alias("early"))
    several = counted.filter("k > 1 and early").select("token")
    # a copy needs no shingles of its own, unless its doc_id has other texts too
    lone = one.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k = 1").select("doc_id")
    spared = copies.select(F.col("a").alias("doc_id")).join(lone, "doc_id", "left_semi")
    shared = settle(postings.join(several, "token", "left_semi").join(spared, "doc_id", "left_anti"), "shared")
    discard(postings)
    links, found, rest = None, None, shared.withColumn("root", F.col("doc_id"))
    for turn in range(len(STARS) + 1):
        if links is not None:
            # a shingle whose documents are connected stays so
            open_ = rest.drop("root").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
                "root", F.coalesce("root", "doc_id")
            )
            split = open_.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2")
            before, rest = rest, settle(open_.join(split.select("token"), "token", "left_semi"), "open")
            discard(before)
        if rest.isEmpty():
            break
        if turn < len(STARS):
            # first the same member for all shingles of a group, so pairs repeat; then any members per shingle
            weights = [F.xxhash64("root") if turn == 0 else F.xxhash64("doc_id", "token", F.lit(turn), F.lit(i)) for i in range(STARS[turn])]
            member = F.struct("doc_id", "root", "n", "pos")
            centres = rest.groupBy("token").agg(F.array_distinct(F.array(*[F.min_by(member, w) for w in weights])).alias("all"))
            centre = centres.select("token", F.explode("all").alias("c"))
            pairs = rest.join(centre, "token").select(
                F.col("doc_id").alias("a"), F.col("c.doc_id").alias("b"), "n", F.col("c.n").alias("m"), "pos",
                F.col("c.pos").alias("pos2"), "root", F.col("c.root").alias("root2"),
            ).filter((F.col("root") != F.col("root2")) & _may_link(percent))
        else:
            pairs = _between(rest, one, percent)
        pairs = pairs.select("a", "b").distinct()
        kept = settle(_suffix_filter(pairs, one, percent), "pairs")
        fresh = _verified(kept, docs, percent)
        discard(kept)
        if links is None:
            links, found = fresh, components(fresh)
        else:
            old, found = found, extended(found, fresh)
            links = links.unionByName(fresh)
            discard(old)
    discard(rest)
    if links is None:
        return copies, sets.select("doc_id", *SET), components(copies)
    roots = extended(found, copies)
    discard(found)
    return links.unionByName(copies), sets.select("doc_id", *SET), roots


def _near(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of ``left`` link with which of ``right``, by exact intersections."""
    sizes = np.array([len(h) for h in left + right], np.int64)
    _, token, times = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    keep = times[token] > 1
    owner, token = np.repeat(np.arange(len(sizes)), sizes)[keep], np.cumsum(times > 1)[token[keep]] - 1
    at = np.argsort(token, kind="stable")
    owner, token = owner[at], token[at]
    same, k = np.zeros((len(left), len(right)), np.int64), len(left)
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, WIDTH):
        part = slice(*np.searchsorted(token, [start, start + WIDTH]))
        have = np.zeros((len(sizes), min(WIDTH, int(token[-1]) + 1 - start)), np.float32)
        have[owner[part], token[part] - start] = 1
        same += (have[:k] @ have[k:].T).astype(np.int64)
    return (same > 0) & (100 * same >= percent * (sizes[:k, None] + sizes[None, k:] - same))


def _partners(docs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """(n, key, key2, links, n_b, key_b, key2_b): the links of every distinct set with others, as sums of their weights.

    Linked sets are in one component, so every two sets of a component are
    compared. A component is dealt in blocks, and each two blocks meet in a
    task, which gives one row per set; a text is sent once per block. Only a link with a set of a document of
    several texts is a row of its own, with the other set's name.
    """
    names = (*SET, "links", *(f"{c}_b" for c in SET))
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def compared(group):
        sides = [[m for m in group.values() if m[0] == b] for b in sorted({m[0] for m in group.values()})]
        left, right = sides[0], sides[-1]
        near = _near([m[4] for m in left], [m[4] for m in right], percent)
        if left is right:
            np.fill_diagonal(near, False)
        for a, b, link in ((left, right, near), (right, left, near.T)) if left is not right else ((left, right, near),):
            for m, total in zip(a, (link @ np.array([x[2] for x in b], np.int64)).tolist()):
                yield (*m[1], total, None, None, None)
            marked = link & (np.array([m[3] for m in a], bool)[:, None] | np.array([m[3] for m in b], bool)[None])
            for i, j in np.argwhere(marked).tolist():
                yield (*a[i][1], 0, *b[j][1])

    def run(batches):
        place, group, out = None, {}, []

        def flush():
            # two blocks of which one is empty have nothing to compare
            if place and (place[1] == place[2] or len({m[0] for m in group.values()}) == 2):
                out.extend(compared(group))

        def packed():
            columns = zip(*out) if out else [[]] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=list(names))
            out.clear()
            return batch

        for batch in batches:
            for *here, block, n, key, key2, weight, several, text in zip(*(c.to_pylist() for c in batch.columns)):
                if here != place:
                    flush()
                    place, group = here, {}
                have = shingles(text)
                sums = [int(signed(x.sum(keepdims=True, dtype=np.uint64))[0]) for x in (have, mix(have))] if len(have) else None
                # another text of the same doc_id is another set
                if len(have) == n and sums == [key, key2]:
                    group[n, key, key2] = (block, (n, key, key2), weight, several, have)
            if len(out) >= 10_000:
                yield packed()
        flush()
        yield packed()

    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    sizes = own.groupBy("root").agg(F.count(F.lit(1)).alias("k"), blocks).filter("k > 1").drop("k")
    placed = own.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("key", "key2"), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("other", F.explode_outer(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = settle(
        pairs.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", *SET, "weight", "several", "doc_id"),
        "asked",
    )
    dealt = asked.join(docs.select("doc_id", "text"), "doc_id").drop("doc_id").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    counts = settle(dealt.mapInArrow(run, "n int, key long, key2 long, links long, n_b int, key_b long, key2_b long"), "partners")
    discard(asked)
    return counts


def _link_counts(docs: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n_links) of all documents that link: with how many other doc_ids.

    Sets count with the number of their documents of one text. The few
    documents of several texts are counted by doc_id, so that one that links
    with two texts counts once.
    """
    real = sets.filter("n > 0 and doc_id is not null").distinct().join(roots.withColumnRenamed("node", "doc_id"), "doc_id")
    texts = real.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("several"))
    members = settle(real.join(texts, "doc_id"), "members")
    plain = F.sum((~F.col("several")).cast("long")).alias("weight")
    own = settle(members.groupBy("root", *SET).agg(F.min("doc_id").alias("doc_id"), plain, F.max("several").alias("several")), "own")
    rows = _partners(docs, own, percent)
    links = rows.groupBy(*SET).agg(F.sum("links").alias("links"))
    weights = own.select(*SET, "weight")
    total = weights.join(links, SET, "left").select(*SET, (F.col("weight") + F.coalesce("links", F.lit(0)) - 1).alias("n_links"))
    many = members.filter("several").select("doc_id", *SET)
    if many.isEmpty():
        return members.join(settle(total, "totals"), SET).select("doc_id", "n_links")
    other = lambda df: df.select(*[F.col(c).alias(f"{c}_b") for c in SET], *[c for c in df.columns if c not in SET])
    itself = own.filter("several").select(*SET, *[F.col(c).alias(f"{c}_b") for c in SET])
    pairs = settle(rows.filter("n_b is not null").select(*itself.columns).unionByName(itself), "pairs")
    key_b = [f"{c}_b" for c in SET]
    owners = other(many.withColumnRenamed("doc_id", "other"))
    more = pairs.join(owners, key_b).select(*SET, "other").distinct().groupBy(*SET).agg(F.count(F.lit(1)).alias("more"))
    total = total.join(more, SET, "left").select(*SET, (F.col("n_links") + F.coalesce("more", F.lit(0))).alias("n_links"))
    lone = members.filter("not several").join(settle(total, "totals"), SET).select("doc_id", "n_links")
    near = settle(many.join(pairs, SET).select("doc_id", *key_b).distinct(), "near")
    by_weight = near.join(other(weights), key_b).groupBy("doc_id").agg(F.sum("weight").alias("k"))
    by_doc = near.join(owners, key_b).select("doc_id", "other").distinct().groupBy("doc_id").agg((F.count(F.lit(1)) - 1).alias("k"))
    return lone.unionByName(by_weight.unionByName(by_doc).groupBy("doc_id").agg(F.sum("k").alias("n_links")))


def _named(sets: DataFrame, roots: DataFrame) -> DataFrame:
    least = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    named = roots.join(least, "root").select(F.col("node").alias("doc_id"), "component_id")
    return sets.join(named, "doc_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: :func:`near_classes` without counting links."""
    _, sets, roots = _linked(docs, percent)
    return _named(sets, roots)


def near_classes(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of ``docs``.

    component_id is the smallest doc_id reachable by links, itself included;
    n_links counts the other doc_ids that link with this one, copies included.
    See :func:`near_links` for nulls, blanks, ties and repeated rows; a row
    without doc_id has component_id null and no links.
    """
    _, sets, roots = _linked(docs, percent)
    counts = _link_counts(docs, sets, roots, percent)
    return _named(sets, roots).join(counts, "doc_id", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
