"""Removal of repeated 400-byte strings by hash-compared suffix sorting of anchored places.

Every 400-byte window names an anchor: of the 100 places where one of its
first 100-byte strings starts, the one of least hash, the leftmost on ties.
That depends on the window's bytes only, so equal windows name the same place
in themselves, and all windows of an anchor contain the 301 bytes after it.
Neighbouring windows with the same anchor form a run. Only runs whose 301 bytes
occur again are looked at further; equal runs are repeated as a whole; the few
that are left are sorted as suffixes next to all others of their anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.hashing import PLACES, mix, powers, INVERSE, prefix_hashes, range_hashes, signed
from basketloom.sources.stage import discard, settle

#: Bytes of a repeated string, of an anchor's string, and places looked at for it.
WINDOW, GRAM, REACH = 400, 100, 100
CORE = WINDOW - REACH + 1
#: Windows of a text handled at once; an anchor's place must fit beside its hash.
CHUNK, PLACE_BITS = 1 << 19, 20
#: Runs of one anchor that one task sorts; larger groups are counted window by window.
SORTED = 2_000

_RUNS = "anchor long, whole long, doc_id long, version long, start int, n int, lead int"
_KEY = ["doc_id", "version"]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    least, span = values, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    size = len(values) - width + 1
    return np.minimum(least[:size], least[width - span : width - span + size])


def anchored_runs(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, run hash, start, windows, lead) of a text's runs; lead is the anchor's distance."""
    windows = len(data) - WINDOW + 1
    for begin in range(0, max(0, windows), CHUNK):
        count = min(CHUNK, windows - begin)
        prefix = prefix_hashes(data[begin : begin + count + WINDOW - 1])
        at = np.arange(count + REACH - 1)
        grams = mix((prefix[GRAM : GRAM + len(at)] - prefix[: len(at)]) * powers(len(at), INVERSE))
        low = np.uint64((1 << PLACE_BITS) - 1)
        place = (_sliding_min((grams & ~low) | at.astype(np.uint64), REACH) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        past = np.append(first[1:], count)
        anchor = place[first]
        yield (
            range_hashes(prefix, anchor, anchor + CORE),
            mix(range_hashes(prefix, first, past + WINDOW - 1) + (anchor - first).astype(np.uint64) * PLACES[1]),
            first + begin,
            past - first,
            anchor - first,
        )


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _runs(docs: DataFrame) -> DataFrame:
    names = [f.split()[0] for f in _RUNS.split(", ")]

    def run(batches):
        held: list[list] = [[] for _ in names]
        size = 0

        def flush():
            columns = [np.concatenate(c) for c in held]
            mask = columns[2] == _NONE
            arrays = [pa.array(c, mask=mask) if i == 2 and mask.any() else pa.array(c) for i, c in enumerate(columns)]
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for doc_id, version, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for anchor, whole, start, n, lead in anchored_runs(_bytes(text.as_py())):
                    own = np.full(len(start), _NONE if doc_id is None else doc_id, np.int64)
                    parts = (signed(anchor), signed(whole), own, np.full(len(start), version, np.int64))
                    for column, part in zip(held, (*parts, start.astype(np.int32), n.astype(np.int32), lead.astype(np.int32))):
                        column.append(part)
                    size += len(start)
                if size > 1 << 16:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(run, _RUNS)


_NONE = np.iinfo(np.int64).min  # stands for a null doc_id inside NumPy arrays


def _same_doc(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (doc_id, version), nulls being equal; the columns of ``left`` and the others of ``right``."""
    named = right.withColumnsRenamed({"doc_id": "__doc", "version": "__version"})
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("version") == F.col("__version"))
    return left.join(named, same, how).drop("__doc", "__version")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of each wanted run, from its first window to the end of its last.

    Equal rows give their runs once each, which is right: their windows are repeated.
    """
    lists = wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("anchor", "copies", "members", "start", "n", "lead")).alias("runs"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    placed = _same_doc(texts, lists, "inner").select("doc_id", "version", "text", "runs")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = _bytes(batch.column(2)[i].as_py()).tobytes()
                rows = batch.column(3)[i].as_py()
                columns = [[r[k] for r in rows] for k in ("anchor", "copies", "members", "start", "n", "lead")]
                parts = [data[r["start"] : r["start"] + r["n"] + WINDOW - 1] for r in rows]
                kinds = (pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 3)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[i].as_py()] * len(rows), pa.int64()),
                        pa.array([batch.column(1)[i].as_py()] * len(rows), pa.int64()),
                        *[pa.array(c, k) for c, k in zip(columns, kinds)],
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc_id", "version", "anchor", "copies", "members", "start", "n", "lead", "bytes"],
                )

    return placed.mapInArrow(
        run, "doc_id long, version long, anchor long, copies long, members long, start int, n int, lead int, bytes binary"
    )


def sort_suffixes(parts: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the byte strings, and the common prefix of each with the one before it.

    Two strings are compared by binary search for the last length at which
    their prefix hashes agree, then by one byte. Python's sort is a mergesort.
    The common prefixes of neighbours are checked on the bytes.
    """
    sums = [prefix_hashes(np.frombuffer(p, np.uint8)).tolist() for p in parts]

    def common(i: int, j: int) -> int:
        a, b = sums[i], sums[j]
        low, high = 0, min(len(a), len(b)) - 1
        while low < high:
            mid = (low + high + 1) // 2
            if a[mid] == b[mid]:
                low = mid
            else:
                high = mid - 1
        return low

    def compare(i: int, j: int) -> int:
        at = common(i, j)
        return (parts[i][at : at + 1] > parts[j][at : at + 1]) - (parts[i][at : at + 1] < parts[j][at : at + 1])

    order = sorted(range(len(parts)), key=cmp_to_key(compare))
    shared = [0]
    for i, j in zip(order, order[1:]):
        at = common(i, j)
        if parts[i][:at] != parts[j][:at]:  # hashes met by chance
            at = next(k for k in range(at) if parts[i][k] != parts[j][k])
        shared.append(at)
    return order, shared


def repeated_windows(rows: list[tuple[bytes, int, int, int]]) -> list[np.ndarray]:
    """For runs (bytes, copies, windows, lead) of one anchor: which windows occur again, copies included.

    A window that starts ``a`` bytes before the anchor is equal to another if
    both lie in one stretch of the suffix order whose common prefixes reach
    400 - a bytes, and their ``a`` bytes in front agree by hash. Windows found
    equal are compared as bytes.
    """
    order, shared = sort_suffixes([data[lead:] for data, _, _, lead in rows])
    near = np.array(shared)
    stretch = np.cumsum(near[None, :] < (WINDOW - np.arange(REACH))[:, None], axis=1)
    keys, owner, offset = [], [], []
    for rank, k in enumerate(order):
        data, _, n, lead = rows[k]
        t = np.arange(n)
        a = lead - t
        front = range_hashes(prefix_hashes(np.frombuffer(data[:lead], np.uint8)), t, np.full(n, lead))
        keys.append(mix(front + stretch[a, rank].astype(np.uint64) * PLACES[2] + a.astype(np.uint64) * PLACES[3]))
        owner.append(np.full(n, k))
        offset.append(t)
    key, owner_, offset_ = (np.concatenate(x) for x in (keys, owner, offset))
    by_key = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.diff(key[by_key], append=~key[by_key][-1:])) + 1
    out = [np.full(n, copies > 1) for _, copies, n, _ in rows]
    begin = 0
    for end in ends.tolist():
        group = by_key[begin:end]
        begin = end
        if len(group) < 2:
            continue
        where = list(zip(owner_[group].tolist(), offset_[group].tolist()))
        first = rows[where[0][0]][0][where[0][1] : where[0][1] + WINDOW]
        if all(rows[k][0][t : t + WINDOW] == first for k, t in where[1:]):
            for k, t in where:
                out[k][t] = True
        else:
            seen: dict[bytes, list] = {}
            for k, t in where:
                seen.setdefault(rows[k][0][t : t + WINDOW], []).append((k, t))
            for same in seen.values():
                for k, t in same if len(same) > 1 else ():
                    out[k][t] = True
    return out


def _spans(flags: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Byte spans of the flagged windows of a run."""
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)).tolist()
    return [(start + a, start + b + WINDOW - 1) for a, b in zip(edge[::2], edge[1::2])]


_SPANS = "doc_id long, version long, begin int, past int"


def _sorted_spans(contexts: DataFrame) -> DataFrame:
    """Spans from groups of up to SORTED runs, one anchor after the other."""

    def run(batches):
        held: list[tuple] = []

        def close():
            found = []
            if len(held) > 1:
                flags = repeated_windows([(r[7], r[3], r[5], r[6]) for r in held])
                for r, f in zip(held, flags):
                    if r[3] == 1:  # copies of a whole run have their spans already
                        found += [(r[0], r[1], a, b) for a, b in _spans(f, r[4])]
            held.clear()
            return found

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][2] != row[2]:
                    out += close()
                held.append(row)
            yield _batch(out)
        yield _batch(close())

    columns = ["doc_id", "version", "anchor", "copies", "start", "n", "lead", "bytes"]
    return contexts.select(*columns).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _SPANS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "version", "begin", "past"])


def _counted_spans(contexts: DataFrame) -> DataFrame:
    """Spans from larger groups: one row per window, counted by two hashes before the shuffle."""

    def run(batches):
        for batch in batches:
            for doc_id, version, anchor, copies, start, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = prefix_hashes(np.frombuffer(data, np.uint8))
                at = np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * n, pa.int64()), pa.array([version] * n, pa.int64()), pa.array([anchor] * n, pa.int64()),
                        pa.array(signed(range_hashes(prefix, at, at + WINDOW))), pa.array([copies] * n, pa.int64()),
                        pa.array((at + start).astype(np.int32)),
                    ],
                    names=["doc_id", "version", "anchor", "h", "copies", "begin"],
                )

    columns = ["doc_id", "version", "anchor", "copies", "start", "n", "bytes"]
    rows = contexts.select(*columns).mapInArrow(run, "doc_id long, version long, anchor long, h long, copies long, begin int")
    twice = rows.groupBy("anchor", "h").agg(F.sum("copies").alias("k")).filter("k > 1").select("anchor", "h")
    return rows.filter("copies = 1").join(twice, ["anchor", "h"], "left_semi").select(
        "doc_id", "version", "begin", (F.col("begin") + WINDOW).alias("past")
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, version, begin, past): byte spans, possibly overlapping, of all repeated 400-byte strings.

    ``version`` is the hash of the text, so rows with one doc_id and different
    texts stay apart; equal rows are occurrences of each other.
    """
    runs = settle(_runs(docs), "runs")
    # written first, so that the join below stands alone and a hot anchor can be split
    several = settle(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor"), "anchors")
    again = settle(runs.join(several, "anchor", "left_semi"), "again")
    discard(runs)
    classes = settle(
        again.groupBy("anchor", "whole").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "version", "start", "n", "lead")).alias("one")
        ),
        "classes",
    )
    mixed = classes.groupBy("anchor").agg(F.min("copies").alias("least"), F.count(F.lit(1)).alias("members"))
    wanted = classes.join(mixed.filter("least = 1 and members > 1").select("anchor", "members"), "anchor").select(
        "anchor", "copies", "members", "one.*"
    )
    setting = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = docs.sparkSession.conf.get(setting)
    docs.sparkSession.conf.set(setting, "0")  # texts without wanted runs need no shuffle
    try:
        contexts = settle(_contexts(docs, settle(wanted, "wanted")), "contexts")
    finally:
        docs.sparkSession.conf.set(setting, before)
    sorted_ = settle(_sorted_spans(contexts.filter(F.col("members") <= SORTED)), "spans")
    counted = settle(_counted_spans(contexts.filter(F.col("members") > SORTED)), "spans")
    discard(contexts)
    copied = again.join(classes.filter("copies > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi")
    whole = copied.select("doc_id", "version", F.col("start").alias("begin"), (F.col("start") + F.col("n") + WINDOW - 1).alias("past"))
    return whole.unionByName(sorted_).unionByName(counted)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, kept, n_removed, n_spans) per row of ``docs``; ``kept`` is the rest of the bytes.

    Every byte under a 400-byte string that starts anywhere else too is
    removed, first occurrences included. Null and empty texts, and texts below
    400 bytes, lose nothing; null doc_ids are compared by text; equal rows lose
    what they have in common. Only doc_id and text are read.
    """
    lists = repeated_spans(docs).groupBy(*_KEY).agg(F.collect_list(F.struct("begin", "past")).alias("spans"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")

    def run(batches):
        for batch in batches:
            ids, sizes, rest, removed, spans = [], [], [], [], []
            held = 0
            for i in range(batch.num_rows):
                data = (batch.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
                pairs = batch.column(2)[i].as_py() or ()
                ids.append(batch.column(0)[i].as_py())
                sizes.append(len(data))
                done, parts, n = 0, [], 0
                last = -1
                for a, b in sorted((s["begin"], s["past"]) for s in pairs):
                    if a > last:
                        parts.append(data[max(done, 0) : a])
                        n += 1
                    last = max(last, b)
                    done = last
                parts.append(data[done:])
                rest.append(b"".join(parts))
                removed.append(len(data) - len(rest[-1]))
                spans.append(n)
                held += len(rest[-1])
                if held > 1 << 22 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rest, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                        names=["doc_id", "n_bytes", "kept", "n_removed", "n_spans"],
                    )
                    ids, sizes, rest, removed, spans, held = [], [], [], [], [], 0

    return _same_doc(rows, lists, "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, kept binary, n_removed long, n_spans long"
    )
