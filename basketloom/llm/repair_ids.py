"""Token ids in binary files, compressed per shard by Re-Pair grammars.

File format: Parquet, one row per shard of consecutive documents in ascending
doc_id order (nulls first). Columns:

- ``part``, ``seq``: the place of the shard; shards in this order hold all documents;
- ``n_docs``, ``n_ids``; ``ids_before``: ids of the shards before it in its part;
- ``doc_ids``: 64-bit little-endian; ``null_docs``: positions of null doc_ids;
- ``doc_symbols``: 32-bit, the end of each document in ``symbols``;
- ``rules``: two symbols per nonterminal, the first nonterminal being ``terminals``;
- ``lengths``: 32-bit, ids in the expansion of each nonterminal;
- ``symbols``: the shard's ids after replacing; ``width``: bytes of a symbol, 2 or 4.

A nonterminal never reaches over the end of a document, so a document, or any
range of its ids, is decoded from its own symbols and their lengths alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ids per shard; only a longer document makes a longer shard.
SHARD_IDS = 1 << 21
#: New rules per round of pair replacement, the least count of a replaced pair, and bits of a counting cell.
PER_ROUND, LEAST, CELL_BITS = 1 << 11, 16, 20
#: Words that a worker remembers; a full cache starts afresh.
CACHE = 1_000_000
#: Documents encoded together.
TOGETHER = 256

_SCHEMA = (
    "part int, seq int, n_docs long, n_ids long, ids_before long, terminals long, width int, doc_ids binary, null_docs binary,"
    " doc_symbols binary, rules binary, lengths binary, symbols binary"
)


def _code(symbols: np.ndarray, narrow: bool) -> np.ndarray:
    """Adjacent pairs as one integer each: of 32 bits if symbols have 16."""
    if narrow:
        return (symbols[:-1] << np.uint32(16)) | symbols[1:]
    return (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]


def _cells(code: np.ndarray, bits: int) -> np.ndarray:
    odd = code.dtype.type(0x9E3779B97F4A7C15 >> (64 - 8 * code.itemsize) | 1)
    return ((code * odd) >> code.dtype.type(8 * code.itemsize - bits)).astype(np.int32)


def _frequent(code: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pairs, at most PER_ROUND, sorted, and the places that may hold one; none only if no pair is frequent.

    Cells of a hash are counted first. If the largest cells hold no frequent
    pair, only sums of rare ones, all cells that could are looked at.
    """
    cell = _cells(code, CELL_BITS)
    sizes = np.bincount(cell[inside], minlength=1 << CELL_BITS)
    high = int(np.partition(sizes, -PER_ROUND)[-PER_ROUND])
    for floor in [max(LEAST, high), LEAST][: 1 + (high > LEAST)]:
        at = np.flatnonzero((sizes >= floor)[cell] & inside)
        found, times = np.unique(code[at], return_counts=True)
        chosen = found[np.argsort(-times, kind="stable")[:PER_ROUND]][: int((times >= LEAST).sum())]
        if len(chosen):
            break
    return np.sort(chosen), at


def compress(ids: np.ndarray, ends: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, document ends in symbols, rules (k, 2) and expansion lengths.

    Each round counts the adjacent pairs of the shard and replaces the most
    frequent ones from left to right by new nonterminals, until no pair inside
    a document occurs LEAST times.
    """
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[ends[ends > 0] - 1] = True
    empty = np.flatnonzero(np.diff(ends, prepend=0) == 0)
    rules, lengths = [], []
    while len(symbols) > 1:
        # pairs of 32 bits as long as all symbols fit into 16
        narrow = terminals + len(lengths) <= 1 << 16
        shift = 16 if narrow else 32
        code = _code(symbols, narrow)
        chosen, at = _frequent(code, ~last[:-1])
        if not len(chosen):
            break
        place = np.minimum(np.searchsorted(chosen, code[at]), len(chosen) - 1)
        hit = chosen[place] == code[at]
        at, place = at[hit], place[hit]
        # of overlapping matches the first, the third and so on of an unbroken run
        new_run = np.diff(at, prepend=-2) != 1
        begin = at[new_run][np.cumsum(new_run) - 1]
        odd = (at - begin) % 2 == 0
        at, place = at[odd], place[odd]
        base = terminals + len(lengths)
        for a, b in ((c >> shift, c & ((1 << shift) - 1)) for c in chosen.tolist()):
            rules.append((a, b))
            lengths.append(sum(1 if x < terminals else lengths[x - terminals] for x in (a, b)))
        symbols[at] = base + place
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
    full = np.flatnonzero(last) + 1
    out = np.zeros(len(ends), np.int64)
    out[np.setdiff1d(np.arange(len(ends)), empty, assume_unique=True)] = full
    np.maximum.accumulate(out, out=out)
    return symbols, out, np.array(rules, np.uint32).reshape(-1, 2), np.array(lengths, np.uint32)


class Shard:
    """A shard row, open for random access."""

    def __init__(self, row: dict):
        kind = "<u2" if row["width"] == 2 else "<u4"
        self.terminals = row["terminals"]
        self.symbols = np.frombuffer(row["symbols"], kind)
        self.ends = np.frombuffer(row["doc_symbols"], "<u4").astype(np.int64)
        rules = np.frombuffer(row["rules"], kind).reshape(-1, 2)
        self.lengths = np.concatenate([np.ones(self.terminals, np.int64), np.frombuffer(row["lengths"], "<u4").astype(np.int64)])
        self.doc_ids: list = np.frombuffer(row["doc_ids"], "<i8").tolist()
        for i in np.frombuffer(row["null_docs"], "<u4").tolist():
            self.doc_ids[i] = None
        # all expansions in one array; rules only use earlier symbols
        self.offset = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        flat = np.empty(int(self.lengths.sum()), np.uint32)
        flat[: self.terminals] = np.arange(self.terminals)
        for k, pair in enumerate(rules.tolist(), self.terminals):
            to = self.offset[k]
            for x in pair:
                size = self.lengths[x]
                flat[to : to + size] = flat[self.offset[x] : self.offset[x] + size]
                to += size
        self.flat = flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.lengths[symbols]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        return self.flat[np.repeat(self.offset[symbols] - (stops - sizes), sizes) + np.arange(total)]

    def doc(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of document i; only the symbols that hold them are expanded."""
        own = self.symbols[self.ends[i - 1] if i else 0 : self.ends[i]]
        stops = np.cumsum(self.lengths[own])
        total = int(stops[-1]) if len(stops) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, past = np.searchsorted(stops, start, "right"), np.searchsorted(stops, stop, "left") + 1
        skip = int(stops[first - 1]) if first else 0
        return self.expand(own[first:past])[start - skip : stop - skip]

    def docs(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of all documents."""
        ids = self.expand(self.symbols)
        ends = np.concatenate([[0], np.cumsum(self.lengths[self.symbols])])[np.concatenate([[0], self.ends])]
        for i, doc_id in enumerate(self.doc_ids):
            yield doc_id, ids[ends[i] : ends[i + 1]]


class _Encoder:
    """Ids by the tokenizers library, asked once for each word that is not in the cache."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.terminals = self.tokenizer.get_vocab_size()
        # in a byte-level vocabulary every character of a token stands for one byte
        self.sizes = np.zeros(self.terminals, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)
        self.words: dict[str, bytes | None] = {}

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Ask for many words in one text; a token's bytes tell where a word ends."""
        fit = [w for w in new if w and not w[0].isspace() and not w[-1].isspace()]
        self.words.update(dict.fromkeys(new))
        for at in range(0, len(fit), 4096):
            some = fit[at : at + 4096]
            ids = np.frombuffer(self._ask([" " + " ".join(some)])[0], "<u4")
            stops = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w.encode()) + 1 for w in some])) + 1
            begin = 0
            for word, stop in zip(some, stops.tolist()):
                self.words[word] = ids[begin:stop].tobytes()
                begin = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """A blank between two characters that are no white space starts a match
        of the tokenizer's pattern, so texts are cut there; others go whole."""
        cut = [text.split(" ") for text in texts]
        if len(self.words) > CACHE:
            self.words.clear()
        known = self.words.get
        parts = [list(map(known, c[1:], repeat(0))) for c in cut]
        again = [i for i, p in enumerate(parts) if 0 in p]
        if again:
            self._learn(list({w for i in again for w, x in zip(cut[i][1:], parts[i]) if x == 0}))
            for i in again:
                parts[i] = list(map(known, cut[i][1:]))
        whole = [i for i, (c, p) in enumerate(zip(cut, parts)) if p and (None in p or not c[0] or c[0][-1].isspace())]
        heads = self._ask([c[0] for c in cut])
        out = [h + b"".join(x for x in p if x) for h, p in zip(heads, parts)]
        for i, ids in zip(whole, self._ask([texts[i] for i in whole])):
            out[i] = ids
        return out


_encoders: dict[int, _Encoder] = {}


def write_ids(docs: DataFrame, path: str, spec: str, end_id: int = 0) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write shards to ``path``.

    ``spec`` is the tokenizer's JSON text. Documents are dealt out by ranges of
    doc_id and sorted in each; rows that share a doc_id follow by text. Only
    doc_id and text are read. A task holds one shard at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = id(shared.value)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = _Encoder(shared.value)
        encoder = _encoders[key]
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, size = [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def shard():
            nonlocal seq, before, size
            ids = np.frombuffer(b"".join(parts), "<u4")
            ends = np.cumsum([len(p) // 4 for p in parts])
            symbols, doc_symbols, rules, lengths = compress(ids, ends, encoder.terminals)
            width = 2 if encoder.terminals + len(rules) <= 1 << 16 else 4
            row = {
                "part": part, "seq": seq, "n_docs": len(doc_ids), "n_ids": len(ids), "ids_before": before,
                "terminals": encoder.terminals, "width": width,
                "doc_ids": np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                "null_docs": np.array([i for i, d in enumerate(doc_ids) if d is None], "<u4").tobytes(),
                "doc_symbols": doc_symbols.astype("<u4").tobytes(),
                "rules": rules.astype(f"<u{width}").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
                "symbols": symbols.astype(f"<u{width}").tobytes(),
            }
            seq, before, size = seq + 1, before + len(ids), 0
            doc_ids.clear()
            parts.clear()
            types = (pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), *[pa.binary()] * 6)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, TOGETHER):
                some = [x or "" for x in texts[at : at + TOGETHER].to_pylist()]
                for doc_id, found in zip(ids[at : at + TOGETHER].to_pylist(), encoder.encode(some)):
                    if doc_ids and size + len(found) // 4 >= SHARD_IDS:
                        yield shard()
                    doc_ids.append(doc_id)
                    parts.append(found + end)
                    size += len(found) // 4 + 1
        if doc_ids:
            yield shard()

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    ordered.mapInArrow(run, _SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it. An empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows, parts, before = [], [], 0

                def flush():
                    sizes = [len(p) for p in parts]
                    ends = np.zeros(len(parts) + 1, np.int32)
                    np.cumsum(sizes, out=ends[1:])
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).astype(np.int32)))
                    part = pa.array([row["part"]] * len(rows), pa.int32())
                    out = pa.RecordBatch.from_arrays(
                        [part, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), ids],
                        names=["part", "doc_id", "before", "ids"],
                    )
                    rows.clear()
                    parts.clear()
                    return out

                size = 0
                for doc_id, ids in Shard(row).docs():
                    rows.append((doc_id, row["ids_before"] + before))
                    parts.append(ids)
                    before += len(ids)
                    size += len(ids)
                    if size > 1 << 20:
                        yield flush()
                        size = 0
                if rows:
                    yield flush()

    files = spark.read.schema(_SCHEMA).parquet(path)
    # one row per part of the range partitioning
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("first"))
    docs = files.mapInArrow(run, "part int, doc_id long, before long, ids array<int>")
    return docs.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


def checksums(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): crc32 of the ids as little-endian 32-bit integers."""

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            flat, ends = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            sums = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return read.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
