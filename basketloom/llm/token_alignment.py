"""Alignment of two tokenizers by coalescing the byte intervals of their tokens.

Both tokenizers cut the same bytes, so their tokens are two tilings of one
range. All tokens of both are sorted by start; where a start reaches the
running maximum of the ends before it, a new group begins. Inside a group every
token of A meets the tokens of B whose ranges overlap its own. The pairs that
end together are the links.

A text is cut at single blanks between characters that are neither white space
nor U+2581. Both tokenizers begin a token there, so the parts are tokenized and
aligned apart; a worker aligns a part that occurs again only once. The
tokenizers' files are checked for that property, and texts with a part that a
tokenizer does not give back are taken whole.

Of two tokens that end together the shorter one's bytes end the longer one's,
so the vocabularies alone bound the number of linked id pairs (``pair_bound``);
their corpus-wide counts are therefore a table that every task may hold.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.hashing import text_rows
from basketloom.sources.stage import discard, settle

#: Characters of text aligned at once, and links held by a task before it counts them.
TOGETHER, HELD = 1 << 20, 1 << 22
#: Aligned parts that a worker remembers, a full memory starts afresh; longer parts are not remembered.
KNOWN, SHORT = 200_000, 64
#: Characters of parts that are tokenized as one.
LUMP = 4096
_BLANK = "▁"
_CUT = re.compile(rf" (?<=[^\s{_BLANK}] )(?=[^\s{_BLANK}])")
_EDGE = re.compile(rf"[\s{_BLANK}]")
# The pre-tokenizer's pattern whose parts never hold a blank behind another character.
_SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _bytes_of_characters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def byte_level_tokens(spec: str) -> list[bytes]:
    """Bytes of every id of a byte-level BPE file; of added special tokens their text."""
    parsed, byte = json.loads(spec), _bytes_of_characters()
    added = {t["id"]: t["content"] for t in parsed.get("added_tokens", [])}
    out = [b""] * (1 + max([*parsed["model"]["vocab"].values(), *added]))
    for piece, i in parsed["model"]["vocab"].items():
        out[i] = piece.encode() if i in added else bytes(map(byte.__getitem__, piece))
    for i, piece in added.items():
        out[i] = piece.encode()
    return out


def piece_tokens(model: bytes) -> list[bytes]:
    """Bytes of every id of a sentencepiece model; U+2581 is a blank, a byte piece its byte."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_proto=model)
    text = [pieces.id_to_piece(i) for i in range(pieces.piece_size())]
    return [bytes([int(t[3:5], 16)]) if pieces.is_byte(i) else t.replace(_BLANK, " ").encode() for i, t in enumerate(text)]


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """No more id pairs than this can end together: the bytes of one must end those of the other."""
    total = 0
    for one, two in ((a, b), (b, a)):
        times: dict[bytes, int] = {}
        for t in two:
            times[t] = times.get(t, 0) + 1
        total += sum(times.get(t[k:], 0) for t in one for k in range(len(t)))
    return total


@dataclass
class Aligned:
    """Alignment of the tokens of consecutive documents; token places count through all of them.

    ``group_a`` and ``group_b`` number the group of every token; ``over_a`` and
    ``over_b`` are the places of all overlapping pairs, by a, then by b;
    ``together`` marks the pairs that end together.
    """

    group_a: np.ndarray
    group_b: np.ndarray
    over_a: np.ndarray
    over_b: np.ndarray
    together: np.ndarray


def align(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Align two tilings of one byte range, given the lengths of their tokens, none of them 0."""
    end_a, end_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    start, end = np.concatenate([end_a - lengths_a, end_b - lengths_b]), np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    reached = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = start[order[1:]] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    # a token of A overlaps the tokens of B from the first that ends behind its start to the last that starts before its end
    first = np.searchsorted(end_b, end_a - lengths_a, "right")
    last = np.searchsorted(end_b - lengths_b, end_a, "left")
    times = last - first
    over_a = np.repeat(np.arange(len(end_a)), times)
    over_b = np.arange(len(over_a)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
    return Aligned(group[: len(end_a)], group[len(end_a) :], over_a, over_b, end_a[over_a] == end_b[over_b])


def _written(a: np.ndarray, b: np.ndarray, found: Aligned, n_a: int) -> np.ndarray:
    """Places in the table of :func:`_printed`, in the order of ``a1,a2|b1;a3|b2,b3;``: by group, A before B."""
    group = np.concatenate([found.group_a, found.group_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(a), len(b)])
    order = np.lexsort((side, group))  # stable, so tokens of a side keep their order
    behind = 2 * group[order] + side[order]
    ends = np.ones(len(order), bool)
    ends[:-1] = behind[1:] != behind[:-1]
    ids = np.concatenate([a, b + n_a])[order]
    return 2 * ids + ends


def _printed(n_a: int, n_b: int) -> list[str]:
    """Every id with the mark behind it: a comma inside a side of a group, else a bar behind A, a semicolon behind B."""
    return [f"{i}{mark}" for i in range(n_a) for mark in ",|"] + [f"{i}{mark}" for i in range(n_b) for mark in ",;"]


class _Aligner:
    """Both tokenizers and what is known of parts of texts: (n_a, n_b, n_groups, n_overlaps, printed groups, links)."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.one, self.two = Tokenizer.from_str(spec), SentencePieceProcessor(model_proto=model)
        self.one.encode_special_tokens = True
        self.bytes_a, self.bytes_b = byte_level_tokens(spec), piece_tokens(model)
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.printed = _printed(len(self.bytes_a), len(self.bytes_b))
        self.code = _code_type(len(self.bytes_a), len(self.bytes_b))
        self.apart = _parts_are_apart(spec, [self.two.id_to_piece(i) for i in range(self.two.piece_size())])
        self.known: dict[str, tuple | None] = {}

    def _aligned(self, parts: list[str], joined: bool = True) -> list[tuple | None]:
        """Of every part, with the blank before it; None where a tokenizer does not give it back.

        Parts that could stand side by side in a text are tokenized as one.
        """
        lumps, room = [], 0
        for k, p in enumerate(parts):
            if not joined or room <= 0 or _EDGE.match(p[0]) or _EDGE.match(p[-1]):
                lumps.append([])
                room = LUMP if joined and not _EDGE.match(p[0]) and not _EDGE.match(p[-1]) else 0
            lumps[-1].append(k)
            room -= len(p) + 1
        texts = [" ".join([parts[k] for k in lump]) for lump in lumps]
        ids_a = [e.ids for e in self.one.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        ids_b = self.two.encode(texts, num_threads=1)
        out: list[tuple | None] = [None] * len(parts)
        same, again = [], []
        for lump, text, a, b in zip(lumps, texts, ids_a, ids_b):
            whole = (" " + text).encode("utf-8", "surrogatepass")
            if b"".join(map(self.bytes_a.__getitem__, a)) == whole and b"".join(map(self.bytes_b.__getitem__, b)) == whole:
                same.append((lump, a, b))
            elif len(lump) > 1:
                again += lump
        if same:
            a, b = (np.concatenate([np.array(x[s], np.int64) for x in same]) for s in (1, 2))
            found = align(self.sizes_a[a], self.sizes_b[b])
            written = _written(a, b, found, len(self.bytes_a)).tolist()
            pair = found.over_a[found.together], found.over_b[found.together]
            links = (a[pair[0]] * len(self.bytes_b) + b[pair[1]]).astype(self.code)
            order = [k for lump, *_ in same for k in lump]
            ends = np.cumsum([1 + len(parts[k].encode("utf-8", "surrogatepass")) for k in order])
            upto = []
            for sizes in (self.sizes_a[a], self.sizes_b[b]):
                reached = np.cumsum(sizes)
                upto.append(np.searchsorted(reached, ends) + 1)
                if not np.array_equal(reached[upto[-1] - 1], ends):
                    raise ValueError("a token reaches over a blank")
            before = np.concatenate([[0], upto[0][:-1]])
            cut = np.append(np.searchsorted(pair[0], before), len(links)).tolist()
            over = np.append(np.searchsorted(found.over_a, before), len(found.over_a)).tolist()
            groups = np.diff(found.group_a[upto[0] - 1] + 1, prepend=0).tolist()
            n_a, n_b = (np.diff(x, prepend=0).tolist() for x in upto)
            print_, at, packed, wide = self.printed.__getitem__, 0, links.tobytes(), links.itemsize
            for j, k in enumerate(order):
                text = "".join(map(print_, written[at : at + n_a[j] + n_b[j]]))
                at += n_a[j] + n_b[j]
                out[k] = n_a[j], n_b[j], groups[j], over[j + 1] - over[j], text, packed[wide * cut[j] : wide * cut[j + 1]]
        for k, x in zip(again, self._aligned([parts[k] for k in again], False) if again else ()):
            out[k] = x
        return out

    def __call__(self, texts: list[str]) -> list[tuple | None]:
        """The same of whole texts, none of them empty."""
        if not self.apart:
            return self._aligned(texts, False)
        cut = [_CUT.split(t) for t in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
        asked = list({p for parts in cut for p in parts if p not in self.known})
        here = dict(zip(asked, self._aligned(asked)))
        self.known.update((p, x) for p, x in here.items() if len(p) <= SHORT)
        out: list[tuple | None] = []
        for parts in cut:
            found = [here[p] if p in here else self.known[p] for p in parts]
            if None in found:
                out.append(None)
                continue
            *counts, printed, links = zip(*found)
            out.append((*map(sum, counts), "".join(printed), b"".join(links)))
        whole = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(whole, self._aligned([texts[k] for k in whole], False) if whole else ()):
            out[k] = x
        return out


def _parts_are_apart(spec: str, pieces: list[str]) -> bool:
    """Whether neither tokenizer can have a token with a blank, or U+2581, behind another character."""
    parsed = json.loads(spec)
    split = parsed.get("pre_tokenizer") or {}
    plain = parsed.get("normalizer") is None and all(split.get(k, v) == v for k, v in _SPLITTER.items()) and split.get("type") == "ByteLevel"
    return plain and not any(re.search(f"[^{_BLANK}]{_BLANK}", p) for p in pieces)


_aligners: dict[str, _Aligner] = {}


def _aligner(spec: str, model: bytes) -> _Aligner:
    """Made once per worker."""
    name = hashlib.sha256(spec.encode() + model).hexdigest()
    if name not in _aligners:
        _aligners.clear()
        _aligners[name] = _Aligner(spec, model)
    return _aligners[name]


def encoded(docs: DataFrame, spec: str, model: bytes) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_overlaps, groups_sha256, links) of every row.

    ``links`` holds the linked id pairs in order, each as the 64-bit or, if the
    vocabularies allow, 32-bit number ``a * vocabulary of B + b``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((spec, model))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256", "links"]
    types = [pa.int64(), *[pa.int64()] * 4, pa.string(), pa.binary()]

    def run(batches):
        aligner = _aligner(*shared.value)

        def pack(held):
            found = iter(aligner([text for _, text in held if text]))
            rows = []
            for doc_id, text in held:
                have = next(found) if text else None
                if have is None:
                    rows.append((doc_id, 0, 0, 0, 0, "", b""))
                else:
                    rows.append((doc_id, *have[:4], hashlib.sha256(have[4][:-1].encode()).hexdigest(), have[5]))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        held, size = [], 0
        for doc_id, text in text_rows(batches):
            held.append((doc_id, text))
            size += len(text or "")
            if size >= TOGETHER or len(held) >= 4096:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    longs = ", ".join(f"{n} long" for n in names[:5])
    return docs.select("doc_id", "text").mapInArrow(run, f"{longs}, groups_sha256 string, links binary")


def _code_type(n_a: int, n_b: int):
    return np.dtype("<u4") if n_a * n_b <= 1 << 32 else np.dtype("<u8")


def pair_counts(rows: DataFrame, code: np.dtype) -> DataFrame:
    """(pair, n): how many links of all documents hold an id pair; summed inside each task first."""

    def run(batches):
        held, size = [], 0

        def packed():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            for links in batch.column(0):
                held.append(np.frombuffer(links.as_buffer(), code))
                size += len(held[-1])
                if size >= HELD:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    return rows.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, spec: str, model: bytes) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    Blank plus text is cut by the byte-level BPE file ``spec`` (A), the text by
    the sentencepiece ``model`` (B), both without special tokens; strings of
    special tokens are plain text. ``n_best`` counts the links whose id pair is,
    over all documents, the most frequent of its B id, ties included;
    ``count_sum`` adds the counts of the links' pairs. ``groups_sha256`` is
    over ``a1,a2|b1;a3|b2,b3``, the ids of each group.

    Needs doc_id and text; other columns are ignored. A text that is null or
    empty, or that a tokenizer does not give back byte by byte, has no tokens:
    zeros and an empty digest. Rows may repeat and doc_id may be null: every
    row counts by itself. No rows give none.
    """
    bytes_a, bytes_b = byte_level_tokens(spec), piece_tokens(model)
    code, n_b, bound = _code_type(len(bytes_a), len(bytes_b)), len(bytes_b), pair_bound(bytes_a, bytes_b)
    rows = settle(encoded(docs, spec, model), "aligned")
    counts = settle(pair_counts(rows, code), "pairs")
    held = counts.limit(bound + 1).toArrow()
    discard(counts)
    if held.num_rows > bound:
        raise ValueError("more linked pairs than the vocabularies allow")
    pair, n = (held[c].to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    most = np.zeros(n_b, np.int64)
    np.maximum.at(most, pair % n_b, n)
    shared = docs.sparkSession.sparkContext.broadcast((pair.astype(code), n, n == most[pair % n_b]))

    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            links = [np.frombuffer(x.as_buffer(), code) for x in batch.column("links")]
            ends = np.cumsum([0, *map(len, links)])
            at = np.searchsorted(pair, np.concatenate(links)) if ends[-1] else np.zeros(0, np.int64)
            sums = [np.concatenate([[0], np.cumsum(x[at])])[ends] for x in (n, best.astype(np.int64))]
            new = {"n_links": np.diff(ends), "n_best": np.diff(sums[1]), "count_sum": np.diff(sums[0])}
            out = {c: batch.column(c) for c in batch.schema.names if c != "links"} | {c: pa.array(v.astype(np.int64)) for c, v in new.items()}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "links")
    out = rows.mapInArrow(run, f"{fields}, n_links long, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256")
