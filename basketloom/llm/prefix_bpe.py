"""Byte-level BPE by prefix dynamic programming: encode, decode, append and edit.

For every byte prefix of a piece exactly one token can end a valid encoding of
it: the one that fits and whose pair with the last token of the shorter prefix
survives merging. Storing that token for each prefix gives the encoding by
walking back, appends by going on from the end, and edits by restarting in
front of the change.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of a worker's caches of pieces, words and token pairs; a full cache starts afresh.
CACHE = 1_000_000
#: Longest prefix, in bytes, whose last token a worker remembers.
SHORT = 32
#: Values in a batch that a task returns.
BATCH = 1 << 20


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """token -> rank from a rank file: one base64 token and its rank per line.

    The vocabulary is bounded by the file, which every executor needs whole.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


class PrefixEncoder:
    """The merges of a vocabulary, seen from the last token of each prefix."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.parts = {rank: self._halves(token) for token, rank in ranks.items()}
        self.joined = {pair: rank for rank, pair in self.parts.items() if pair}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.prefixes: dict[bytes, int] = {}
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes | None] = {}

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes.

        Found by merging its bytes until two parts are left.
        """
        parts = [token[i : i + 1] for i in range(len(token))]
        own = self.ranks[token]
        while len(parts) > 2:
            best, at = own, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], own)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) < 2 or any(p not in self.ranks for p in parts):
            return None
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _survives(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged together.

        Undo the merges on both sides of the border, latest first. A merge
        across the border that ranks before all that were undone would have
        come first, so the pair could not have arisen.
        """
        undone = 1 << 62
        a, b = left, right
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < undone:
                return False
            inner_a, inner_b = self.parts.get(a), self.parts.get(b)
            if inner_a is None and inner_b is None:
                return True
            # of equal tokens the right one was merged later: merging goes from left to right
            if inner_b is None or (inner_a is not None and a > b):
                undone, a = a, inner_a[1]
            else:
                undone, b = b + 1, inner_b[0]

    def valid(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            known = self.pairs[left, right] = self._survives(left, right)
        return known

    def last_tokens(self, piece: bytes, known: array | None = None) -> array:
        """The last token of every prefix; ``known`` holds those of the first prefixes."""
        last = array("i", known or ())
        ranks, parts, pairs = self.ranks, self.parts, self.pairs
        longest, memo = self.longest, self.prefixes
        for end in range(len(last) + 1, len(piece) + 1):
            head = piece[:end] if end <= SHORT else None
            rank = memo.get(head)
            if rank is not None:
                last.append(rank)
                continue
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                rank = ranks.get(piece[start:end])
                if rank is None:
                    continue
                if start:
                    before = last[start - 1]
                    fits = pairs.get((before, rank))
                    if fits is None:
                        fits = self.valid(before, rank)
                else:
                    fits = end == 1 or parts[rank] is not None
                if fits:
                    last.append(rank)
                    if head is not None:
                        if len(memo) > CACHE:
                            memo.clear()
                        memo[head] = rank
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of a piece")
        return last

    def walk(self, last: array) -> list[int]:
        """The ids, from the last tokens."""
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        ids.reverse()
        return ids

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one match of the pattern, as little-endian 32-bit integers."""
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) > CACHE:
                self.pieces.clear()
            data = piece.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            ids = [whole] if whole is not None else self.walk(self.last_tokens(data))
            known = self.pieces[piece] = array("i", ids).tobytes()
        return known

    def _word(self, word: str) -> bytes | None:
        """Ids of a blank and a word; None if the word cannot be split off there."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        return b"".join(map(self.piece_ids, self.split(" " + word)))

    def ids(self, text: str) -> bytes:
        """Ids of a text, as little-endian 32-bit integers.

        A blank between two characters that are not white space always starts a
        match, so such texts are cut at blanks and their words looked up.
        """
        first, *rest = text.split(" ")
        words = self.words
        out = []
        for word in rest:
            known = words.get(word, 0)
            if known == 0:
                if len(words) > CACHE:
                    words.clear()
                known = words[word] = self._word(word)
            out.append(known)
        if None in out or (rest and (not first or first[-1].isspace())):
            return b"".join(map(self.piece_ids, self.split(text)))
        return b"".join(map(self.piece_ids, self.split(first))) + b"".join(out)


class EditableText:
    """A text with the last tokens of all its prefixes, for exact appends and edits."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.pieces = [(p, encoder.last_tokens(p.encode())) for p in encoder.split(text)]

    def append(self, more: str) -> EditableText:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> EditableText:
        """Replace text[start:stop]; pieces well in front of the change stay as they are."""
        text = self.text[:start] + new + self.text[stop:]
        at, keep = 0, 0
        ends = []
        for piece, _ in self.pieces:
            at += len(piece)
            ends.append(at)
        while keep < len(ends) and ends[keep] < start:
            keep += 1
        # the piece before the change can grow, and white space before it can be cut otherwise
        keep = max(0, keep - 1)
        while keep and self.pieces[keep - 1][0].isspace():
            keep -= 1
        keep = max(0, keep - 1)
        begin = ends[keep - 1] if keep else 0
        old = self.pieces[keep:]
        self.pieces, self.text = self.pieces[:keep], text
        for i, piece in enumerate(self.encoder.split(text[begin:])):
            data, known = piece.encode(), array("i")
            if i < len(old):
                before = old[i][0].encode()
                same = 0
                while same < min(len(before), len(data)) and before[same] == data[same]:
                    same += 1
                known = old[i][1][:same]
            self.pieces.append((piece, self.encoder.last_tokens(data, known)))
        return self

    def ids(self) -> list[int]:
        out = []
        for piece, last in self.pieces:
            whole = self.encoder.ranks.get(piece.encode())
            out += [whole] if whole is not None else self.encoder.walk(last)
        return out


_encoders: dict[int, PrefixEncoder] = {}


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, each match of ``pattern`` by itself.

    One row per input row, repeated rows and null doc_ids included; a null or
    empty text has no ids. Only doc_id and text are read. No shuffle; a worker
    keeps the words that it has met in bounded caches.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches):
        key = id(shared.value[0])
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = PrefixEncoder(*shared.value)
        encoder = _encoders[key]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start, parts, size = 0, [], 0
            for i in range(batch.num_rows):
                parts.append(encoder.ids(texts[i].as_py() or ""))
                size += len(parts[-1])
                if size > 4 * BATCH or i + 1 == batch.num_rows:
                    yield _lists(ids[start : i + 1], parts)
                    start, parts, size = i + 1, [], 0

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def _lists(ids: pa.Array, parts: list[bytes]) -> pa.RecordBatch:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=ends[1:])
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends), values)], names=["doc_id", "ids"])


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids; none for null or empty ids."""
    width = max(ranks.values(), default=-1) + 1
    tokens = [b""] * width
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        tokens = shared.value
        lengths = np.array([len(t) for t in tokens], np.int64)
        for batch in batches:
            column = batch.column(1)
            done = 0
            while done < batch.num_rows:
                take, size = 0, 0
                while done + take < batch.num_rows and size <= BATCH:
                    size += len(column[done + take]) if column[done + take].is_valid else 0
                    take += 1
                part = column.slice(done, take)
                flat = part.flatten().to_numpy()
                ends = np.zeros(len(flat) + 1, np.int64)
                np.cumsum(lengths[flat], out=ends[1:])
                counts = np.array([len(x) if x.is_valid else 0 for x in part], np.int64)
                stops = np.zeros(take + 1, np.int64)
                np.cumsum(counts, out=stops[1:])
                data = pa.py_buffer(b"".join(map(tokens.__getitem__, flat.tolist())))
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), take, [None, pa.py_buffer(ends[stops].astype(np.int64)), data]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, take), part, decoded], names=["doc_id", "ids", "decoded"])
                done += take

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows, and any other columns asked for."""
    return decoded.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
