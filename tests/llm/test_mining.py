"""Collocations, token alignment and source mixing against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketloom.llm import collocations, source_mix, token_alignment

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, key int, size string, slot int, target string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int, vocabulary: int = 40) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    return " ".join(words[min(int(r.expovariate(0.15)), vocabulary - 1)] + r.choice(["", "", "", ".", ",\t", " "]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Null and blank texts, null ids, languages and sources, copies, repeated rows, a long text, special characters."""
    out = [(k, prose(k % 7, 300), ["en", "fr", None, "und", ""][k % 5], ["a", "b", None, "é", ""][k % 5]) for k in range(40)]
    out += [(100, None, "en", "a"), (101, "", "en", "b"), (102, " \t\n ", "fr", "blank"), (None, prose(1, 50), "en", None), (None, None, None, None)]
    out += [(103, "Big big BIG. big big big big", "en", "a")] * 30 + [(104, prose(9, 60_000, 200), "xx", "c")]
    out += [(105, "  two  blanks<|endoftext|> <s> <0x41> ▁ \U0001f600 é ﬁ \x00 ", "en", "d"), (106, "a" * 5000, "zz", "z")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 0, "w", 1, "s", 2, "t", 3) for i, t, lang, source in rows], SCHEMA).repartition(5)


def mined(rows, least, top):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + k] for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= often[p[i : i + k]]}
        best = []
        for p, a in often.items():
            if p not in inside:
                score, cut = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]], cut))
        out |= {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s, c) for i, (s, a, p, x, y, c) in enumerate(sorted(best)[:top])}
    return out


@pytest.mark.parametrize("least, top, words", [(100, 2000, 1 << 17), (5, 25, 64), (2, 100, 1000)])
def test_collocations(docs, rows, least, top, words, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST", least)
    monkeypatch.setattr(collocations, "ROW_WORDS", words)
    got = [tuple(r) for r in collocations.collocations(docs, top).collect()]
    want = mined(rows, least, top)
    assert len(got) == len(want) and set(got) == want and len({r[0] for r in want}) >= (2 if least == 100 else 4)


def test_scores_beyond_64_bits(spark):
    big = [(9 * 10**16 + 7, 10**17 + 1, 7 * 10**15, 10**17), (3 * 10**16 + 1, 10**18 + 3, 10**18 + 3, 3 * 10**16 + 1), (10**12, 10**13, 10**12, 10**12)]
    rows = spark.createDataFrame(big, "a long, n long, l long, r long").select(collocations._score("l", "r").alias("score")).collect()
    assert [r["score"] for r in rows] == [1000 * a * n // (x * y) for a, n, x, y in big]


def test_no_bound_hides_a_phrase():
    r = random.Random(5)
    words = [r.choice("aabbcd") for _ in range(400)]
    f = Counter(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    for p, a in f.items():
        if len(p) > 1:
            score = min(1000 * a * 400 // (f[p[:k]] * f[p[k:]]) for k in range(1, len(p)))
            assert score <= 1000 * 400 // f[p[:1]] and score <= 1000 * a * 400 // (f[p[:-1]] * f[p[-1:]])


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def aligned(rows, spec, model):
    """Per row n_a, n_b, n_groups, links and digest, token by token."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_str(spec), SentencePieceProcessor(model_proto=model)
    one.encode_special_tokens = True
    bytes_a, bytes_b = token_alignment.byte_level_tokens(spec), token_alignment.piece_tokens(model)
    out = []
    for _, text, *_ in rows:
        sides, whole = [], b" " + (text or "").encode()
        if text:
            for ids, spelled in ((one.encode(" " + text, add_special_tokens=False).ids, bytes_a), (two.encode(text), bytes_b)):
                at, ends = 0, []
                for i in ids:
                    at += len(spelled[i])
                    ends.append((at, i))
                sides.append(ends if b"".join(spelled[i] for i in ids) == whole else None)
        if not text or None in sides:
            out.append((0, 0, 0, [], ""))
            continue
        a, b = map(dict, sides)
        cuts = sorted(a.keys() & b.keys())
        within = lambda s, low, high: ",".join(str(i) for at, i in s if low < at <= high)
        named = ";".join(within(sides[0], x, y) + "|" + within(sides[1], x, y) for x, y in zip([0, *cuts], cuts))
        out.append((len(a), len(b), len(cuts), [(a[at], b[at]) for at in cuts], hashlib.sha256(named.encode()).hexdigest()))
    return out


def test_alignment(docs, rows, files):
    short = [r for r in rows if len(r[1] or "") < 50_000]
    want = aligned(short, *files)
    counts = Counter(link for *_, links, _ in want for link in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    expected = Counter(
        (row[0], n_a, n_b, groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for row, (n_a, n_b, groups, links, digest) in zip(short, want)
    )
    got = token_alignment.alignment(docs.filter("text is null or length(text) < 50000"), *files).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(tuple(r[c] for c in names) for r in got) == expected
    assert sum(n for k, n in expected.items() if k[1]) > 50 and all(r["n_overlaps"] >= max(r["n_a"], r["n_b"]) for r in got)


def test_parts_are_joined_and_remembered(rows, files, monkeypatch):
    texts = [t for _, t, *_ in rows if t and len(t) < 5000] + ["a \u2581b \u2581 c", "\u2581 x", " y", "z ", "a\n b  c d\u00a0 e \u2003 f", "\x1c g \x85 h", "x\u2581 y"]
    plain = token_alignment._Aligner(*files)
    plain.apart = False
    want = plain(texts)
    for lump, known in ((4096, 200_000), (1, 10), (30, 0)):
        monkeypatch.setattr(token_alignment, "LUMP", lump)
        monkeypatch.setattr(token_alignment, "KNOWN", known)
        parts = token_alignment._Aligner(*files)
        assert parts.apart and parts(texts) == want and [parts([t])[0] for t in texts] == want


def test_a_long_text_is_aligned(docs, files):
    row = token_alignment.alignment(docs.filter("doc_id = 104"), *files).first()
    assert row["n_groups"] == row["n_links"] > 50_000


def test_intervals_coalesce():
    found = token_alignment.align(np.array([1, 3, 2, 4]), np.array([2, 2, 2, 1, 3]))
    assert found.group_a.tolist() == [0, 0, 1, 2] and found.group_b.tolist() == [0, 0, 1, 2, 2]
    pairs = list(zip(found.over_a.tolist(), found.over_b.tolist()))
    assert pairs == [(0, 0), (1, 0), (1, 1), (2, 2), (3, 3), (3, 4)] and found.together.tolist() == [False, False, True, True, False, True]


def test_linked_pairs_are_bounded():
    a, b = [b"a", b"ba", b"cba", b"d"], [b"a", b"a", b"dcba", b"x"]
    ends = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x.endswith(y) or y.endswith(x)}
    assert len(ends) <= token_alignment.pair_bound(a, b)


def shares(rows):
    size = Counter()
    for _, text, _, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, target = Fraction(3 * sum(size.values()), 2), dict(weight), {}
    while free:
        level = left / sum(free.values())
        above = [s for s in free if free[s] * level > 2 * size[s]]
        for s in above:
            target[s] = Fraction(2 * size[s])
            left -= target[s]
            del free[s]
        if not above:
            target |= {s: w * level for s, w in free.items()}
            break
    return size, target


@pytest.mark.parametrize("block, together", [(2048, 50_000), (7, 4)])
def test_mix(docs, rows, block, together, monkeypatch):
    monkeypatch.setattr(source_mix, "TOGETHER", together)
    size, target = shares(rows)
    got = source_mix.mix(docs, block=block).collect()
    again = source_mix.mix(docs.repartition(3, "text"), block=block).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(float(target[r["source"]]))
        taken[r["source"]] += r["taken"]
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= Fraction(1, 2), source
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, *_ in rows)


def test_every_stretch_of_the_schedule_holds_the_sources_in_their_shares(docs, rows):
    _, target = shares(rows)
    sources = source_mix.targets(source_mix.sizes(docs))
    plan = sorted(source_mix.slots(sources, 16).collect())
    assert [r["slot"] for r in plan] == list(range(len(plan)))
    ranks, names = defaultdict(list), {r["sid"]: r["source"] for r in sources.collect()}
    for r in plan:
        ranks[r["sid"]].append(r["rank"])
    assert all(x == list(range(len(x))) for x in ranks.values())
    for part in (len(plan) // 5, len(plan) // 2, 3 * len(plan) // 4):
        seen = Counter(names[r["sid"]] for r in plan[:part])
        for source, goal in target.items():
            assert abs(seen[source] - part * goal / sum(target.values())) <= len(plan).bit_length() + 1


def test_words_of_the_mix_follow_the_streams(docs):
    rows = source_mix.sizes(docs)
    parts, placed = source_mix.mixture(rows, source_mix.targets(rows), 16)
    whole = {(r["sid"], r["start"]): r["size"] for r in placed.collect()}
    for r in parts.collect():
        assert r["words"] > 0 and r["first_word"] + r["words"] <= whole[r["sid"], r["start"]] and r["at"] + r["words"] <= 16


def test_no_rows(docs, files):
    none = docs.limit(0)
    assert collocations.collocations(none).count() == 0 and token_alignment.alignment(none, *files).count() == 0 and source_mix.mix(none).count() == 0
    blank = docs.filter("doc_id in (100, 101)")
    assert collocations.collocations(blank).count() == 0 and token_alignment.alignment(blank, *files).agg(F.sum("n_a")).first()[0] == 0
    assert [r["target"] for r in source_mix.mix(blank).collect()] == [0.0, 0.0]
