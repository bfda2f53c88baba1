"""SentencePiece coding, phrase collocations and spelling variants against the library and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lunario.llm import collocations, piece_bpe, spelling

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# Column names that the operators use themselves.
SCHEMA = "doc_id bigint, text string, lang string, phrase string, n int, `key` string, word string, bucket int"

rng = random.Random(11)
STEMS = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta-eta", "theta's", "iota", "kappa", "ß", "of", "the"]


def prose(n: int) -> str:
    return " ".join(rng.choices(STEMS, range(len(STEMS), 0, -1), k=n))


def with_typos(n: int) -> str:
    words = []
    for _ in range(n):
        word = rng.choice(["alphabet", "elephant", "telephone", "sandÀcastle", "wxyzw"])
        if rng.random() < 0.4:
            place = rng.randrange(len(word))
            word = word[:place] + rng.choice(["", "a", "e", "é"]) + word[place + rng.randint(0, 1) :]
        words.append(word)
    return "-".join(words)


TEXTS = [None, "", " \t\n", "one", "Fox,fox;FOX the.Fox", prose(400), prose(400), "a  b\tc ,, d", "x" * 3000 + " y",
         with_typos(900), with_typos(900), "the same the same " * 60, "İstanbul ﬀ 数字\x85  ", "▁ ▁▁x <s> </s> <0x0A>"]
ROWS = [(i, t, ("en", "de", None)[i % 3], "p", 1, "k", "w", 2) for i, t in enumerate(TEXTS)]
ROWS += [ROWS[5], ROWS[5], (5, prose(90), "en", None, None, None, None, None), (None, with_typos(99), None, *"x1kw2")]
ROWS = [(*r[:3], "p", 1, "k", "w", 2) for r in ROWS]
#: A word of the long kind with its near words, some of them across the border between the kinds.
RUNS = ["ab" * 30, "ab" * 29 + "b", "ab" * 30 + "a", "xab" + "ab" * 29, "q" * 40, "q" * 41, "q" * 42, "q" * 39, "q" * 39 + "r"]
ROWS += [(70 + i, " ".join(RUNS * (3 + i)), "xx", "p", 1, "k", "w", 2) for i in range(3)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(docs, none, library):
    coder = piece_bpe.load(MODEL)
    hard = ["a" * 9001, " " * 3001, "ab" * 4000, "é" * 777, "=-" * 999, "\x00\x7f", "1234567890" * 99,
            "".join(rng.choices("etaoin", k=5000)), "".join(map(chr, range(0x3000)))]
    hard += ["".join(rng.choices("abe ▁\néß日x.,0", k=rng.randint(1, 40))) for _ in range(2000)]
    for text in hard + [t or "" for t in TEXTS]:
        ids = coder.encode(text)
        assert ids == library.encode(text, add_eos=True)
        assert coder.decode(ids) == library.decode(ids)
        assert coder.encode(text, add_end=False) == ids[:-1]
    got = Counter(map(tuple, piece_bpe.round_trip(docs, MODEL).collect()))
    want = Counter()
    for row in ROWS:
        ids = library.encode(row[1] or "", add_eos=True)
        digests = (" ".join(map(str, ids)), library.decode(ids))
        want[row[0], len(ids), *(hashlib.sha256(d.encode()).hexdigest() for d in digests)] += 1
    assert got == want
    texts = Counter(map(tuple, piece_bpe.decode(piece_bpe.encode(docs, MODEL), MODEL).collect()))
    assert texts == Counter((r[0], library.decode(library.encode(r[1] or ""))) for r in ROWS)
    assert piece_bpe.round_trip(none, MODEL).isEmpty() and piece_bpe.encode(none, MODEL).isEmpty()


def test_any_ids_decode_as_in_the_library(library):
    coder = piece_bpe.load(MODEL)
    pick = (lambda: rng.randrange(32000), lambda: rng.randrange(300), lambda: rng.randrange(3), lambda: 28705)
    for _ in range(5000):
        ids = [rng.choice(pick)() for _ in range(rng.randint(0, 7))]
        assert coder.decode(ids) == library.decode(ids)


def test_backtracking_gives_up_pieces_and_marks_places():
    """A vocabulary in which the longest piece is wrong, and one with spaces inside pieces."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(t, -float(i), 1) for i, t in enumerate(["bc", "cd", "ab", "bcd", "abc", "b▁", "cdb▁", *"abcd▁"])]
    coder = piece_bpe.PieceBPE(pieces)
    for _ in range(3000):
        text = "".join(rng.choices("abcd x", k=rng.randint(1, 14)))
        want = coder.merge("▁" + text.replace(" ", "▁"))
        assert [p for s in coder.segments.findall("▁" + text.replace(" ", "▁")) for p in coder.backtrack(s)] == want
    assert coder.backtrack("abcd") == ["a", "bcd"]


def test_other_models_are_refused():
    for kind in (piece_bpe.USER_DEFINED, piece_bpe.UNUSED):
        with pytest.raises(ValueError):
            piece_bpe.PieceBPE([("<unk>", 0.0, 2), ("a", -1.0, kind)])


def brute_phrases(rows, longest, least, covered, top):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            for i in range(len(words)):
                for size in range(1, min(longest, len(words) - i) + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    found = []
    for lang, f in counts.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        candidates = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        dropped = set()
        for long, v in candidates.items():
            for size in range(2, len(long)):
                for i in range(len(long) - size + 1):
                    if 100 * v >= covered * candidates[long[i : i + size]]:
                        dropped.add(long[i : i + size])
        scored = []
        for k in set(candidates) - dropped:
            cuts = ((10**6 * f[k] ** 2 // (f[k[:i]] * f[k[i:]]), i) for i in range(1, len(k)))
            score, i = min(cuts)
            scored.append((" ".join(k), f[k], f[k[:i]], f[k[i:]], n, score))
        scored.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        found += [(lang, rank, *r) for rank, r in enumerate(scored[:top], 1)]
    return sorted(found)


@pytest.mark.parametrize("small", [False, True])
def test_collocations(docs, none, monkeypatch, small):
    if small:  # chunks and stretches end inside texts, buckets are dealt twice, most pairs are hot
        for name, value in {"CHUNK": 150, "BUCKET": 1500, "STRETCH": 70, "FAN": 3, "SHARES": 9}.items():
            monkeypatch.setattr(collocations, name, value)
        totals, hot = collocations.hot_pairs(docs, 9)
        assert hot and len(hot) <= 18
    for longest, top in ((3, 2000), (2, 7), (4, 50)):
        got = sorted(map(tuple, collocations.collocations(docs, longest, 10, 50, top).collect()))
        assert got == brute_phrases(ROWS, longest, 10, 50, top)
    assert collocations.collocations(none).isEmpty()


def test_collocations_without_frequent_phrases(spark):
    rows = [(1, "a b c", "en"), (2, None, None), (3, " , ", "fr")]
    assert collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string")).isEmpty()


def test_quicksort_counts_equal_parts_and_abandons_rare_ones():
    gen = np.random.default_rng(3)
    rows = gen.integers(1, 7, (3000, 3)).astype(np.int32)
    rows[gen.random(3000) < 0.2, 2] = 0
    counts = gen.integers(1, 5, 3000)
    want = Counter()
    for row, n in zip(rows.tolist(), counts.tolist()):
        for depth in range(1, 4):
            if 0 not in row[:depth]:
                want[tuple(row[:depth])] += n
    for least in (1, 40, 300):
        got = {tuple(rows[p, :d].tolist()): n for p, d, n in collocations.multikey_quicksort(rows, counts, least)}
        assert got == {k: n for k, n in want.items() if n >= least}


def brute_spelling(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        a, b = sorted((a, b), key=len)
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(((-words[v], v) for v in found), default=None)
        if best and -best[0] >= 2 * words[w]:
            form[w] = best[1]

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


@pytest.mark.parametrize("small", [False, True])
def test_spelling_variants(docs, none, monkeypatch, small):
    want = brute_spelling(ROWS)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])
    if small:
        for name, value in {"LONG": 10, "ROOM": 30, "HELD": 5, "LARGE": 100}.items():
            monkeypatch.setattr(spelling, name, value)
    assert sorted(map(tuple, spelling.variants(docs).collect())) == want
    assert spelling.variants(none).isEmpty()


def test_reduced_alphabets_grow_with_the_vocabulary(spark):
    words = spark.createDataFrame([("abcdef", 3), ("ab" * 50, 3)], "word string, n bigint")
    sizes = spelling.alphabet_sizes(words)
    assert len(sizes) == spelling.LONG + 1 and sizes[5] ** 5 >= spelling.ROOM and sizes[40] == 2
    assert all(a >= b for a, b in zip(sizes[1:], sizes[2:]))


def test_planted_deletions_are_traced_to_their_word(spark):
    """Of a word in many documents, the hash makes about 1 in 97 lose a letter; all are led back."""
    rows = [(i, "Crossroads and crossroads") for i in range(4000)]
    got = spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) > 5 and {r["root"] for r in got} == {"crossroads"}
    assert sum(r["n"] for r in got) > 7990
