"""Text operators against brute force on small tables with nulls, blanks, ties and odd columns."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from lunario.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    importance,
    language_model,
    mixing,
    recurrent,
    repeats,
    secret_scan,
    simhash,
    warc,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPACE = re.compile("[\x20\x09-\x0d]")
SCHEMA = "doc_id bigint, text string, source string, lang string, kept string, `_doc` int"

rng = random.Random(5)
SYLLABLES = ["the", "ha", "er", "on", "ti", "Ée", "st", "ou", "ing", "a"]


def prose(n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


PASSAGE, LONG = prose(70), prose(3000)
TEXTS = [
    None, "", " \t\n", "one", prose(40), prose(40), PASSAGE, prose(30) + " " + PASSAGE,
    PASSAGE + " " + prose(9), LONG, LONG + " x", "ab" * 400, prose(300), "a  b", "ab", " a b ",
    "a" * 1500, "token = abcdef123 pass", "İstanbul ﬀ 数字    'll",
]
ROWS = [(i, t, f"s{i % 4}" if i % 7 else None, "en", "k", i) for i, t in enumerate(TEXTS)]
# Repeated rows, an id with two texts, null ids.
ROWS += [ROWS[4], ROWS[4], (5, "other text", "s1", None, None, None), (None, "null id", "s9", None, None, None),
         (None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_bpe_equals_the_library(docs, none):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = byte_bpe.load(RANKS, public_tokenizers.PATTERN)
    hard = ["a" * 9001, " " * 3001, "ab" * 2000, "é" * 777, "=-" * 999, "".join(rng.choices("abcde", k=5000)),
            "<|endoftext|>", "".join(map(chr, range(0x2FFF)))]
    for text in hard + [t or "" for t in TEXTS]:
        ids = coder.encode(text)
        assert ids == own.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
    got = rows_of(byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN))
    want = []
    for i, t, *_ in ROWS:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter(tuple(r.values()) for r in got) == Counter(want)
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert Counter((r["doc_id"], bytes(r["bytes"])) for r in rows_of(decoded)) == Counter(
        (i, (t or "").encode()) for i, t, *_ in ROWS
    )
    assert byte_bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).isEmpty()


def shingles(text: str) -> set:
    words = [w for w in SPACE.split(text) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def resemblance(a: str, b: str) -> float:
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprints(spark, docs, none):
    plain = spark.createDataFrame([(3 * i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in rows_of(fingerprints.compared_with_next(plain, k=256))}
    texts = [t or "" for t in TEXTS]
    for i, text in enumerate(texts):
        after, cut = texts[(i + 1) % len(texts)], len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = got[3 * i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", after)):
            exact = resemblance(text, other)
            small = len(shingles(text) | shingles(other)) <= 256
            assert row[name] == pytest.approx(exact, abs=1e-9 if small else 0.12)
    assert got[15]["fingerprint"] != got[12]["fingerprint"]
    assert fingerprints.compared_with_next(docs).count() == len(ROWS)
    assert fingerprints.compared_with_next(none).isEmpty()


def test_sketches_merge(spark):
    words = [prose(60).split() for _ in range(2)]
    rows = spark.createDataFrame([(1, words[0]), (1, words[1])], "id int, words array<string>")
    parts = rows.select("id", fingerprints.sketch_of(F.col("words"), 16).alias("sketch"))
    merged = fingerprints.merged_parts(parts, "id", k=16).first()["sketch"]
    a, b = (r["sketch"] for r in parts.collect())
    assert merged == sorted(set(a) | set(b))[:16]
    count = parts.select(fingerprints.distinct_shingles(F.col("sketch"), 16).alias("n")).first()["n"]
    assert 20 < count < 200


def simple_simhash(text: str) -> int:
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values: list[int], radius: int) -> list[int]:
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def test_simhash_components(docs, none):
    got = rows_of(simhash.near_duplicates(docs))
    values = [simple_simhash(t or "") for _, t, *_ in ROWS]
    root = classes(values, 4)
    least = {}
    for r, (i, *_) in zip(root, ROWS, strict=True):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if i is not None or r in least else None
    want = Counter((i, v - (v >> 63 << 64), least[r]) for (i, *_), v, r in zip(ROWS, values, root, strict=True))
    assert Counter((r["doc_id"], r["fp"], r["component_id"]) for r in got) == want
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.deduplicated(none).isEmpty()


@pytest.mark.parametrize("shard", [3, 4096])
def test_simhash_links_in_blocks(spark, shard):
    draw = np.random.default_rng(3)
    base = [int(x) for x in draw.integers(0, 2**63, 12)]
    values = sorted({b ^ sum(1 << int(k) for k in draw.integers(0, 63, draw.integers(0, 7))) for b in base for _ in range(9)})
    table = spark.createDataFrame([(v,) for v in values], "fp bigint")
    from lunario.llm.components import components

    found = components(simhash.links(table, 4, shard))
    got = {r["node"]: r["root"] for r in found.collect()}
    root = classes(values, 4)
    assert [got.get(v, v) for v in values] == [min(w for w, s in zip(values, root, strict=True) if s == r) for r in root]


def test_components_of_a_chain(spark):
    from lunario.llm.components import components

    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert [r["root"] for r in components(links).select("root").distinct().collect()] == [0]


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 6000)
    monkeypatch.setattr(warc, "FILE_BYTES", 900)
    pages = [(i, f"http://x/{i}", prose(rng.randint(0, 80))) for i in range(60)]
    pages += [(100, "u\r\nX: 1", None), (101, None, ""), (102, "u", pages[3][2]), (103, "u", LONG),
              (104, "é", LONG), (None, "n", pages[3][2]), pages[5], (7, "twin", "another")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("shard", F.lit(1))
    manifest, root = warc.write(table.repartition(5))
    files = {r["file"]: r["sha256"] for r in manifest.collect()}
    assert len(files) > 5
    again = {r["file"]: r["sha256"] for r in warc.write(table.repartition(2))[0].collect()}
    assert again == files
    first, want = {}, []
    for i, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        data = (html or "").encode()
        seen = data in first
        first.setdefault(data, i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "revisit" if seen else "response", first[data] if seen else None))
    read = warc.read(manifest, root, payloads=True).collect()
    assert Counter(tuple(r)[:5] for r in read) == Counter(want)
    assert {r["html"] for r in read if r["html"] is not None} == {h or "" for _, _, h in pages}
    assert warc.round_trip(table.limit(0)).isEmpty()


def test_exact_dedup(docs, none):
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    got = rows_of(exact_dedup.decisions(docs))
    assert len(got) == len(ROWS)
    for r in got:
        same = next(g for k, g in groups.items() if hashlib.sha256(k.encode()).hexdigest() == r["text_sha256"])
        assert (r["keep_id"], r["group_size"]) == (min(same)[3], len(same))
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.deduplicated(none).isEmpty()


def removed(texts: list[bytes]) -> list[bytes]:
    count = Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        out.append(bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("most", [1, 2048])
def test_repeats(docs, none, monkeypatch, most):
    monkeypatch.setattr(repeats, "CLASSES", most)
    monkeypatch.setattr(repeats, "PIECE", 5000)
    texts = [(t or "").encode() for _, t, *_ in ROWS]
    want = Counter(
        (i, len(b), len(b) - len(k), hashlib.sha256(k).hexdigest())
        for (i, *_), b, k in zip(ROWS, texts, removed(texts), strict=True)
    )
    got = rows_of(repeats.remove_repeats(docs))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    assert all((r["n_spans"] > 0) == (r["n_removed"] > 0) for r in got)
    assert repeats.remove_repeats(none).isEmpty()
    # The groups with all their occurrences cover the same bytes.
    found = repeats.Repeats(docs).occurrences().where("key = 6").select("start", "length").collect()
    assert len({p for r in found for p in range(r["start"], r["start"] + r["length"])}) == len(PASSAGE.encode())


def test_repeats_of_texts_alike_in_21_bits_of_their_hash(spark):
    """Texts without an id whose hashes end alike keep their own spans and bytes."""
    own = [random.Random(n).randbytes(150).hex() for n in range(3)]
    low = lambda text: xxhash.xxh64_intdigest(text.encode(), 42) & ((1 << 21) - 1)
    with_passage = {low(t): t for n in range(8000) if (t := own[0] + str(n) + PASSAGE)}
    pairs = [(with_passage[low(t)], t) for n in range(8000) if low(t := own[1] + PASSAGE[:150] + str(n)) in with_passage]
    assert pairs
    texts = [*pairs[0], own[2] + PASSAGE, pairs[0][1][20:]]
    table = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    want = Counter(hashlib.sha256(k).hexdigest() for k in removed([t.encode() for t in texts]))
    got = rows_of(repeats.remove_repeats(table))
    assert Counter(r["kept_sha256"] for r in got) == want
    assert all(0 <= r["n_removed"] <= r["n_bytes"] for r in got)


def groups_of(texts: list[bytes]) -> Counter:
    """Maximal repeats of 200 bytes or more by growing every string: (length, its members' places)."""
    found = Counter()
    alive = [(i, at) for i, b in enumerate(texts) for at in range(len(b) - 199)]
    length = 200
    while alive:
        same = {}
        for i, at in alive:
            if at + length <= len(texts[i]):
                same.setdefault(texts[i][at : at + length], []).append((i, at))
        same = [m for m in same.values() if len(m) > 1]
        for m in same:
            left = {texts[i][at - 1] if at else (i, "opens") for i, at in m}
            right = {texts[i][at + length] if at + length < len(texts[i]) else (i, at, "ends") for i, at in m}
            if min(len(left), len(right)) > 1:
                found[length, tuple(sorted(m))] += 1
        alive = [p for m in same for p in m]
        length += 1
    return found


@pytest.mark.parametrize("most", [1, 5, 2048])
def test_groups_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "CLASSES", most)
    monkeypatch.setattr(repeats, "PIECE", 700)
    if most < 2048:
        monkeypatch.setattr(repeats, "NODE_BYTES", 2000)
        monkeypatch.setattr(repeats, "BLOCK", 150)
    draw = random.Random(8)
    x, y, edge, long = (draw.randbytes(n).hex() for n in (150, 150, 120, 400))
    texts = [x + edge, x + edge, edge + y, edge + y, "q" + edge, "1" + long, "2" + long[:700], long[300:] + "é" + x,
             "a" * 230, "b" + "a" * 212, "ab" * 110, "lone" * 5, long, long, ""]
    ids = [1, 2, None, 4, None, 6, 6, 8, 9, 10, 11, 12, 13, 13, None]
    rows = list(zip(ids, texts, strict=True))
    found = repeats.Repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).occurrences()
    groups = {}
    for r in found.collect():
        groups.setdefault((r["bucket"], r["repeat"], r["length"]), Counter())[r["hash"], r["start"]] += 1
    got = Counter((k[2], frozenset(m.items())) for k, m in groups.items())
    told = [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]
    told = [h - (1 << 64) if h >> 63 else h for h in told]
    want = Counter()
    for (length, members), n in groups_of([t.encode() for t in texts]).items():
        want[length, frozenset(Counter((told[i], at) for i, at in members).items())] += n
    assert got == want
    assert len({k[:2] for k in groups}) == len(groups)


def test_maximal_repeats():
    texts = [b"xxabcabcyy", b"zabcabcw", b"qabcq"]
    found = repeats.maximal_repeats(texts, [8, 6, 3], least=3)
    groups = {(n, tuple(sorted(members))) for n, members in found}
    assert (6, ((0, 2), (1, 1))) in groups
    assert (3, ((0, 2), (0, 5), (1, 1), (1, 4), (2, 1))) in groups


def test_gradients_and_state():
    model = recurrent.Recurrent(64)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 65, n) for n in (30, 7, 1, 45)]
    target, previous, first, mask, _ = recurrent.lanes(texts, 64, 2)
    h = np.zeros((2, recurrent.HIDDEN))
    grads, total, _ = model.gradients(previous, first, target, mask, h)
    for name in model.p:
        at = tuple(int(draw.integers(0, n)) for n in model.p[name].shape)
        at = (int(previous[2, 0]), at[1]) if name == "inputs" else at
        old, sides = model.p[name][at], []
        for step in (1e-5, -1e-5):
            model.p[name][at] = old + step
            sides.append(model.gradients(previous, first, target, mask, h)[1])
        model.p[name][at] = old
        assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(grads[name][at], abs=1e-3)
    # Windows carry the state: the score is that of whole texts, each on its own.
    alone = [recurrent.score(model, [t])[0] for t in texts]
    assert recurrent.score(model, texts) == pytest.approx(alone, rel=1e-6)
    assert sum(alone) == pytest.approx(total, rel=1e-6)


def test_training_learns_an_order():
    model = recurrent.Recurrent(64)
    texts = [np.append((np.arange(40) + k) % 20 + 1, 0).astype(np.int32) for k in range(200)]
    before = recurrent.score(model, texts).sum()
    trainer = recurrent.Trainer(model)
    for _ in range(40):
        trainer.fit(texts)
    # Twenty equally frequent words: a unigram model stays near log(1/20) a token.
    assert before < -3.5 * 41 * 200
    assert recurrent.score(model, texts).sum() > -2 * 41 * 200


def test_language_model(spark, docs, none):
    lines = [(i, prose(60)) for i in range(300)]
    extra = spark.createDataFrame(lines, "doc_id bigint, text string")
    both = docs.select("doc_id", "text").unionByName(extra.withColumn("doc_id", F.col("doc_id") + 1000))
    rows = [(i, t) for i, t, *_ in ROWS] + [(i + 1000, t) for i, t in lines]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    count = Counter(w for (i, _), ts in zip(rows, tokens, strict=True) if not held(i) for w in ts)
    n, v = sum(count.values()), len(count)
    want = Counter(
        (i, held(i), len(ts), sum(count[w] > 0 for w in ts), n,
         round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ts), 6))
        for (i, _), ts in zip(rows, tokens, strict=True)
    )
    got = rows_of(language_model.scores(both, known=64))
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got) == want
    out = [r for r in got if r["held_out"]]
    # These words follow no order, so the model can only come near the base.
    assert sum(r["score"] for r in out) > 1.02 * sum(r["base_score"] for r in out)
    assert language_model.scores(none, known=64).isEmpty()


def test_quality(spark, none):
    good = [(i, prose(50), "s") for i in range(160)]
    bad = [(i + 1000, " ".join(w.upper() + "!!" for w in prose(50).split()), "s") for i in range(40)]
    odd = [(5000, None, "s"), (5001, "", None), (None, prose(30), "s"), good[0]]
    table = spark.createDataFrame(good + bad + odd, "doc_id bigint, text string, kept string")
    labels = [(i, 1, 0) for i, *_ in good[:100]] + [(i, 0, 0) for i, *_ in bad[:25]]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = importance.resampled(table, labels)
    assert kept.columns == table.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert not [i for i, *_ in bad if i in ids]
    assert sum(i in ids for i, *_ in good) >= 158 and ids[0] == 2 and ids[None] == 1
    assert importance.decisions(table, labels.limit(0)).where("kept").count() == len(good + bad + odd)
    assert importance.resampled(none, labels).isEmpty()


def test_kth_largest(spark):
    rows = spark.range(5000).select((F.col("id") % 700).cast("double").alias("x"))
    values = sorted((r["x"] for r in rows.collect()), reverse=True)
    for k in (1, 17, 2500, 5000):
        assert importance.kth_largest(rows, "x", k) == values[k - 1]


ASSIGN = re.compile(
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
RANDOM = "q7Zp2LmX9vKc4TgR8wYb1NsD5"


def test_secrets(spark, docs, none):
    texts = [
        "PassWord = hunter22 secret=token: abcdefgh", "é数 api_key:'abc.def' AKIA" + "B1" * 8 + " AKIAB",
        "0" * 24 + " " + "abcdef0123" * 3, f"blob {RANDOM} end", "internationalization" * 2,
        "123e4567-e89b-12d3-a456-426614174000", "", None,
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in rows_of(secret_scan.report(table))}
    for i, text in enumerate(texts):
        text = text or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        base = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in secret_scan.KINDS] == [sum(s[3] == k for s in spans) for k in secret_scan.KINDS]
        added = set(got[i]["spans"].split(",")) - set(base.split(","))
        assert bool(added) == (i == 3)
    windows = [a for a in range(len(RANDOM) - 19)
               if -sum(c / 20 * math.log2(c / 20) for c in Counter(RANDOM[a : a + 20]).values()) >= 3.9]
    assert got[3]["spans"] == f"entropy_base64:{5 + windows[0]}:{5 + windows[-1] + 20}"
    assert secret_scan.report(docs).count() == len(ROWS)
    assert secret_scan.report(none).isEmpty()


def test_mixing(spark, docs, none):
    rows = [(i, prose(rng.randint(0, 60)), f"s{min(i % 9, 5)}") for i in range(400)]
    rows += [(400, None, None), (401, prose(20), None), rows[5], rows[5], (402, LONG, "s2"), (403, "", "empty")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("copies", F.lit("x"))
    got = rows_of(mixing.decisions(table))
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").encode().split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, total = set(), sum(size.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(3 * size[s] for s in full)
        want = {s: 3 * size[s] if s in full else rest * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if want[s] > 3 * size[s] + 1e-9}
        if not over:
            break
        full |= over
    by_id = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        source = by_id[r["doc_id"]]
        assert r["source_size"] == size[source] and r["target"] == pytest.approx(want[source])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 3 for s in names)
    mixed = mixing.mixed(table)
    assert mixed.columns == table.columns and mixed.count() == sum(r["copies"] for r in got)
    again = rows_of(mixing.decisions(table.repartition(7)))
    key = lambda r: (r["doc_id"], r["copies"])
    assert Counter(map(key, again)) == Counter(map(key, got))
    assert mixing.decisions(docs).count() == len(ROWS)
    assert mixing.mixed(none).isEmpty()


def test_rows_alike_in_id_and_text_keep_their_other_columns(spark):
    rows = [(None, "", "s1", "en"), (None, "", "s2", "de"), (None, "", "s2", "de"), (None, None, None, "fr"),
            (None, "", "fr", None), (7, "a b c", "s1", "en"), (7, "a b c", "s1", "de")]
    rows += [(7, "a b c", "s2", lang) for lang in ("x", "y", "z", "z", "z")] + [(8, "d " * 40, "s3", "en")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Counter(map(tuple, importance.resampled(table, labels).collect())) == Counter(rows)
    taken = Counter()
    for r in mixing.decisions(table).collect():
        taken[r["source_size"]] += r["taken"]
    mixed = mixing.mixed(table)
    words = Counter()
    for r in mixed.collect():
        assert tuple(r) in rows
        words[r["source"]] += len((r["text"] or "").split())
    size = {"s1": 6, "s2": 15, "s3": 40}
    assert {size[s]: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    for apply in (mixing.mixed, exact_dedup.deduplicated, simhash.deduplicated):
        one, many = (Counter(map(tuple, apply(table.repartition(n)).collect())) for n in (1, 7))
        assert one == many and set(one) <= set(rows)


@pytest.mark.parametrize("copies", [1, 2, 3, 5, 7, 11])
def test_copies_are_dealt_over_alike_rows(spark, copies):
    from lunario.llm.common import carried, text_hash

    rows = [(1, "t", lang) for lang in ("x", "y", "z", "z", "z")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    chosen = table.limit(1).select(
        "doc_id", text_hash().alias("text_hash"), F.lit(copies).alias("copies"), F.lit(5).alias("rows")
    )
    got = Counter(r["lang"] for r in carried(table, chosen).collect())
    each, rest = divmod(copies, 5)
    assert sum(got.values()) == copies
    assert all(n * each <= got[k] <= n * each + min(n, rest) for k, n in {"x": 1, "y": 1, "z": 3}.items())


def test_pipeline(spark):
    import corpus_pipeline as c
    from lunario.llm.common import staged, table

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns = docs.columns
    before = docs.count()
    for name, stage in c.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf), "test")
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after and (name == "source_mixing" or after <= before)
        before = after
    last = c.STAGES[-1][1](spark, docs, sf)
    texts = Counter(hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.collect())
    assert Counter(r["decoded_sha256"] for r in last.collect()) == texts
