"""Every stage of the pipeline, and the classifier and the mix alone, recomputed by brute force."""

import base64
import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lunario.llm import importance, mixing
from lunario.llm.common import text_hash

rng = random.Random(31)
STEMS = "plain words that good prose is made of and some more besides them here".split()
JUNK = "$$$ BUY!!! click >>> 0000 win-win FREE### xxx %%%".split()
SPACES = " \t\n\x0b\f\r"


def prose(n, words=STEMS):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ly"]) for _ in range(n))


def corpus():
    """(doc_id, text, lang, source, n_chars, kept, copies): odd rows, copies, near copies, clashing names."""
    rows = [(i, prose(rng.randint(1, 90)), "en", f"s{i % 4}" if i % 9 else None) for i in range(130)]
    rows += [(200 + i, prose(60, JUNK), "en", "s1") for i in range(40)]
    rows += [(300 + i, rows[i][1] + " " * i, "de", "s2") for i in range(12)]
    long = prose(9000)
    for i in range(8):
        words = long.split()
        words[1100 * i] = "changed"
        rows.append((400 + i, " ".join(words), "en", "s3"))
    # Alike but for case: other texts with the same fingerprint.
    rows += [(450 + i, rows[i][1].upper(), "en", "s0") for i in range(20, 30)]
    rows += [(500, None, None, None), (501, "", "", ""), (502, " \t", "en", "s0"), (None, prose(25), "en", "s0"),
             (None, None, "fr", "s1"), rows[3], rows[3], (3, prose(20), "en", "s2"), (503, "one", None, "s5")]
    return [(*r, len(r[1] or ""), "k", 7) for r in rows]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, copies int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(5).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 110)] + [(200 + i, 0, i % 2) for i in range(30)]
    labels += [(None, 1, 0), (500, None, 0), (90, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def words_of(text):
    return [w for w in "".join(" " if c in SPACES else c for c in text or "").split(" ") if w]


def rounded(x):
    return math.floor(abs(x) + 0.5) * (1 if x >= 0 else -1)


def brute_quality(docs, labels):
    """[(doc_id, text hash, log weight, key, kept)] from counts, ratio, cut and k-th key."""
    seed = F.lit(importance.SEED)
    marks = labels.select("*", (F.pmod(F.xxhash64("doc_id", seed), F.lit(2)) == 0).alias("fitted")).collect()
    good = {r["doc_id"] for r in marks if r["quality"] == 1 and r["toxic"] == 0 and r["doc_id"] is not None and r["fitted"]}
    rows = docs.select(
        "doc_id", "text", text_hash().alias("th"), F.xxhash64("doc_id", text_hash(), seed).alias("noise")
    ).collect()
    size = importance.BUCKETS
    raw, target = np.ones(size), np.ones(size)

    def grams(text):
        hashes = [zlib.crc32(w.encode()) for w in words_of(text)]
        pairs = [(a * 31 + b) % 2**64 for a, b in zip(hashes, hashes[1:])]
        return [h % size for h in hashes + pairs]

    for r in rows:
        for g in grams(r["text"]):
            raw[g] += 1
            target[g] += r["doc_id"] in good
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    if target.sum() == size:
        ratio[:] = 0
    found = []
    for r in rows:
        g = grams(r["text"])
        weight = importance.LENGTH * sum(ratio[b] for b in g) / (len(g) + importance.NEUTRAL)
        uniform = r["noise"] / 2.0**64 + 0.5
        found.append([r["doc_id"], r["th"], weight, weight - math.log(-math.log(uniform))])
    quality = defaultdict(list)
    for r in marks:
        if not r["fitted"] and r["quality"] is not None:
            quality[r["doc_id"]].append(r["quality"])
    judged = [(rounded(math.asinh(w) * 40), q) for i, _, w, _ in found if i is not None for q in quality.get(i, [])]
    bins = sorted({b for b, _ in judged})
    n_good, n_bad = sum(q for _, q in judged), sum(1 - q for _, q in judged)
    cut = -math.inf
    if n_good and n_bad:
        gain = [sum(q == 0 and x < b for x, q in judged) / n_bad + sum(q == 1 and x >= b for x, q in judged) / n_good for b in bins]
        cut = math.sinh((bins[int(np.argmax(gain))] - 0.5) / 40)
    k = sum(w >= cut for _, _, w, _ in found)
    least = sorted((key for *_, key in found), reverse=True)[k - 1] if 0 < k < len(found) else -math.inf
    return [(*f, f[3] >= least) for f in found]


def test_the_classifier_equals_brute_force(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    want = brute_quality(docs, labels)
    got = importance.decisions(docs, labels).collect()
    assert len(got) == len(want) == docs.count()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    rows = sorted(((r["doc_id"], r["text_hash"], r["log_weight"], r["gumbel_key"], r["kept"]) for r in got), key=order)
    for a, b in zip(rows, sorted(want, key=order), strict=True):
        assert (a[0], a[1], a[4]) == (b[0], b[1], b[4])
        assert a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9) and a[3] == pytest.approx(b[3], rel=1e-9, abs=1e-9)
    kept = {r[0] for r in rows if r[4]}
    # Most of the junk goes, by a cut that fifteen labelled ones place; clean prose stays.
    assert len(kept & set(range(200, 240))) <= 10 and len(kept & set(range(130))) > 110


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups["".join(c for c in r["text"] or "" if c not in SPACES)].append(r)
    rank = lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0)
    return [min(g, key=rank) for g in groups.values()]


def brute_near(rows, shingle=4, radius=4):
    def print_of(text):
        words = words_of("".join(c.lower() if c.isascii() else c for c in text or ""))
        if not words:
            return 0
        parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [print_of(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    return [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]


def brute_mix(rows, tail):
    """Copies per (source, size): exact rates by bisection, rounded by the two rules."""
    size = lambda r: len(words_of(r["text"]))
    sources = sorted({r["source"] for r in rows if r["source"] is not None}) + [None] * any(r["source"] is None for r in rows)
    total = {s: sum(size(r) for r in rows if r["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    full = set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in full)
        open_ = [s for s in sources if s not in full]
        want = {s: 3 * total[s] if s in full else rest * weight[s] / sum(weight[o] for o in open_) for s in sources}
        over = {s for s in open_ if want[s] > 3 * total[s] + 1e-9}
        if not over:
            break
        full |= over
    copies = {}
    for s in sources:
        docs = Counter(size(r) for r in rows if r["source"] == s)
        mean = max(total[s] / sum(docs.values()), 1e-9)
        low, high = -60 * mean, 2 * mean
        rate = lambda t, n: min(3.0, math.exp(min(t * n / mean, 50)))  # noqa: B023, E731
        for _ in range(200):
            middle = (low + high) / 2
            taken = sum(d * n * rate(middle, n) for n, d in docs.items())
            low, high = (middle, high) if taken < want[s] else (low, middle)
        capped = want[s] >= 3 * total[s] * (1 - 1e-12)
        expected = {n: d * (3.0 if capped else rate(low, n)) for n, d in docs.items()}
        small = sorted(docs)[:tail]
        run, owed = 0.0, 0.0
        for n in sorted(set(docs) - set(small), reverse=True):
            copies[s, n] = math.floor(expected[n] + 1e-9)
            before, run = run, run + expected[n] - copies[s, n]
            copies[s, n] += math.floor(run + 1e-9) - math.floor(before + 1e-9)
            owed += n * (expected[n] - copies[s, n])
        for n in reversed(small):
            wish = rounded(expected[n] + owed / max(n, 1))
            copies[s, n] = docs[n] if n == 0 else max(0, min(3 * docs[n], wish))
            owed += n * (expected[n] - copies[s, n])
    return want, copies


@pytest.mark.parametrize("tail", [1024, 5])
def test_every_stage_equals_brute_force(spark, folder, monkeypatch, tail):
    monkeypatch.setattr(mixing, "TAIL", tail)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    as_rows = lambda df: Counter(map(tuple, df.collect()))
    same = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)

    kept = stages["quality_classifier"](spark, docs, folder).cache()
    hashed = Counter((i, th) for i, th, _, _, keep in brute_quality(docs, labels) if keep)
    assert Counter(map(tuple, kept.select("doc_id", text_hash()).collect())) == hashed
    assert kept.columns == columns and not as_rows(kept) - as_rows(docs)

    once = stages["exact_dedup"](spark, kept, folder).cache()
    assert same(once.collect()) == same(brute_exact(kept.collect())) and once.count() < kept.count()
    assert once.columns == columns and not as_rows(once) - as_rows(kept)

    apart = stages["simhash_near_dedup"](spark, once, folder).cache()
    assert same(apart.collect()) == same(brute_near(once.collect())) and apart.count() < once.count()
    assert apart.columns == columns and not as_rows(apart) - as_rows(once)

    mixed = stages["source_mixing"](spark, apart, folder).cache()
    want, copies = brute_mix(apart.collect(), tail)
    found = Counter((r["source"], len(words_of(r["text"]))) for r in mixed.collect())
    assert found == Counter({k: n for k, n in copies.items() if n})
    assert mixed.columns == columns and set(as_rows(mixed)) <= set(as_rows(apart))
    assert max(as_rows(mixed).values()) <= 3 * max(as_rows(apart).values())

    last = stages["byte_bpe"](spark, mixed, folder).collect()
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for r in mixed.collect():
        ids = own.encode_ordinary(r["text"] or "")
        digest = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        expected[r["doc_id"], len(ids), digest, tuple(ids)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"], tuple(r["ids"])) for r in last) == expected
    if tail == 1024:
        whole = corpus_pipeline.run(spark, folder).collect()
        assert Counter((r["doc_id"], r["ids_sha256"]) for r in whole) == Counter((r["doc_id"], r["ids_sha256"]) for r in last)


def test_an_empty_corpus_goes_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_many_sizes_of_one_source_are_allotted_in_several_tasks(spark):
    sizes = spark.range(1, 64_001).select(F.lit("+s").alias("src"), F.col("id").alias("size"), (F.col("id") % 3 + 1).alias("docs"))
    words = sizes.agg(F.sum(F.col("size") * F.col("docs"))).first()[0]
    rows = sizes.agg(F.sum("docs")).first()[0]
    wanted = spark.createDataFrame([("+s", words, rows, 1.37 * words)], "src string, source_size bigint, rows bigint, target double")
    solved = mixing.solve(sizes, wanted)
    begin = time.time()
    got = mixing._allotted(sizes, solved).join(sizes, ["src", "size"])
    taken, most, n = got.agg(F.sum(F.col("size") * F.col("copies")), F.max(F.col("copies") / F.col("docs")), F.count(F.lit(1))).first()
    assert n == 64_000 and abs(taken - 1.37 * words) <= 1 and most <= mixing.CAP
    assert time.time() - begin < 60


def test_targets_that_cannot_be_met_are_reported(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 2)
    sizes = spark.createDataFrame([("+s", n, 1) for n in range(1, 50)], "src string, size bigint, docs bigint")
    wanted = spark.createDataFrame([("+s", 1225, 49, 100.0)], "src string, source_size bigint, rows bigint, target double")
    with pytest.raises(RuntimeError, match="not met"):
        mixing.solve(sizes, wanted)
