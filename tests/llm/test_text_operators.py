"""Text operators against brute force on small tables, with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import html
import itertools
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from arealens.llm import ann, decontam, licences, packing, pages, pii, ppm, quality, shingles, simhash, substring
from arealens.llm.common import components, pack, unpack

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " \n\t ", "one", "one two", "ÀB c d " * 30, "long " * 60_000, "tie tie tie", "a\x1cb \x85 c"]
SCHEMA = "doc_id long, text string, lang string, block long, shard int, body string, n long, key long"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", 1, 2, "x", 3, 4) for i, t in rows], SCHEMA)


def base_rows(n=120):
    found = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT {n}").fetchall()
    rows = found + [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000 + i, t) for i, (_, t) in enumerate(found[:40])]
    return rows + [(3, found[3][1]), (3, found[3][1]), (None, found[5][1]), (None, None)]


@pytest.fixture(scope="module")
def rows():
    return base_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


def bag(found):
    return collections.Counter(found)


def test_substring(docs, rows):
    order = lambda i: (i is None, i or 0)
    first, texts = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            if key not in first or order(i) < order(first[key]):
                first[key] = i
    want = []
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if order(first[tuple(w[k:k + 13])]) < order(i):
                gone[k:k + 13] = [True] * 13
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs).collect()]
    assert bag(got) == bag(want)


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = packing.pack_documents(docs, path).collect()
    assert bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == bag(want)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(x[3] for x in want) / 2048) + 2


def test_packing_takes_the_tokenizer_as_it_is(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    texts = [f"x {s} y" for s in special] + [f"é{s}{s} 日本" for s in special] + [special[0][:-1], special[0].upper(), "no mark"]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(table(spark, list(enumerate(texts))), path).collect()}
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 2048), rng.randint(1, 30), rng.randint(600, 1100)]) for _ in range(rng.choice([1, 3, 400, 3000]))]
    histogram = collections.Counter(sizes)
    places, total = packing.plan(histogram)
    loads = collections.defaultdict(list)
    for size, found in places.items():
        starts = [p[0] for p in found] + [histogram[size]]
        assert starts == sorted(starts) and starts[0] == 0
        for (lo, first, per, at), hi in zip(found, starts[1:]):
            for r in range(hi - lo):
                loads[first + r // per].append((at + r % per * size, size))
    assert len(loads) == total
    for places_ in loads.values():
        at = 0
        for offset, size in sorted(places_):
            assert offset == at
            at += size
        assert at <= 2048
    # Best fit decreasing, one piece at a time, after the same matching of large pieces.
    assert total <= 11 / 9 * math.ceil(sum(sizes) / 2048) + 1 or total <= sum(3 * s > 2048 for s in sizes)


def ppm_by_hand(rows, order):
    train, tokens = collections.Counter(), []
    for i, t in rows:
        w = [x.encode() for x in WORD.findall((t or "").translate(LOWER))] + [b"\n"]
        tokens.append((i, w))
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            train.update(w)
    n, v, contexts = sum(train.values()), len(train), collections.defaultdict(collections.Counter)

    def spell(words):
        """Of each word, its bytes and the contexts before them, across word borders."""
        spelt = [w if w == b"\n" else w + b" " for w in words]
        s, at, out = b"\n" * order + b"".join(spelt), order, []
        for w in spelt:
            out.append([([s[p - k:p] for k in range(order, -1, -1)], s[p]) for p in range(at, at + len(w))])
            at += len(w)
        return out

    for i, w in tokens:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            for chain, s in itertools.chain(*spell(w)):
                for c in chain:
                    contexts[c][s] += 1

    def byte(chain, s):
        out, total = set(), 0.0
        for c in chain:
            if c in contexts:
                left = {a: b for a, b in contexts[c].items() if a not in out}
                if s in left:
                    return total + math.log10((left[s] - 0.5) / sum(left.values()))
                if left:
                    total += math.log10(0.5 * len(left) / sum(left.values()))
                out |= set(contexts[c])
        return total - math.log10(max(256 - len(out), 1))

    def blended(w):
        each = []
        chances = [sum(byte(*b) for b in word) for word in spell(w)]
        for m in ppm.ESCAPES:
            seen, total = collections.Counter(), 0.0
            for t, (x, chance) in enumerate(zip(w, chances)):
                total += math.log10(m / (t + m)) + chance if not seen[x] else math.log10((seen[x] + m * 10 ** chance) / (t + m))
                seen[x] += 1
            each.append(total)
        return max(each) + math.log10(sum(10 ** (e - max(each)) for e in each) / len(each))

    base = lambda w: sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
    return [(i, i is None or zlib.crc32(str(i).encode()) % 10 == 0, len(w), sum(train[x] > 0 for x in w), n, base(w), blended(w)) for i, w in tokens]


def test_ppm(docs, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted([tuple(r) for r in ppm.score(docs, order=3).collect()], key=key)
    want = sorted(ppm_by_hand(rows, 3), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_ppm_answers_pack_well():
    draw = np.random.default_rng(3)
    ctx = np.sort(draw.integers(0, 9000, 40_000))
    n = draw.zipf(1.6, len(ctx)) % 3000 * (draw.random(len(ctx)) > 0.01)
    total = np.bincount(ctx, weights=n)[ctx].astype(np.int64)
    chance = np.where(n > 0, np.log10(np.maximum(n - 0.5, 0.5) / np.maximum(total, 1)), -draw.random(len(ctx)))
    answer = pack(ppm._counted(ctx, n, total, np.where(n > 0, 0.0, chance)))
    assert (ppm._told(unpack(answer)) == chance).all()
    assert len(answer) < 0.6 * len(pack(pa.table({"score": chance})))
    assert len(ppm._told(ppm._counted(ctx[:0], n[:0], total[:0], chance[:0]))) == 0


@pytest.mark.parametrize("texts", [[b"", None, b" a\tB  a ", b"red house red house", b"red"], [b"", bytes(range(256)) * 3, b"a b"], [None]])
def test_ppm_numbers_the_bytes_and_tokens_of_a_block(texts):
    order, ids = 5, [3, None, 20, 7, 8][:len(texts)]
    own = ppm._Texts(pa.table({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())}), order, 10)
    words = [(x or b"").lower().split() for x in texts]
    spelt = [b"".join(w + b" " for w in ws) + b"\n" for ws in words]
    pairs = [int.from_bytes(b"\1" + (b"\n" * order + x)[k:k + order + 1], "big") for x in spelt for k in range(len(x))]
    learnt = collections.Counter(p for p, held in zip(pairs, np.repeat(own.held, [len(x) for x in spelt])) if not held)
    distinct, times = own.pairs()
    assert distinct.tolist() == sorted(set(pairs)) and times.tolist() == [learnt[p] for p in distinct.tolist()]
    # Few kinds of bytes are numbered by one sort, all 256 by a look-up.
    again, place = own.pair_places()
    assert (again == distinct).all() and again[place].tolist() == pairs
    tokens = own.tokens.to_pylist()
    assert [tokens[k] for k in own.index] == [w + b" " for ws in words for w in ws] and tokens[own.end] == b"\n"
    learnt = collections.Counter(t for ws, held in zip(words, own.held) if not held for t in [*(w + b" " for w in ws), b"\n"])
    assert own.token_times().tolist() == [learnt[t] for t in tokens]
    parts = own.token_parts(7)
    assert sorted(k for _, part in parts for k in part) == list(range(len(tokens)))
    alone = {s: ppm._hashed(pa.array([tokens[k] for k in part], pa.binary())) % np.uint64(7) for s, part in parts}
    assert all((h == s).all() for s, h in alone.items())


def test_ppm_without_training_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = ppm.score(table(spark, [(i, "a b") for i in held])).collect()
    assert len(got) == 3 and all(r.held_out and r.train_tokens == 0 and math.isfinite(r.score) for r in got)


def test_ppm_hangs_on_the_words_before(spark):
    learnt = [(i, "red house blue door " * 3) for i in range(100, 120)]
    held = [i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = {r.doc_id: r for r in ppm.score(table(spark, [*learnt, (held[0], "blue door red house"), (held[1], "door house red blue")])).collect()}
    seen, mixed = got[held[0]], got[held[1]]
    # The same known words: the frequencies of words tell no difference, their order does.
    assert seen.n_known == mixed.n_known == 5 and seen.base_score == pytest.approx(mixed.base_score)
    assert seen.score > mixed.score + 1
    # A word too unlikely for a double's range still has a finite score.
    long = ppm.score(table(spark, [*learnt, (held[0], "".join(chr(33 + i % 90) for i in range(900)))])).collect()
    assert all(math.isfinite(r.score) for r in long)


def fingerprint_by_hand(t):
    w = WORD.findall((t or "").translate(LOWER))
    grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    counts = collections.Counter(xxhash.xxh64_intdigest(g.encode(), 42) for g in grams)
    return sum(1 << b for b in range(64) if 2 * sum(n for h, n in counts.items() if h >> b & 1) > len(grams))


def roots_by_hand(prints):
    prints = sorted(prints)
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_simhash(docs, rows):
    prints = [(i, fingerprint_by_hand(t)) for i, t in rows]
    root = roots_by_hand({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = bag((i, p, least.get(root[p])) for i, p in prints)
    got = simhash.near_duplicates(docs).collect()
    assert bag((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(set(root.values())) and set(r.doc_id for r in kept) == {least.get(r) for r in root.values()}


@pytest.mark.parametrize("bucket", [1, 4, 64])
def test_simhash_links_of_crowded_buckets(spark, bucket):
    rng, prints = random.Random(bucket), set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for b in rng.sample(range(64), rng.choice([0, 1, 1, 2, 3, 5])):
                x ^= 1 << b
            prints.add(x)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    found = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), bucket)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in found.collect())
    named = {r.node % (1 << 64): r.root for r in components(found).collect()}
    groups = collections.defaultdict(set)
    for p, root in roots_by_hand(prints).items():
        groups[root].add(p)
    assert bag(frozenset(g) for g in groups.values() if len(g) > 1) == bag(
        frozenset(p for p in named if named[p] == r) for r in set(named.values()))


def shingles_by_hand(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {" ".join(w[k:k + 5]) for k in range(len(w) - 4)} or ({" ".join(w)} if w else set())


def near_copies_by_hand(rows, least=0.8):
    """Least id of each component."""
    sets = [(i, shingles_by_hand(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a == b or least * max(len(a), len(b)) <= min(len(a), len(b)) and len(a & b) >= least * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {find(i) for i, _ in sets}


def near_copies(seed):
    """Texts of 60 to 200 words, each with copies in which none to a few words are changed, and chains of such copies."""
    rng, out = random.Random(seed), []
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    for family in range(12):
        base = [word() for _ in range(rng.randint(60, 200))]
        for copy in range(30 if family else 150):
            one = list(base)
            for at in rng.sample(range(len(one)), rng.choice([0, 1, 1, 2, 3, 5, 8])):
                one[at] = word()
            base = one if family % 3 == 2 else base
            out.append(" ".join(one).capitalize())
    rng.shuffle(out)
    return list(enumerate(out))


def test_near_copies(spark):
    rows = near_copies(1)
    assert 12 < len(near_copies_by_hand(rows)) < len(rows) / 2
    kept = shingles.keep_one(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(near_copies_by_hand(rows)) and all(r.text == dict(rows)[r.doc_id] for r in kept)


def test_near_copies_odd_rows(spark, docs, rows):
    kept = shingles.keep_one(docs).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert bag(r.doc_id for r in kept) == bag(ordered[n][0] for n in near_copies_by_hand([(n, t) for n, (_, t) in enumerate(ordered)]))


def test_pipeline_stage_finds_near_copies(spark):
    import corpus_pipeline

    rows = near_copies(2)
    kept = dict(corpus_pipeline.STAGES)["near duplicates"](spark, table(spark, rows), "")
    assert {r.doc_id for r in kept.collect()} == near_copies_by_hand(rows)


def test_pipeline_stage_runs_fingerprints_and_checks_them(spark, monkeypatch):
    """Fingerprints that agree propose a pair; texts that share a repeated phrase only are no copies."""
    import corpus_pipeline

    tail = lambda n: " ".join(f"w{n}x{i}" for i in range(40))
    rows = [(n, "one two three four five six seven " * 400 + tail(n)) for n in range(4)] + [(9, "one two three four five six seven " * 400 + tail(3)), (10, None), (11, "")]
    assert len({simhash.fingerprint(t.encode()) for _, t in rows[:5]}) < 5
    made, pairs = [], shingles._of_groups
    monkeypatch.setattr(shingles, "_of_groups", lambda *a: made.append(pairs(*a)) or made[-1])
    kept = dict(corpus_pipeline.STAGES)["near duplicates"](spark, table(spark, rows), "")
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 10} and made[0].count() > 0


def test_pipeline_stage_checks_pairs_whose_signatures_differ_much(spark):
    """Four of five shingles are shared (0.8), but no more than 100 of 150 minima."""
    import corpus_pipeline

    texts = ["bece dfgg adch ebfa bhhe hahd ceeg beff fgff", "fegb cgbc hghd fheb gchh chdh hhbf hhec dbhf", "hfhd fcbd afbg hdfg cace gegf afgf bbce cbab"]
    rows = [(10 * n + k, t if k else " ".join(t.split()[:8])) for n, t in enumerate(texts) for k in (0, 1)]
    assert near_copies_by_hand(rows) == {0, 10, 20}
    kept = dict(corpus_pipeline.STAGES)["near duplicates"](spark, table(spark, rows), "")
    assert {r.doc_id for r in kept.collect()} == {0, 10, 20}


def test_all_pairs_of_a_group_are_checked(spark):
    """Most of these pairs share no band, and no more than a few are with the first of their group."""
    rng, rows = random.Random(4), []
    for n in range(60):
        base = [f"w{n}x{i}" for i in range(44)]
        rows += [(2 * n, " ".join(base[:28])), (2 * n + 1, " ".join(base[14:] + [f"y{n}z{rng.random()}"]))]
    least = 0.24
    assert len(near_copies_by_hand(rows, least)) == 60
    df = table(spark, rows)
    groups = df.select("doc_id", F.xxhash64("text").alias("h"), F.lit(1).cast("long").alias("root"))
    assert {r.doc_id for r in shingles.keep_one(df, least=least, groups=groups).collect()} == near_copies_by_hand(rows, least)
    # The same pairs without a group: bands alone find few of them.
    assert shingles.keep_one(df, least=least).count() > 100


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = [(r.score, truth[r.doc_id]) for r in quality.classify(docs, labels).collect() if r.held_out and r.doc_id in truth]
    pairs = [(a, b) for a, x in found if x == 1 for b, y in found if y == 0]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.95
    assert sum((s >= 0.3) == (y == 1) for s, y in found) / len(found) > 0.85


def test_quality_odd_rows(spark, docs, rows):
    none = quality.classify(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(none) == len(rows) and {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    learn = [i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, None if k % 7 == 0 else k % 3 > 0, "x") for k, i in enumerate(learn)], "doc_id long, quality boolean, score string")
    got = quality.classify(docs, labels.withColumn("quality", F.col("quality").cast("int"))).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_prior_is_near_the_truth():
    rng = np.random.default_rng(1)
    p, u = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, 2400), rng.normal(-2, 1, 1600)])
    assert abs(quality.estimate_prior(p, u) - 0.6) < 0.06


def test_graph_search(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1)), 3).astype(np.float32)
    x[500:1500] = x[7]  # a hot vector
    odd = [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [None] + [1.0] * 15), (9080, [1.0] * 3), (None, [1.0] * 16)]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + odd
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.search(vectors, vectors.where("vec_id % 20 = 0"), shard_rows=700).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hit = 0
    wide = x.astype(float)
    for q in range(0, 3000, 20):
        score = wide @ wide[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -np.round(score, 12)))[:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and all(abs(score[v] - s) < 1e-9 for _, v, s in mine)
        hit += sum(s >= score[best[-1]] - 1e-9 for _, _, s in mine)
    assert set(got) == set(range(0, 3000, 20)) and hit / 3000 > 0.9
    assert ann.search(vectors.limit(0), vectors.limit(0)).count() == 0
    few = vectors.where("vec_id < 3")
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in ann.search(few, few).collect())[0][0] == 0 and ann.search(few, few).count() == 6


def luhn(d):
    return sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


STATED = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(t):
    out = []
    for k, p in enumerate(STATED):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


HARD = ["a@b.c_d@e.f", "..@a.b.c.d..", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.256.3.4 01.002.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111x4111111111111111",
        "+1 (017) 555-7713", "+++1 (234) 567-8901 and +49 30 1234567890", "é😀a@b.co 😀 4111111111111111", "9" * 5000, "1-" * 3000, "a" * 100_000, "a@" * 2000,
        "+1 " + " " * 1000 + "2", "1." * 900, "a@b.c@d.e", "+1+2222222222+3 444 555 66 77"]


def test_personal_data(spark, docs, rows):
    every = rows + [(5000 + i, t) for i, t in enumerate(HARD)]
    random.seed(5)
    every += [(6000 + i, "".join(random.choice("a1.@+- 4é") for _ in range(200))) for i in range(60)]
    got = pii.find_spans(table(spark, every)).collect()
    shown = lambda spans: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    assert bag((r.doc_id, shown((x.s, x.k, x.e) for x in r.base)) for r in got) == bag((i, shown(base_spans(t))) for i, t in every)
    for r in got:
        assert {(x.s, x.k, x.e) for x in r.base} <= {(x.s, x.k, x.e) for x in r.spans}


def test_weak_spans_and_redaction(spark):
    text = 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" call 555-123-4567 ssn 123-45-6789 mail a@b.co now'
    more = [(i, f"card {n} is mine") for i, n in enumerate(range(5927243074273351, 5927243074273391))]
    plain = [(100 + i, f"item no {i} of page {i} only") for i in range(40)]
    out = {r.doc_id: r.text for r in pii.redact(table(spark, [(-1, text), (-2, None), (-3, ""), *more, *plain])).collect()}
    assert out[-1] == "[SECRET] call [TEL] ssn [SSN] mail [EMAIL] now" and out[-2] is None and out[-3] == ""
    assert all(out[i] in ("card [NUMBER] is mine", "card [CARD] is mine") for i, _ in more) and all(out[i] == t for i, t in plain)


def test_reliabilities():
    random.seed(2)
    rates, patterns = [(0.9, 0.2), (0.8, 0.3), (0.7, 0.1)], collections.Counter()
    for _ in range(20_000):
        true = random.random() < 0.4
        patterns["".join("+" if random.random() < (a if true else b) else "-" for a, b in rates)] += 1
    share, found, chance = pii.reliabilities(dict(patterns))
    assert abs(share - 0.4) < 0.08 and all(abs(a - c) < 0.1 and abs(b - d) < 0.1 for (a, b), (c, d) in zip(rates, found))
    assert chance["+++"] > 0.9 > 0.1 > chance["---"]


PARA = "Some long sentence about things that goes on for a while, to look like true prose of an article."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text only", "plain text only"), ("<!-- x", ""), ("<p>a&lt;b &amp; c&eacute;<b>d</b>e<br>f</p>", "a<b & cédef".replace("def", "de f")),
    (f"<header><h1>Site</h1></header><nav><a href=x>A</a></nav><div id=content><h1>Title</h1><p>{PARA}</p><p>Short.</p><p>{PARA}</p></div>"
     f"<div class='comments'><p>{PARA}</p></div><footer>{PARA}</footer>", f"Title {PARA} Short. {PARA}"),
    (f"<div class=sidebar><p>{PARA}</p></div><main><article><header><h1>Head</h1></header><p>x  y\n z</p><form>{PARA}</form><aside>{PARA}</aside>"
     f"<section class='comments'><p>{PARA}</p></section></article></main><div class='cookie-notice'>{PARA}</div><script>var a='<p>'</script>", "Head x y z"),
    ("<div" * 3000, ""), ("<b>" * 20_000 + "x", "x"), ("<a title='a>b'>", ""),
])
def test_page_text(page, want):
    assert pages.main_text(page) == want


VERSE = [f"Line {n} of a poem, so short" for n in range(40)]


@pytest.mark.parametrize("page, want", [
    (f"<div><p>{PARA}</p><p>{PARA}</p></div><article><p>Teaser.</p></article>", f"{PARA} {PARA} Teaser."),
    (f"<div><p>{PARA}</p></div><p><a href=x>one</a><p><a href=x>two</a><p><a href=x>three</a><article><p>Teaser.</p></article>", PARA),
    (f"<div><p>{PARA}</p></div><p><a href=x>one</a><p><a href=x>two</a><p><a href=x>three</a><article><h2>Head</h2><p>{PARA}</p></article>", f"{PARA} Head {PARA}"),
    (f"<div><p>{PARA}</p></div><article class='comment byuser'><p>{PARA}!</p></article><article role=complementary><p>{PARA}!</p></article>"
     f"<article hidden><p>{PARA}!</p></article><main aria-hidden=true><p>{PARA}!</p></main>", PARA),
    (f"<main class=with-sidebar><article class='post has-sidebar' id=post-1><p>{PARA}</p></article></main>", PARA),
])
def test_page_text_outside_articles(page, want):
    assert pages.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<div>" + "".join(f"<p>{x}</p>" for x in VERSE) + "</div>", " ".join(VERSE).replace("  ", " ")),
    ("<div>" + "".join(f"<p>{x[:12]}</p>" for x in VERSE) + "</div>", " ".join(x[:12].strip() for x in VERSE)),
    ("<ol>" + "".join(f"<li>Step {n}</li>" for n in range(30)) + "</ol><ul><li><a href=x>elsewhere</a></ul>", " ".join(f"Step {n}" for n in range(30))),
    (f"<div><div><div><p>{PARA}</p></div></div></div><div><div><div><p>The end.</p></div></div></div>", f"{PARA} The end."),
])
def test_page_text_of_short_lines(page, want):
    assert pages.main_text(page) == want


def test_pages_table(spark):
    found = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit("clash"))
    for r in pages.extract(found).collect():
        body = r.html.split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        body = re.sub(r"<[^>]*>?", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", body))
        assert r.text == " ".join(html.unescape(body).split())
    assert pages.extract(found.limit(0)).count() == 0


def licences_by_hand(rows, least=0.8):
    import unicodedata

    known = [(name, licences.template_words(t)) for name, t in licences.TEMPLATES]
    pairs = lambda w: collections.Counter(zip(w, w[1:]))
    out = {}
    for i, t in rows:
        text = "".join(c if c == "\n" or unicodedata.category(c)[0] in "LN" else " " for c in (t or "").lower())
        flat, regions = text.split(), [(True, x.split()) for x in text.split("\n")]
        for _, w in known:
            for j in range(min(3, len(w) - 1)):
                k = 0
                while k < len(flat) - 1:
                    if flat[k:k + 2] == w[j:j + 2]:
                        regions.append((False, flat[max(0, k - j):k + len(w) - j]))
                    k += 1
        for line, x in regions:
            fits = [(2 * sum((pairs(x) & pairs(w)).values()) / (len(x) + len(w) - 2), -m, name) for m, (name, w) in enumerate(known)
                    if len(x) > 1 and least <= (2 - least) * (len(w) - 1) / (len(x) - 1) and least <= (2 - least) * (len(x) - 1) / (len(w) - 1)]
            dice, _, name = max(fits, default=(0, 0, ""))
            if dice >= least:
                best = out.setdefault((i, name), [0.0, 0])
                out[i, name] = [max(best[0], dice), best[1] + line]
    return {k: (round(a, 9), max(b, 1)) for k, (a, b) in out.items()}


def test_licences(spark, rows):
    mit = licences.TEMPLATES[4][1]
    extra = ["x y. Released under the MIT License. and more", mit.replace(", ", ",\n"), "Licensed under CC BY-SA 4.0.\n" * 3, "licensed under the apache license version 2",
             "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 2!!", "released under", "the the the the"]
    every = [(i, t) for i, t in rows if len(t or "") < 20_000] + [(7000 + i, t) for i, t in enumerate(extra)]
    got = {(r.doc_id, r.licence): (round(r.dice, 9), r.notices) for r in licences.scan(table(spark, every)).collect()}
    assert got == licences_by_hand(every)
    assert got[7000, "MIT"] == (1.0, 1) and got[7001, "MIT"][0] == 1.0 and got[7002, "CC-BY-SA-4.0"] == (1.0, 3)


def licences_at_every_word(rows, least=0.8):
    """Licences of all windows of a template's length."""
    known = [(name, licences.template_words(t)) for name, t in licences.TEMPLATES]
    pairs = lambda w: collections.Counter(zip(w, w[1:]))
    return {(i, name) for i, t in rows for name, w in known for flat in [re.findall(r"[a-z0-9]+", t.lower())] for k in range(len(flat))
            if 2 * sum((pairs(flat[k:k + len(w)]) & pairs(w)).values()) >= least * (len(flat[k:k + len(w)]) + len(w) - 2)
            and len(flat[k:k + len(w)]) > 1}


def test_licences_without_their_opening(spark):
    rng, rows, want = random.Random(3), [], set()
    for n, (name, t) in enumerate(licences.TEMPLATES):
        words = t.split()
        if len(words) < 20:
            continue
        for how in range(4):
            own = [words[4:], ["zz"] * 4 + words[4:], words[:3] + ["changed"] + words[4:], ["one", "two"] + words[5:9] + ["zz"] + words[9:]][how]
            body = ["zzz%d" % rng.randrange(99) for _ in range(12)] + own + ["yyy%d" % rng.randrange(99) for _ in range(12)]
            rows.append((10 * n + how, "\n".join(" ".join(body[k:k + 7]) for k in range(0, len(body), 7))))
    want = licences_at_every_word(rows)
    assert len({i for i, _ in want}) >= len(rows) - 6
    got = {(r.doc_id, r.licence) for r in licences.scan(table(spark, rows)).collect()}
    # A window counts for its best template only.
    assert got <= want and {i for i, _ in got} == {i for i, _ in want}


def edits_by_hand(item, text):
    before = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        now = [i + 1]
        for j, y in enumerate(text):
            now.append(min(before[j] + (x != y), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_decontamination(spark, rows):
    items = duckdb.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY item_id").fetchall()
    rng = random.Random(4)
    every, planted = list(rows), {}
    for n in range(60):
        item, text = rng.choice(items)
        changed = list(text)
        for _ in range(rng.randrange(0, 24)):
            k = rng.randrange(len(changed))
            changed[k:k + 1] = rng.choice([[], [rng.choice("abcdef")], [changed[k], rng.choice("abcdef")]])
        lead = rng.choice(rows[:100])[1][:200]
        every.append((8000 + n, f"{lead} {''.join(changed)} end" if rng.random() < 0.8 else "".join(changed).upper()))
        planted[8000 + n] = item
    every = [(i, t) for i, t in every if t is None or len(t) < 20_000]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items + [items[0], (900, None), (901, ""), (902, "tiny")]], "item_id long, text string, doc_id int")
    got = decontam.find_items(table(spark, every), bench).collect()
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    texts = dict(every)
    for doc, item in planted.items():
        wide = decontam.normalise(dict(items)[item])[0]
        least = edits_by_hand(wide.tolist(), decontam.normalise(texts[doc])[0].tolist())
        assert found.get((doc, item)) == (least if least <= int(decontam.EDIT_SHARE * len(wide)) else None)
    for i, t in every:
        for item, text in items:
            if t and text in t:
                assert found[i, item] == 0
    clean = decontam.decontaminate(table(spark, every), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in every} - {d for d, _ in found}
    assert decontam.find_items(table(spark, every), bench.limit(0)).count() == 0


EMPTY = {
    "substring": lambda d, s: substring.remove_repeats(d),
    "packing": lambda d, s: packing.pack_documents(d, public_tokenizers.path("byte_bpe_50k.json")),
    "ppm": lambda d, s: ppm.score(d),
    "simhash": lambda d, s: simhash.near_duplicates(d),
    "keep_one": lambda d, s: simhash.keep_one(d),
    "shingles": lambda d, s: shingles.keep_one(d),
    "quality": lambda d, s: quality.classify(d, s.createDataFrame([], "doc_id long, quality int")),
    "pii": lambda d, s: pii.find_spans(d),
    "redact": lambda d, s: pii.redact(d),
    "licences": lambda d, s: licences.scan(d),
    "decontam": lambda d, s: decontam.find_items(d, s.createDataFrame([], "item_id long, text string")),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(spark, name):
    assert EMPTY[name](table(spark, []), spark).count() == 0


def test_pipeline_against_stages_by_hand(spark, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {i for i, r in docs.items() if model.score(r.text.encode()) >= quality.THRESHOLD}
    least = near_copies_by_hand([(i, docs[i].text) for i in sorted(kept)])
    index = decontam.Index(*zip(*[(r.item_id, decontam.normalise(r.text)[0]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]), decontam.Q, decontam.EDIT_SHARE)
    clean = {i for i in least if not list(index.search(decontam.normalise(docs[i].text)[0]))}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == clean
    ends = collections.defaultdict(int)
    for r in out:
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert max(ends.values()) <= 2048 and sum(ends.values()) == sum(r.length for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "near duplicates"


def found_in(items, text):
    index = decontam.Index(list(range(len(items))), [decontam.normalise(t)[0] for t in items], decontam.Q, decontam.EDIT_SHARE)
    return {index.ids[k]: e for k, _, _, e in index.search(decontam.normalise(text)[0])}


def test_short_items_take_their_edits():
    items = ["which is larger", "what colour is the clear", "name the longest river of asia", "who wrote the play about the dane", "how many sides has a regular octagon?"]
    rng = random.Random(8)
    for k, item in enumerate(items):
        wide = decontam.normalise(item)[0].tolist()
        for _ in range(200):
            changed = list(wide)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(changed))
                changed[at:at + 1] = rng.choice([[], [ord("z")], [changed[at], ord("q")]])
            text = "before it " + "".join(map(chr, changed)) + " and after"
            least = edits_by_hand(wide, decontam.normalise(text)[0].tolist())
            want = least if least <= int(decontam.EDIT_SHARE * len(wide)) else None
            assert found_in(items, text).get(k) == want


@pytest.mark.parametrize(("text", "want"), [
    ("Is it an Oak tree?", {0: 0}), ("a soak and an oaken bench", {}), ("soak, then oak", {0: 0}), ("oak", {0: 0}), ("x 42.", {1: 0}), ("1 420 142", {}), ("", {})])
def test_items_below_a_gram_are_found_between_word_borders(text, want):
    assert found_in(["oak", "42"], text) == want


def test_decontamination_judges_rows(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog by the river")], "item_id long, text string")
    bad = "see: The quick brown fox jumps over the lazy dog, by the river."
    rows = [(7, bad), (7, "clean text"), (None, bad), (None, "clean as well"), (8, None), (9, "")]
    got = decontam.decontaminate(table(spark, rows), bench)
    assert bag((r.doc_id, r.text) for r in got.collect()) == bag(r for r in rows if r[1] != bad)
    assert got.columns == table(spark, rows).columns
    assert decontam.decontaminate(table(spark, rows), bench.limit(0)).count() == len(rows)


def test_one_unlabelled_row_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    every = docs.selectExpr("doc_id", "cast(length(text) % 2 as int) as quality")
    score = lambda labels: {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    gone = every.where("quality = 0 and crc32(cast(doc_id as string)) % 5 <> 0").orderBy("doc_id").first().doc_id
    assert score(every) == score(every.where(f"doc_id <> {gone}"))


def test_long_secrets_and_spelled_mail_go_whole(spark):
    rng = random.Random(3)
    key = "".join(rng.choices("abcdefXYZ0123456789", k=2000))
    name = "n" * 90
    rows = [(i, f"Set token = {key} here, or write to {name} [at] {'d' * 70} [dot] example now.") for i in range(20)]
    rows += [(100 + i, f"api_key: {''.join(rng.choices('0123456789abcdef', k=32))} in use") for i in range(40)]
    for r in pii.redact(table(spark, rows)).collect():
        assert not re.search("[a-fXYZ0-9]{12}", r.text.replace("api_key", "").replace("token", "")) and "n" * 9 not in r.text


@pytest.mark.parametrize("n", [1, 40, 20_000])
def test_texts_with_many_spans(spark, n):
    """Every number of a long list is found and replaced, in time that follows its length."""
    lines = [f"é{i} call +1 (415) 555-{i % 10000:04d} or 415-555-{i % 10000:04d}; mail u{i}@example.com 𝒳" for i in range(n)]
    text = "\n".join(lines)
    docs = table(spark, [(1, text), (2, None), (3, "")])
    began = time.monotonic()
    found = {r.doc_id: r for r in pii.find_spans(docs).collect()}
    at = lambda kind, want: [(m.start(), m.end()) for m in re.finditer(want, text)]
    spans = collections.defaultdict(list)
    for s, k, e in found[1].base:
        spans[pii.KINDS[k]].append((s, e))
    assert spans["phone"] == at("phone", r"\+1 \(415\) 555-[0-9]{4}") and spans["email"] == at("email", r"u[0-9]+@example\.com")
    added = [(s, e) for s, k, e in found[1].spans if pii.KINDS[k] == "tel"]
    assert set(added) <= set(at("tel", r"(?<!\) )415-555-[0-9]{4}")) and found[2].spans == found[3].spans == []
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    want, last = [], 0
    for s, k, e in sorted((s, k, e) for s, k, e in found[1].spans):
        want += [text[last:s], f"[{pii.KINDS[k].upper()}]"]
        last = e
    assert clean == {1: "".join(want) + text[last:], 2: None, 3: ""}
    assert time.monotonic() - began < 60


BODY = "The river ran high that spring and nobody in the village slept. " * 6


@pytest.mark.parametrize("name", ["container has-sidebar", "share-page widget-area-none", "post no-comments", "col widget-free", "comments-open"])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_page_names_that_tell_of_the_layout(tag, name):
    page = f'<body><{tag} class="{name}"><p>{BODY}</p><p>{BODY}</p></{tag}><div class="sidebar"><p>{BODY}</p></div></body>'
    assert pages.main_text(page) == f"{BODY}{BODY}".strip()


@pytest.mark.parametrize("name", ["left-sidebar", "site-header", "cookie-banner", "related-posts", "ad", "comments-section", "social_share", "share-page"])
def test_page_names_that_mark_other_text(name):
    page = f'<body><div class="content"><p>{BODY}</p><p>{BODY}</p></div><div class="{name}"><p>{BODY}</p></div></body>'
    assert pages.main_text(page) == f"{BODY}{BODY}".strip()


def test_page_titles_formulas_and_linked_paragraphs():
    page = (f'<body><p>Site</p><div><div class="entry-header"><h1>A Title</h1></div><h2>Of spring</h2><p>By A. Author</p><p>{BODY}</p><p><a href="x">Read the whole report of that year</a></p>'
            f'<p>{BODY}so <math><mi>x</mi></math> holds</p></div><ul><li><a href="1">One</a></li><li><a href="2">Two</a></li></ul></body>')
    got = pages.main_text(page)
    assert got == f"A Title Of spring By A. Author {BODY}Read the whole report of that year {BODY}so x holds"
