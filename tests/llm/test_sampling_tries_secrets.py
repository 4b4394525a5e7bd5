"""Resampling, prefix tries and secret scans against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import string
import zlib

import pytest

from arealens.llm import prefix_trie, queries, resampling, secret_scan

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, weight string, score string, place long, kind string, rank string"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "w", "s", 1, "k", "r") for i, t in rows], DOCS)


# ---- importance resampling

def run_features(text, run):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i:i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]


def resampled_by_hand(rows, target, run, buckets, least, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    source = collections.Counter(bucket(f) for _, t in rows for f in run_features(t, run)[1])
    wanted = collections.Counter(bucket(f) for t in target for f in run_features(t, run)[1])
    s_all, t_all, out = sum(source.values()), sum(wanted.values()), []
    for i, t in rows:
        words, found = run_features(t, run)
        gain = [math.floor(1000 * math.log((wanted[b] + 1.0) * (s_all + buckets) / ((source[b] + 1.0) * (t_all + buckets)))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), len(words) >= least))
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r))
    drawn = fit[:percent * len(fit) // 100]
    return out, [(r[0], r[1], r[2], r[3]) for r in drawn]


def sample_rows(spark, n=150):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()]
    odd = [None, "", " \n", "ÀB c d " * 30, "long " * 50_000, "a\x1cb \x85 ç" * 20, "-- __ \x7f", "Sıx İ K " * 12]
    rows += [(1000 + i, t) for i, t in enumerate(odd)] + [(3, rows[3][1])] * 25 + [(None, rows[5][1])] * 9 + [(None, None)]
    return rows


@pytest.mark.parametrize("run,buckets,percent", [(1, 10_000, 10), (3, 997, 35), (2, 1, 100), (1, 50, 1)])
def test_resampling(spark, run, buckets, percent):
    rows = sample_rows(spark)
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [None, "", "words and words"]
    bench = spark.createDataFrame([(1, t, 0) for t in target], "item_id long, text string, n long")
    want, drawn = resampled_by_hand(rows, target, run, buckets, 20, percent)
    got = resampling.resample(docs_of(spark, rows).repartition(5), bench, run=run, buckets=buckets, percent=percent).collect()
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == collections.Counter(w[:4] for w in want)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in ranked] == drawn


def test_resampling_of_nothing(spark):
    none, some = docs_of(spark, []), docs_of(spark, [(1, "one two " * 20)])
    assert resampling.resample(none, some).collect() == []
    (row,) = resampling.resample(some, none, percent=100).collect()
    assert (row.n_features, row["rank"]) == (40, 1)
    (row,) = resampling.resample(some, none).collect()
    assert row["rank"] is None
    with pytest.raises(ValueError):
        resampling.resample(some, none, run=0)


@pytest.mark.parametrize("pivots", [1, 3, 15])
def test_quickselect(spark, pivots):
    rng = random.Random(pivots)
    keys = [(rng.choice([5, 5, 5, rng.randint(-30, 30)]), rng.choice([None, 7, rng.randint(-9, 9)]), p) for p in range(400)]
    table = spark.createDataFrame(keys, "score long, doc_id long, place long").repartition(6).cache()
    order = sorted(keys, key=lambda k: (-k[0], k[1] is None, k[1] or 0, k[2]))
    for k in (1, 2, 137, 399, 400):
        assert tuple(resampling.kth_key(table, k, pivots)) == order[k - 1]


# ---- prefix trie

def trie_by_hand(turns, family=5, heads=9):
    own = collections.defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + ts[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, ts in sorted(built.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return collections.Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def some_turns(seed, convs=90):
    rng = random.Random(seed)
    openings = [[("user", rng.choice(["hi", "Éh", ""])), ("assistant", "yes")] + [("user", str(k % 3))] * (k % 5) for k in range(6)]
    turns = []
    for c in range(-7, convs):
        ts = rng.choice(openings) + [(rng.choice(["user", None]), rng.choice(["a", "b", None, "long " * 50])) for _ in range(rng.choice([0, 1, 2, 9, 14]))]
        turns += [(c, i if rng.random() < 0.95 else None, r, t) for i, (r, t) in enumerate(ts)]
    turns += turns[:30] + [(None, 1, "user", "lost"), (500, 0, "user", "same")] + [(1000 + i, 0, "user", "same") for i in range(40)]
    rng.shuffle(turns)
    return turns


def conversations(spark, turns):
    return spark.createDataFrame([(*t, b"h", 1, 2, "x") for t in turns],
                                 "conv_id long, turn long, role string, text string, hash binary, depth int, n int, above string")


def found_trie(df, **options):
    return collections.Counter(tuple(r) for r in prefix_trie.prefix_trie(df, **options).collect())


@pytest.mark.parametrize("unit,turns,batch,piece,options", [(1024, 1 << 18, 4096, 4096, {}), (3, 40, 5, 7, {}), (1, 1, 1, 1, {"family": 3, "heads": 4}),
                                                            (2, 9, 2, 50, {"heads": 1})])
def test_trie(spark, unit, turns, batch, piece, options, monkeypatch):
    for name, value in (("UNIT", unit), ("TRIE_TURNS", turns), ("BATCH", batch), ("PIECE", piece)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = some_turns(unit)
    assert found_trie(conversations(spark, rows), **options) == trie_by_hand(rows, **options)


def test_trie_of_a_conversation_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "UNIT", 16)
    rng = random.Random(3)
    rows = [(12, i, "user", rng.choice("ab")) for i in range(900)] + [(10, i, "user", "a") for i in range(4)] + [(c, 0, "user", "z") for c in range(40)]
    rows += [(13, i, r, t) for _, i, r, t in rows[:700]]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hashed = prefix_trie.hashed_turns(conversations(spark, rows), "conv_id", "turn", "role", "text")
        assert prefix_trie.runs(hashed).where("conv_id = 12").select("part").distinct().count() > 2
        assert found_trie(conversations(spark, rows)) == trie_by_hand(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_of_a_hot_opening(spark, force_split):
    rows = [(c, i, "user", "same" if i == 0 else str((c * 7 + i) % 11)) for c in range(0, 600, 5) for i in range(3)]
    assert found_trie(conversations(spark, rows)) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    assert not found_trie(conversations(spark, []))
    assert not found_trie(conversations(spark, [(None, 0, "user", "x")]))
    with pytest.raises(ValueError):
        prefix_trie.prefix_trie(conversations(spark, []), heads=0)


@pytest.mark.parametrize("seed", range(25))
def test_z_fast_trie(seed):
    rng = random.Random(seed)
    start = rng.choice([0, 0, 5])
    words = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 5, 17, 40]))) for _ in range(rng.choice([1, 30, 200]))]
    digest = lambda w: hashlib.md5(w.encode()).digest()
    trie, want = prefix_trie.ZFastTrie(), collections.defaultdict(list)
    for i, w in enumerate(words):
        w = rng.choice(words)[:rng.randint(0, 30)] + w
        for d in range(len(w) + 1):
            want[w[:d]].append(i)
        trie.insert(start, digest(""), b"".join(digest(w[:d + 1]) for d in range(len(w))), b"".join(d.to_bytes(8, "big") for d in range(len(w))), 1, i)
        root = trie.roots[start, digest("")]
        unit = (start, b"".join(digest(w[:d + 1]) for d in range(len(w))), b"")
        assert trie.locate(root, unit, start + len(w))[1] == start + len(w)
    # Every edge is found under the handle at its two-fattest depth, and under no other.
    assert len(trie.handles) == len(trie.top) - len(trie.roots)
    for (_, key), node in trie.handles.items():
        assert key == trie.at(trie.unit[node], prefix_trie.two_fattest(trie.top[node], trie.bottom[node]))
    got = {h: (d, above, size, n, least) for h, d, above, size, n, least in trie.expand()}
    expected = {digest(p): (start + len(p), digest(p[:-1]), len(p) - 1, len(m), m[0]) for p, m in want.items() if p}
    if start == 0:
        expected[digest("")] = (0, None, 0, len(want[""]), 0)
    assert got == expected


def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 60):
            assert prefix_trie.two_fattest(a, b) == max(range(a + 1, b + 1), key=lambda f: f & -f)


# ---- secrets

BASE_PATTERNS = {
    "assign": (re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), lambda m: len(m[2]) >= 8),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(rb"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def base62(value):
    digits = string.digits + string.ascii_uppercase + string.ascii_lowercase
    return "".join(digits[value // 62 ** i % 62] for i in range(5, -1, -1))


def crc_made(prefix, body, off=0):
    return prefix + body + base62((zlib.crc32(body.encode()) + off) % 2 ** 32)


def bech32_made(rng):
    """An encoded key with the checksum that the published description gives: found digit by digit, not by the code under test."""
    letters = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
    data = [rng.randrange(32) for _ in range(52)]
    human = "age-secret-key-"
    values = [ord(c) >> 5 for c in human] + [0] + [ord(c) & 31 for c in human] + data + [0] * 6
    chk = 1
    for v in values:
        b = chk >> 25
        chk = ((chk & 0x1FFFFFF) << 5) ^ v
        for i, g in enumerate([0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3]):
            chk ^= g if (b >> i) & 1 else 0
    chk ^= 1
    return (human + "1" + "".join(letters[d] for d in data + [(chk >> 5 * (5 - i)) & 31 for i in range(6)])).upper()


def base_by_hand(text):
    raw, out = (text or "").encode(), []
    for k, (kind, (pattern, keep)) in enumerate(BASE_PATTERNS.items()):
        out += [(len(raw[:m.start()].decode()), k, kind, len(raw[:m.end()].decode())) for m in pattern.finditer(raw) if keep(m)]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def secret_rows(spark):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    pieces = ["password", "PassWd", "secret", "toKEN", "api_key", "APIKEY", "toKen", "paſſword", "AKIA", "akia", "=", ": ", "'", '"', " ", "é", "日本",
              "deadbeef" * 3, "0123456789abcdef", "ABCDEFGH", "x1+/_.=-", "\n", "AKIAAKIA", "token=token=", "ghp_", "npm_"]
    rows += [(5000 + i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    rows += [(9000, None), (9001, ""), (9002, "token" + " " * 200_000 + "x"), (9003, "0" * 300_000), (9004, "secret=" + "a" * 5000), (9005, "token = abcdefg"),
             (9005, "token = abcdefgh"), (None, "token = abcdefgh"), (9006, "AKIA" + "A" * 11), (9007, "AKIA" + "A" * 12), (9008, "a" * 31), (9009, "token: 12345678 " * 5000)]
    return rows


def test_secrets(spark):
    rows = secret_rows(spark)
    got = collections.Counter((r.doc_id, tuple((s.kind, s.start, s["end"]) for s in r.base)) for r in secret_scan.find_secrets(docs_of(spark, rows)).collect())
    assert got == collections.Counter((i, tuple(base_by_hand(t))) for i, t in rows)


def test_secrets_with_checksums(spark):
    rng = random.Random(8)
    letters = string.ascii_letters + string.digits
    body = lambda: "".join(rng.choice(letters) for _ in range(30))
    good = [crc_made(p, body()) for p in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")] + [bech32_made(rng) for _ in range(5)]
    bad = [crc_made(p, body(), 1) for p in ("ghp_", "npm_")] + [crc_made("ghp_", body()) + "x", crc_made("GHP_", body()), good[-1][:-1], good[-1].lower()]
    bad += [g[:-1] + ("Q" if g[-1] != "Q" else "P") for g in good[-5:]]
    kinds = ["hosting"] * 5 + ["registry"] + ["agekey"] * 5
    rows = [(i, f"é {s}, end") for i, s in enumerate(good + bad)]
    found = {r.doc_id: [(s.kind, s.start, s["end"]) for s in r.spans] for r in secret_scan.find_secrets(docs_of(spark, rows)).collect()}
    for i, s in enumerate(good):
        assert (kinds[i], 2, 2 + len(s)) in found[i]
    for i in range(len(good), len(rows)):
        assert not {k for k, _, _ in found[i]} & {"hosting", "registry", "agekey"}
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs_of(spark, rows + [(900, None), (901, "")])).collect()}
    assert clean[0] == "é [secret], end" and clean[900] is None and clean[901] == ""


def test_secrets_of_nothing(spark):
    assert secret_scan.find_secrets(docs_of(spark, [])).collect() == []
    assert secret_scan.redact(docs_of(spark, [])).collect() == []


def test_own_kinds(spark):
    kind = secret_scan.Kind("door", rb"door[0-9]+", lambda m: len(m[0]) > 5, ("door",))
    (row,) = secret_scan.find_secrets(docs_of(spark, [(1, "door12 door1 xdoor345")]), base=(kind,), added=()).collect()
    assert [(s.start, s["end"]) for s in row.base] == [(0, 6), (14, 21)]


# ---- the registered queries against their SQL

@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_conversation_prefix_trie", "op13_secret_scan"])
def test_registered_form(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    assert [d[0] for d in cur.description] == got.columns
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(cur.fetchall())
