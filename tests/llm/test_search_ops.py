"""Operators 11 to 13 against brute force, and their edge cases."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from readyspark.llm import hard_negatives as H, spelling, url_filter as U


# ------------------------------------------------------------------ spelling

def brute_variants(docs, every=199):
    counts = Counter()
    for i, text in docs:
        run = ""
        for c in (text or "") + "\n":
            c = c.lower() if "A" <= c <= "Z" else c
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                word = run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run
                counts[word] += len(word) >= 6
                run = ""
    vocab = {w: n for w, n in counts.items() if n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    by_size = {}
    for w in vocab:
        by_size.setdefault(len(w), []).append(w)
    found = {w: [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if near(w, v)] for w in vocab}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-vocab[v], v), default=None)
        if best and vocab[best] >= 5 * vocab[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(found[w]), vocab[form[w]] if w in form else None) for w, n in vocab.items()}


def variant_rows(spark, docs, **more):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, word string, ref string")
    return {tuple(r) for r in spelling.variants(df, **more).collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "Straße", "strasse", "Être", "ÊTREÉÉ"]
    words = []
    for w in base:
        n = rng.choice([5, 6, 25, 30, 130, 800])
        words += [w.upper() if rng.random() < .1 and w.isascii() else w] * n
    words += ["chaine"] * 900 + ["chainee"] * 120 + ["chaineee"] * 15
    rng.shuffle(words)
    docs = [(i, " ,".join(words[i::40])) for i in range(40)] + [(None, " ".join(base)), (3, None), (4, ""), (5, "\n\t "), (1, " ".join(base)), (1, " ".join(base))]
    got = variant_rows(spark, docs)
    assert got == brute_variants(docs) and any(r[2] not in (r[0], r[1]) for r in got)


def test_variants_are_written_in_files_by_their_rows(spark, monkeypatch):
    # not in a file (and a task's folder) for each of many shuffle partitions
    rng, files, write = random.Random(8), {}, spelling.written
    words = ["chaine"] * 900 + ["chainee"] * 120 + ["chaineee"] * 15
    words += ["".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(80)] * 5
    docs = [(i, " ".join(words[i::20])) for i in range(20)]

    def noted(df, kind):
        out = write(df, kind)
        files.setdefault(kind, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(spelling, "written", noted)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert variant_rows(spark, docs) == brute_variants(docs)
        assert files["neighbours"] == [1] and set(files["forms"]) == {1}
        monkeypatch.setattr(spelling, "ROWS_A_FILE", 20)
        assert variant_rows(spark, docs) == brute_variants(docs)
        assert 1 < files["neighbours"][1] <= 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_variants_of_long_words(spark):
    # words about the length from which keys are digests, ties between long neighbours, one very long pair
    rng = random.Random(8)
    long_ = "".join(rng.choices("abcd", k=66))
    words = [long_, long_[:-1], long_[:-2], long_[:40] + "z" + long_[41:], long_[:40] + "y" + long_[41:], long_ + "b", "b" + long_,
             "a" * 63, "a" * 64, "a" * 65, "a" * 66, "a" * 64 + "b"]
    huge = "".join(rng.choices("ab", k=200_000))
    docs = [(1, " ".join(w for k, w in enumerate(words) for _ in range(5 + 30 * (k % 3)))), (2, " ".join(words * 5))]
    assert variant_rows(spark, docs, every=10 ** 12) == brute_variants(docs, 10 ** 12)
    docs = [(1, " ".join([huge] * 30 + [huge[:777] + huge[778:]] * 5 + [huge[:-1] + "c"] * 6))]
    got = {len(r[0]): (r[1] == huge, r[2] == huge, r[3], r[4], r[5]) for r in variant_rows(spark, docs, every=10 ** 12) if r[3] != 6}
    assert got == {200_000: (False, True, 30, 2, None), 199_999: (True, True, 5, 1, 30)}


def test_variants_of_nothing(spark):
    assert variant_rows(spark, []) == set() and variant_rows(spark, [(1, None), (2, "a b c")]) == set()


# ------------------------------------------------------------------ hard negatives

def brute_negatives(rows, every=100):
    rows = {i: ((lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * float(np.float32(v)))) for v in x]) for i, x, lab in rows}
    out = set()
    for a, (lab, x) in rows.items():
        if a % every:
            continue
        s = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in rows.items() if i != a)
        for p, pid, _ in [r for r in s if r[2] == lab][:5]:
            fit = [(n, i) for n, i, other in s if other != lab and 30 * -p <= 100 * -n <= 90 * -p][:10]
            out |= {(a, pid, k + 1, i, -p, -n) for k, (n, i) in enumerate(fit)}
    return out


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, x, lab, 0, 0) for i, x, lab in rows],
                               "vec_id long, embedding array<float>, label int, id int, shard int")
    got = [tuple(r) for r in H.mine(df, **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("shard_rows", [None, 60, 7])
def test_negatives_equal_brute_force(spark, shard_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 9))
    rows = [(i, (centres[i % 6] + .3 * rng.normal(size=9)).tolist(), int(rng.integers(10))) for i in range(400)]
    rows += [(1000 + i, rows[0][1], int(i % 3)) for i in range(40)]  # many equal vectors: ties by id
    rows += [(-100, rows[5][1], 2), (-200, [0.0] * 9, 3), (2001, [-1.0] * 9, 3)]
    assert mined(spark, rows, anchor_every=20, shard_rows=shard_rows) == brute_negatives(rows, 20)


def test_negatives_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=4).tolist(), i % 3) for i in range(101, 160)] + [(100, rng.normal(size=4).tolist(), 1), (200, [1e12, -1e12, 3e11, 1.0], 0)]
    odd = [(None, [1.0] * 4, 1), (300, None, 1), (400, [1.0] * 4, None), (500, [], 1), (600, [1.0, None, 1.0, 1.0], 1),
           (700, [1.0, float("nan"), 1.0, 1.0], 1), (800, [1.0, float("inf"), 1.0, 1.0], 2), (900, [1.0] * 5, 2), good[0], good[-2]]
    small = [r for r in good if r[0] != 200]
    assert mined(spark, small + odd) == brute_negatives(small)
    assert mined(spark, []) == set() and mined(spark, [(1, [1.0], 1)]) == set() and mined(spark, [(100, [1.0], 1)]) == set()


def test_search_stops_early_on_clusters():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(64, 16)) * 400
    x = np.floor(np.repeat(centres, 60, axis=0) + rng.normal(size=(64 * 60, 16)))
    half = [H._centres(x[:, :8], 64), H._centres(x[:, 8:], 64)]
    made = H.MultiIndex(np.arange(len(x)), np.arange(len(x)) % 2, x, half)
    read = []
    made.scores = lambda q, at, real=made.scores: read.append(len(at)) or real(q, at)
    best = made.positives(0, 0, x[0], 5)
    s = (x @ x[0]).astype(int)
    same = sorted((-s[i], i) for i in range(2, len(x), 2))[:5]
    assert best == [(-a, i) for a, i in same] and sum(read) < len(x) / 4


# ------------------------------------------------------------------ url filter

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def brute_url(url, listed):
    if url is None or "://" not in url:
        return "", "", None, "allow", False
    rest = url.split("://", 1)[1]
    host = ""
    while rest and rest[0] not in "/?#":
        host, rest = host + (rest[0].lower() if rest[0].isascii() else rest[0]), rest[1:]
    path = rest.split("?")[0].split("#")[0]
    fit = [r for r in RULES if ("." + host).endswith("." + r[1]) and path.startswith(r[2])]
    rule = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
    labels = host.split(".")
    hit = bool({".".join(labels[i:]) for i in range(len(labels))} & listed) or host + (path or "/") in listed
    return host, path, rule and rule[1] + rule[2], rule[0] if rule else "block" if hit else "allow", hit


@pytest.mark.parametrize("more", [{}, {"local_keys": 0}, {"shard_bits": 256}, {"shard_bits": 256, "local_keys": 0}])
def test_urls_equal_brute_force(spark, more):
    rng = random.Random(2)
    hosts = [f"{rng.choice(['www.', '', 'a.b.'])}h{i % 90}.Example.{rng.choice(['org', 'com', 'net', 'de'])}" for i in range(300)]
    urls = [f"http://{h}{rng.choice(['', '/', '/es/1', '/en/1x?y', '/en/2', '/fr/', '/de/#z', '?q=/es/', '/ES/'])}" for h in hosts]
    urls += [None, "", "no scheme/es/", "://", "x://example.org", "x://example.org/es/", "http://notexample.org/es/", "http://org/", "http://com",
             "http://a..b/", "http://.net/", "http://bad.net/page#x", "http://bad.net/other", "HTTP://Ünï.BAD.net", "x\ny://k.net/a\nb://c"]
    urls += ["http://" + "a." * 300 + "evil.de/", "http://www.evil.de"] + ["http://hot.net/1"] * 50
    listed = {f"h{i}.example.net" for i in range(0, 90, 2)} | {"bad.net/page", "evil.de", "unseen.net", "k.net", "h1.example.de"}
    pages = spark.createDataFrame([(n if n % 50 else None, u, "q", 1) for n, u in enumerate(urls)], "page_id long, url string, host string, h1 int")
    table = spark.createDataFrame([(k,) for k in listed] + [(None,), ("evil.de",)], "key string")
    got = U.judge(pages, RULES, table, **more)
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        (n if n % 50 else None, *brute_url(u, listed)) for n, u in enumerate(urls))


def test_cascade_is_exact_on_its_universe(spark):
    keys = spark.range(40_000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), (F.col("id") % 17 == 0).alias("listed"))
    rows = keys.toArrow()
    h1, h2, listed = (rows[c].to_numpy() for c in ("h1", "h2", "listed"))
    made = [U.build_cascade(keys, n) for n in (0, 10 ** 6)]
    for c in made:
        assert (c.listed(h1, h2) == listed).all() and len(c.levels) > 3
    assert [(b, k) for b, k, _ in made[0].levels] == [(b, k) for b, k, _ in made[1].levels]
    assert sum(b for b, _, _ in made[0].levels) < 12 * listed.sum()


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "key string")
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), RULES, none).count() == 0
    one = U.judge(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), (), none).collect()
    assert [tuple(r) for r in one] == [(1, "a.net", "/", None, "allow", False)]
    long_ = spark.createDataFrame([(1, "http://" + "a." * 500_000 + "evil.de/" + "b/" * 500_000)], "page_id long, url string")
    assert U.judge(long_, RULES, spark.createDataFrame([("evil.de",)], "key string")).first()["verdict"] == "block"
