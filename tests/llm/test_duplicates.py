"""Near-duplicates (10), components, repeated passages (6) and the pipeline."""

import random
import re

import numpy as np
import pytest

from readyspark.llm import common, near_dup, passages
from readyspark.llm.components import components

RNG = random.Random(23)
VOCAB = ["".join(RNG.choices("abcdefghijklm", k=RNG.randrange(2, 9))) for _ in range(3000)]


def prose(n, rng=RNG):
    return rng.choices(VOCAB, k=n)


def edited(words, share, rng=RNG):
    return [rng.choice(VOCAB) if rng.random() < share else w for w in words]


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t:
                both = len(s & t)
                if 100 * both >= 75 * (len(s) + len(t) - both):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    return sorted(((i, len(s), root(i) if i is not None else None, i is None or root(i) == i) for i, s in sets), key=str)


def groups():
    rows, i = [], 0
    for _ in range(40):  # groups of copies, from a few to many, some at the threshold
        base = prose(RNG.randrange(3, 120))
        for _ in range(RNG.choice([1, 2, 3, 12])):
            rows.append((i, " ".join(edited(base, RNG.choice([0, 0.01, 0.02, 0.03])))))
            i += 1
    base = prose(200)
    rows += [(i + k, " ".join(edited(base, 0.012))) for k in range(150)]
    line = prose(30)
    rows += [(1000 + k, " ".join(line + prose(25))) for k in range(80)]  # a shared line, otherwise apart
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "One Two"), (2004, "one\ttwo"), (2005, "ONE two three"),
             (None, "one two"), (None, None), (0, rows[0][1]), (2006, " ".join(prose(30_000)))]
    rows.append((2007, rows[-1][1] + " more"))
    RNG.shuffle(rows)
    return rows


@pytest.mark.parametrize("node", [256, 8])
def test_groups_equal_brute_force(spark, monkeypatch, node):
    monkeypatch.setattr(near_dup, "NODE", node)
    rows = groups()
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, kept string")
    got = near_dup.similar_groups(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    if node == 8:
        kept = near_dup.keep_one(docs).collect()
        want = [i for i, _, _, k in brute(rows) if k]
        assert sorted((r["doc_id"] for r in kept), key=str) == sorted(set(want) - {None}, key=str) + [None, None]


def changed(words, n, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"w{rng.getrandbits(40)}"
    return out


def test_star_with_a_late_centre_and_pairs_in_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "NODE", 16)
    monkeypatch.setattr(near_dup, "TILE", 128, raising=False)
    rng = random.Random(31)
    centre = [f"c{k}" for k in range(300)]
    rows = [(i, " ".join(changed(centre, 7, rng))) for i in range(900)] + [(900, " ".join(centre))]
    template = [f"t{k}" for k in range(236)]
    for i in range(2000, 2500, 2):  # pairs of 0.8 in a crowd of about 0.65
        own = template + [f"p{i}-{k}" for k in range(64)]
        other = own[:-32] + [f"q{i}-{k}" for k in range(32)]
        rows += [(i, " ".join(own)), (i + 1, " ".join(other))]
    got = dict(near_dup.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", "component_id").collect())
    star = [got[i] for i in range(901)]
    assert star.count(got[900]) >= 0.93 * 901
    assert all(got[i] in (i, i - i % 2) for i in range(2000, 2500))
    assert sum(got[i + 1] == i for i in range(2000, 2500, 2)) >= 0.93 * 250


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.similar_groups(docs).count() == 0 and near_dup.keep_one(docs).count() == 0
    assert passages.repeated_passages(docs).count() == 0


@pytest.mark.parametrize("small", [200_000, 10])
def test_components_of_a_long_path_and_a_star(spark, monkeypatch, small):
    from readyspark.llm import components as module
    monkeypatch.setattr(module, "SMALL", small)
    links = [(k, k + 1) for k in range(100, 300)] + [(0, k) for k in range(1, 90)] + [(5, 5), (None, 4), (900, 901), (901, 900)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 301)} == {100} and {got[k] for k in range(90)} == {0}
    assert got[900] == got[901] == 900 and len(got) == 201 + 90 + 2


def test_word_hashes_are_of_folded_words():
    def h(t):
        return common.word_hashes(np.frombuffer(t.encode(), np.uint8)).tolist()
    assert h("  Ab\tcd\n\nÉé averylongwordindeed ") == h("ab CD Éé AVERYLONGWORDINDEED")
    assert h("É") != h("é") and h("") == h(" \x0b") == [] and len(set(h("a aa aaa aaaaaaaa aaaaaaaaa a\0 a\0\0"))) == 7


def test_best_chain_equals_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 8)
        anchors = sorted({(rng.randrange(60), rng.randrange(60), rng.randrange(1, 9)) for _ in range(n)})

        def best(order):
            top = 0.0
            for k, (x, y, w) in enumerate(order):
                score = [float(w)]
                for j in range(k):
                    u, v, z = order[j]
                    if u + z <= x and v + z <= y:
                        score.append(w + memo[j] - passages.GAP_COST * (x - u - z + y - v - z))
                memo.append(max(score))
                top = max(top, memo[-1])
            return top

        memo = []
        found = passages.chains(anchors)
        assert sorted(a for c in found for a in c) == anchors
        chain = found[0]
        value = chain[0][2]
        for (x, y, w), (u, v, z) in zip(chain, chain[1:]):
            assert x + w <= u and y + w <= v
            value += z - passages.GAP_COST * (u - x - w + v - y - w)
        assert abs(value - best(anchors)) < 1e-9


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row[-1]
    rng = random.Random(6)
    for n in [9] * 200 + [120] * 30:
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(0, n))] for _ in range(2))
        if n > 9 and rng.random() < 0.5:
            b = [x for x in a if rng.random() > 0.1]
        x, y, want = np.array(a, np.int64), np.array(b, np.int64), plain(a, b)
        assert passages.edits(x, y) == want
        got = passages.edits(x, y, 10)
        assert got == want if want <= 10 else got > 10


def test_reach_of_long_runs():
    a = np.ones(1_000_000, np.uint32)
    assert passages.reach(a, a) == (1_000_000, 0) and passages.reach(a[:0], a) == (0, 0)
    for k in (250, 251, 255, 256, 700_000):
        b = a.copy()
        b[k] = 2
        assert passages.reach(a, b) == (1_000_000, 1)
    assert passages.reach(a[:300], np.concatenate([a[:200], 2 * a[:100]])) == (200, 0)


def test_endless_repeats_and_wide_gaps(spark):
    rng = random.Random(3)
    p, q = prose(150, rng), prose(150, rng)
    wide = [f"w{i}" for i in range(201)]
    other = list(wide)
    other[60], other[140] = "x", "y"
    rows = [(1, "a " * 300_000), (2, "a " * 300_001), (3, "b c " * 50_000), (4, "x " + "b c " * 50_001),
            (5, " ".join(p + wide + q)), (6, " ".join(p + other + q))]
    got = {r["doc_id"] + r["owner_id"]: r for r in passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {3, 7, 11} and got[3]["n_words"] >= 300_000 and got[7]["n_words"] >= 100_000
    assert got[11]["n_words"] == 501 and abs(got[11]["similarity"] - 499 / 501) < 1e-4


def test_planted_passages(spark):
    rng = random.Random(8)
    exact, fuzzy, short = prose(60, rng), prose(120, rng), prose(30, rng)
    rows, planted = [], {}
    for i in range(60):
        words = prose(rng.randrange(80, 300), rng)
        at = rng.randrange(len(words))
        if i % 4 == 0:
            words[at:at] = exact
            planted[i] = (at, at + 60)
        elif i % 4 == 1:
            part = edited(fuzzy, 0.04, rng)
            words[at:at] = part
            planted[i] = (at, at + 120)
        elif i % 4 == 2:
            words[at:at] = short
        rows.append((i, " ".join(words)))
    rows += [(100, rows[3][1]), (101, rows[3][1].upper()), (102, None), (103, ""), (104, "a few words"), (105, "a few words"),
             (None, rows[3][1]), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    found = passages.repeated_passages(docs)
    got = found.collect()
    touched = {r["doc_id"] for r in got} | {r["owner_id"] for r in got}
    assert touched == set(planted) | {3, 100, 101}
    for kind in (0, 1):  # all but the owner of each passage are reported, near their place
        mine = {r["doc_id"]: r for r in got if r["doc_id"] in planted and r["doc_id"] % 4 == kind}
        assert len(mine) == 14
        for i, r in mine.items():
            assert abs(r["start"] - planted[i][0]) <= 12 and abs(r["stop"] - planted[i][1]) <= 12, (i, r, planted[i])
            assert r["similarity"] >= 0.75 and r["n_words"] >= 50
    assert {(r["doc_id"], r["owner_id"], r["n_words"]) for r in got if r["owner_id"] == 3} == {
        (100, 3, len(rows[3][1].split())), (101, 3, len(rows[3][1].split()))}
    cut = {r["doc_id"]: r["text"] for r in passages.cut_passages(docs.where("doc_id IS NOT NULL"), found).collect()}
    assert cut[100] == "" and cut[2] == rows[2][1] and cut[102] is None
    i, r = next((i, r) for i, r in ((r["doc_id"], r) for r in got) if i in planted)
    words = rows[i][1].split()
    assert cut[i].split() == words[:r["start"]] + words[r["stop"]:]


def test_fuzzy_passages_in_other_contexts(spark):
    kinds, share = ((60, 3), (60, 9), (60, 12), (100, 10), (100, 20), (100, 24), (200, 45)), 0.9
    rng = random.Random(12)
    rows, key = [], 0
    for words, wrong in kinds:
        for _ in range(60):
            passage = [f"p{rng.getrandbits(40)}" for _ in range(words)]
            for part in (passage, changed(passage, wrong, rng)):
                context = [f"c{rng.getrandbits(40)}" for _ in range(160)]
                rows.append((key, " ".join(context[:80] + part + context[80:])))
                key += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {min(r["doc_id"], r["owner_id"]) for r in passages.repeated_passages(docs).collect()}
    found = [sum(i in got for i in range(120 * k, 120 * k + 120, 2)) for k in range(len(kinds))]
    assert all(f >= share * 60 for f in found), dict(zip(kinds, found))


def test_reaches_equal_reach():
    rng = np.random.default_rng(5)
    a = rng.integers(1, 200, (300, passages.CONTEXT)).astype(np.uint8)
    b = np.where(rng.random(a.shape) < rng.random((300, 1)) * 0.6, rng.integers(200, 250, a.shape), a).astype(np.uint8)
    for x, y, got in zip(a, b, passages.reaches(a, b).tolist()):
        assert got in (passages.reach(x, y)[0], passages.CONTEXT)


def test_pipeline_equals_its_parts(spark):
    """The stages' decisions, recomputed plainly from the stages' own inputs."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline as C
    from readyspark.llm import toxicity
    from readyspark.llm.common import table
    from tests.conftest import SF0001
    from tests.llm.test_native_rules import brute as leaks

    docs = table(spark, SF0001, "documents")
    rows = [tuple(r) for r in docs.collect()]
    model = toxicity.train(docs, table(spark, SF0001, "labels"))
    scorer = toxicity.Scorer(model)
    stage = [r for r in rows if scorer(r[1] or "")[0] < toxicity.THRESHOLD]
    kept = {i for i, _, _, k in brute([(r[0], r[1]) for r in stage]) if k}
    stage = [r for r in stage if r[0] in kept]
    bench = [tuple(r) for r in table(spark, SF0001, "benchmark").collect()]
    stage = [r for r in stage if not leaks(r[1], bench)[3]]
    assert 0 < len(stage) < len(rows)
    from readyspark.llm import mixing
    given = spark.createDataFrame(stage, docs.schema)
    times = {r["doc_id"]: r["_times"] for r in mixing.repetitions(given, seed=C.SEED).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, []
    for r in sorted(stage):
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for _ in range(times[r[0]]):
            want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    got = C.run(spark, SF0001).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
    names = docs.columns
    at = docs
    for _, f in C.STAGES[:-1]:
        at = f(spark, at, SF0001)
        assert at.columns == names
