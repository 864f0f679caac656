"""Decontamination (7) and line quality (9): both ways of the former, odd rows."""

import random
import re

import pytest

from readyspark.llm import decontaminate, line_quality

BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "Short Item!"),
         (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, None), (4, "..."), (None, "no id here"),
         (5, "one"), (6, "quote's \\ back")]
DOCS = [(1, "x ALPHA beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (2, "a short-item b short item"),
        (3, None), (4, ""), (5, "clean words only"), (None, "no id here"), (1, "One two"), (7, "one one. ONE"),
        (8, "quote s back Ünï " * 3), (9, "y " * 20_000 + "short item")]


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(doc, bench):
    w, hit, items = words(doc), set(), set()
    for i, t in bench:
        b = words(t)
        m = min(10, len(b))
        for s in range(len(b) - m + 1) if b else ():
            for p in range(len(w) - m + 1):
                if w[p:p + m] == b[s:s + m]:
                    hit |= set(range(p, p + m))
                    items |= {str(i)} - {"None"}
    return len(w), len(hit), sorted(items), bool(hit)


@pytest.mark.parametrize("literals", [20_000, 0])
def test_contamination_equals_brute_force(spark, literals):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in DOCS], "doc_id long, text string, hits int, n_words int")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.contamination(docs, bench, literal_windows=literals).collect()
    key = lambda r: str(r)
    assert sorted(map(tuple, got), key=key) == sorted([(i, *brute(t, BENCH)) for i, t in DOCS], key=key)
    left = decontaminate.drop_contaminated(docs, bench, literal_windows=literals)
    assert left.columns == docs.columns
    assert sorted(r["text"] or "" for r in left.collect()) == ["", "", "clean words only"]
    cut = {(r["doc_id"], r["text"]) for r in decontaminate.remove_spans(docs, bench, literal_windows=literals).collect()}
    assert (1, "x nu") in cut and (2, "a b ") in cut and (5, "clean words only") in cut and (1, "two") in cut


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.contamination(docs, none).collect()] == [(1, 2, 0, [], False)]
    assert decontaminate.contamination(docs.limit(0), none).count() == 0
    assert line_quality.judge(docs.limit(0)).count() == 0


RNG = random.Random(5)
PROSE = "\n".join(" ".join("".join(RNG.choices("abcdefgh", k=5)) for _ in range(15)).capitalize() + "." for _ in range(12))


def test_lines_and_verdicts(spark):
    menu = "Home | About | Products | Contact | Help"
    bars = "\n".join(" | ".join(f"m{9 * i + k}x" for k in range(9)) for i in range(20))  # navigation, no window twice
    rows = [(1, PROSE), (2, PROSE + "\n" + menu + "\nAll rights reserved.\n" + menu), (3, bars),
            (9, "\n".join(" | ".join(random.Random(i).choices(PROSE.split()[:20], k=9)) for i in range(60))),
            (4, None), (5, ""), (6, " \n\t\n "), (7, "again and again " * 100), (8, PROSE.replace("\n", " ")), (None, PROSE), (1, PROSE)]
    docs = spark.createDataFrame([(i, t, "w") for i, t in rows], "doc_id long, text string, cleaned string")
    got = line_quality.judge(docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by[1]["kept"] and by[8]["kept"] and by[None]["kept"]
    assert by[2]["kept"] and by[2]["cleaned"] == PROSE and by[2]["n_dup_lines"] == 1
    assert not by[3]["kept"] and not by[3]["base_failed"] and by[3]["cleaned"] == ""
    assert by[9]["base_failed"] and 100 * by[9]["n_repeat_words"] > 50 * by[9]["n_words"] and not by[9]["kept"]
    assert by[4]["base_failed"] and by[5]["base_failed"] and by[6]["n_words"] == 0 and by[6]["n_dup_lines"] == 0
    assert by[7]["n_repeat_words"] == 300 and by[7]["base_failed"] and not by[7]["kept"]
    assert by[1]["word_chars"] == len(re.sub(r"\s", "", PROSE))


def test_very_long_text_without_repeats(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}." for i in range(60_000)))], "doc_id long, text string")
    row = line_quality.judge(docs).first()
    assert (row["n_words"], row["n_repeat_words"], row["kept"]) == (60_000, 0, True)


@pytest.mark.parametrize("keys", [2_000_000, 3])
def test_many_windows_and_many_items(spark, monkeypatch, keys):
    """More windows than literals hold, one window of very many items; hashes broadcast and not."""
    from readyspark.llm import common
    monkeypatch.setattr(common, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(decontaminate, "LITERAL_BYTES", 20_000)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(300)] + [(1000 + i, "short shared item") for i in range(4000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "a " + items[7][1] + " b"), (2, "short shared item again"), (3, "nothing here"), (4, None), (5, items[9][1][:20])]
    got = {r["doc_id"]: r for r in decontaminate.digest(decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), bench)).collect()}
    assert (got[1]["n_hit"], got[1]["n_items"], got[2]["n_hit"], got[2]["n_items"]) == (12, 1, 3, 4000)
    assert not any(got[i]["contaminated"] for i in (3, 4, 5))
