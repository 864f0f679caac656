"""Toxicity (1), mixing (3), chat (4) and html (5) on small tables."""

import hashlib
import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from readyspark.llm import chat, html_extract, mixing, toxicity

RNG = random.Random(11)
VOCAB = ["".join(RNG.choices("abcdefghij", k=6)) for _ in range(400)]


def sentence(extra=""):
    return " ".join(RNG.choices(VOCAB, k=9) + [extra]).strip() + "."


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def labelled():
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        lines = [sentence() for _ in range(8)]
        if bad:
            lines[RNG.randrange(8)] = sentence(RNG.choice(["vilest", "zorgatum", "zorgatis", "zorgatoria"]))
        rows.append((i, " ".join(lines), int(bad)))
    return rows


def test_toxicity_learns_from_documents_and_finds_sentences(spark, labelled):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in labelled], "doc_id long, text string, score string")
    # labels of held-out rows are wrong on purpose: they must not be read
    labels = spark.createDataFrame([(i, 1 - y if held_out(i) else y) for i, _, y in labelled], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, sample=150)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, _, y in labelled if held_out(i) and got[i]["predicted"] != y]
    assert len(wrong) <= 4
    for i, text, y in labelled[:80]:
        if y and got[i]["predicted"]:
            assert any("vilest" in text[s["start"]:s["stop"]] or "zorgat" in text[s["start"]:s["stop"]] for s in got[i]["offending"])
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {i for i in got if not got[i]["predicted"]} | set(wrong) | set(got)


def test_toxicity_of_odd_rows(spark, labelled):
    model = toxicity.fit([(y, t) for _, t, y in labelled])
    long_clean = " ".join(sentence() for _ in range(4000))
    rows = [(1, None), (2, ""), (None, "... !!"), (3, long_clean), (4, "ZORGATIS " * 3000), (4, "ZORGATIS " * 3000)]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == 6 and by[1] == by[2] == by[None] == 0.0 and by[3] < 0.7 <= by[4]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def poisson(u, mean):
    p = c = math.exp(-mean)
    k = 0
    while c <= u and k < 400:
        k += 1
        p *= mean / k
        c += p
    return k


def test_mixing_equals_inverted_poisson(spark):
    rows = [(i, "x" * (50 + i % 7), "hot" if i % 3 else f"s{i % 5}", i) for i in range(900)]
    rows += [(None, "no id", "hot", 0), (None, None, None, 0), (5000, "", "empty", 0), (5001, "lone", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int").withColumnRenamed("copy", "extra")
    rates = {r["src"]: r["rate"] for r in mixing.rates(docs).collect()}
    got = mixing.mix(docs, partitions=5).collect()
    assert rates["hot"] < 1 < rates["s0"] and rates["empty"] == 1.0
    want = {}
    for i, t, s, _ in rows:
        key = str(i) if i is not None else hashlib.md5((t or "").encode()).hexdigest()
        draws = max(1, math.ceil(rates[s] / 32))
        want[key] = sum(poisson(int(hashlib.md5(f"{key}|42|times|{j}".encode()).hexdigest()[:13], 16) / 2 ** 52, rates[s] / draws)
                        for j in range(1, draws + 1))
    have = {}
    for r in got:
        key = str(r["doc_id"]) if r["doc_id"] is not None else hashlib.md5((r["text"] or "").encode()).hexdigest()
        have[key] = have.get(key, 0) + 1
    assert have == {k: n for k, n in want.items() if n}
    keys = [r["mix_key"] for r in got]
    assert keys == sorted(keys)
    chars = {}
    for r in got:
        chars[r["source"]] = chars.get(r["source"], 0) + len(r["text"] or "")
    share = {r["src"]: r["share"] for r in mixing.rates(docs).collect()}
    assert abs(chars["hot"] / sum(chars.values()) - share["hot"]) < 0.06
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_by_given_weights(spark):
    docs = spark.createDataFrame([(i, "y" * 10, "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    rates = {r["src"]: r["rate"] for r in mixing.rates(docs, {"a": 3.0, "b": 1.0}, target_chars=80_000.0).collect()}
    assert rates == {"a": 30.0, "b": 10.0}
    n = mixing.mix(docs, weights={"a": 3.0}, target_chars=800_000.0).groupBy("source").count().collect()
    assert [r["source"] for r in n] == ["a"] and abs(n[0]["count"] - 80_000) < 1500


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|", "|>", "</s>", "[INST]", "\\", "<", "|", ">", "end", "\n", "[", "/", "a", "s", "[/INST]", "<s>"])))
def test_escapes_are_reversible(parts):
    text = "".join(parts)
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)
    formatted = chat.format_turn(text, text)[0] + chat.format_turn("user", text)[0]
    assert chat.parse(formatted) == [(text, text), ("user", text)]


def test_chat_round_trip(spark):
    convs = {1: [("system", "s"), ("user", "hi </s>"), ("assistant", "yo <|end|>\n"), ("user", "more"), ("assistant", "ok\\")],
             2: [("user", "only"), ("user", None)], 3: [("assistant", ""), ("assistant", "x" * 20_000), ("user", "tail")],
             None: [(None, "lost")], 4: [("assistant", "same"), ("assistant", "same")]}
    rows = [(c, t, r, x, "n") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rows[-1] = (4, 0, "assistant", "same", "n")  # a repeated row
    RNG.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example string")
    path = chat.write_examples(table)
    examples = spark.read.parquet(path)
    got = {r["conv_id"]: r for r in chat.digest(examples).collect()}
    for c, turns in convs.items():
        plain = "".join(f"{r or ''}\n{x or ''}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    first = [r for r in examples.collect() if r["conv_id"] == 1]
    assert sorted((r["example"], r["n_turns"], r["target"], r["last"]) for r in first) == [(0, 3, 2, False), (1, 5, 4, True)]
    assert chat.parse(min(first, key=lambda r: r["example"])["text"]) == convs[1][:3]
    assert got[1]["formatted_chars"] == sum(len(r["text"]) for r in first)
    assert chat.digest(spark.read.parquet(chat.write_examples(table.limit(0)))).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">One</a></li><li><a href=/x>Two</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
{open}<h1>Head &amp; title</h1><p>First   para with <a href="#">a link</a>,<b> bold</b>
 text &lt;kept&gt;.<p>Second, never closed<ul><li>point one<li>point two</ul><div class="ad">Buy this now</div>
<p>Last para is long enough to be worth its way over the advert.</p>{close}<section id="comments"><p>A reader writes many words here, as
readers do on pages of this kind</p></section><form><label>Name</label></form><aside><p>Side words</p></aside><footer>Foot words</footer></body></html>"""
TEXT = ("Head & title\nFirst para with a link, bold text <kept>.\nSecond, never closed\npoint one\npoint two\n"
        "Last para is long enough to be worth its way over the advert.")


def test_main_text(spark):
    rows = [(i, PAGE.format(open="<article>", close="</article>"), "u") for i in range(20)]
    rows += [(50, PAGE.format(open='<div id="content">', close="</div>"), "u"), (51, None, "u"), (52, "", "u"), (None, "<p>", "u"),
             (53, "plain words < more", "u"), (53, "plain words < more", "u"), (54, "<p>" + "word " * 100_000 + "</p>", "u")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_extract.extract(pages, html_extract.learn(pages)).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and by[0] == TEXT and by[50] == TEXT
    assert by[51] == by[52] == by[None] == "" and by[53] == "plain words < more" and len(by[54]) == 499_999
    # without a labelled page the priors alone find the region
    assert html_extract.extract(pages.where("page_id = 50"), html_extract.learn(pages.where("page_id >= 50"))).first()["text"] == TEXT
    assert html_extract.extract(pages.limit(0), html_extract.weights_of({})).count() == 0


def test_region_is_the_best_of_all():
    weights = html_extract.weights_of({})
    for _ in range(200):
        parts = [RNG.choice(["<p>", "</p>", "<div>", "</div>", "word", "two words", "<a href=x>", "</a>", "<nav>", "</nav>", "<br>"])
                 for _ in range(RNG.randrange(1, 14))]
        found = list(html_extract.tokens(" ".join(parts)))
        value = [weights.get(html_extract.place_key(k, n, p), weights.get("tag other", -0.05)) * (len(n.split()) if k == "text" else 1)
                 for k, n, p, _ in found]
        best = max([0.0] + [sum(value[i:j]) for i in range(len(value)) for j in range(i + 1, len(value) + 1)])
        text = html_extract.main_text(" ".join(parts), weights)
        assert bool(text) <= (best > 0)
        if best > 0:
            assert any(abs(sum(value[i:j]) - best) < 1e-9 and " ".join(" ".join(n for k, n, p, _ in found[i:j] if k == "text" and p != "out").split())
                       == text.replace("\n", " ") for i in range(len(value)) for j in range(i + 1, len(value) + 1))


@pytest.mark.parametrize("mark", ["div", "article"])
@pytest.mark.parametrize("before, after", [("<div class='content no-sidebar'>", "</div>"), ("<div class='has-toc'>", "</div>"),
                                           ("<form action='/'>", "</form>")])
def test_named_wrapper_of_the_whole_page_keeps_its_article(mark, before, after):
    lines = [" ".join(f"word{k}x{j}" for j in range(40)) for k in range(4)]
    body = "".join(f"<p>{x}</p>" for x in lines)
    menu = "<div class='sidebar'><p>menu words here</p></div><div class='comments'><p>a remark on it</p></div>"
    page = f"<html><body>{before}<{mark}>{body}</{mark}>{menu}{after}</body></html>"
    assert html_extract.main_text(page, html_extract.weights_of({})) == "\n".join(lines)
    inner = f"<html><body><div>{body}</div><div class='comments'>{body.replace('word', 'remark') * 3}</div></body></html>"
    assert html_extract.main_text(inner, html_extract.weights_of({})) == "\n".join(lines)


WORDS = ["\u0020".join(f"{c}{i}" for i in range(40)) for c in "abc"]


def article(inner):
    return (f"<html><body><div class=nav><a href=x>Home</a> <a>About</a></div><article>{inner}</article>"
            f"<div class='comments'><p>{'nice post ' * 20}</p></div><footer>f</footer></body></html>")


@pytest.mark.parametrize("before", ["<svg/>", "<svg><path d=1>", "<svg><title>t</title><text>no</text></svg>", "<math/>", "<object>no</object>",
                                    "<div class=notice>no no</div>", "<p hidden>no</p>", "<!-- <p>no</p> -->", "<a \"></a>"])
def test_text_after_foreign_elements_stays(before):
    blocks = "".join(f"<p>{w}</p>" for w in WORDS)
    assert html_extract.main_text(article(before + blocks), html_extract.weights_of({})).endswith("\n".join(WORDS))


@pytest.mark.parametrize("name", ["id=related-work", "class='search-algorithms'", "class='chapter social-history'", "id=notice-period",
                                  "id='tags-explained'"])
def test_chapters_with_names_of_furniture_stay(name):
    page = article(f"<p>{WORDS[0]}</p><section {name}><p>{WORDS[1]}</p></section><p>{WORDS[2]}</p>")
    assert html_extract.main_text(page, html_extract.weights_of({})) == "\n".join(WORDS)
    gone = article(f"<p>{WORDS[0]}</p><div class='related-posts'><p>{WORDS[1]}</p></div><div class=tags>x y</div><p>{WORDS[2]}</p>")
    assert html_extract.main_text(gone, html_extract.weights_of({})) == WORDS[0] + "\n" + WORDS[2]


def test_names_are_learned(spark):
    """A part that no list knows goes out once labelled pages show it outside their articles."""
    extra = f"<div class='zorpbox'><p>{WORDS[1]}</p></div>"
    pages = [(i, f"<body><article><p>{WORDS[0]}</p></article>{extra * 3}</body>") for i in range(20)]
    pages += [(99, f"<body><div><p>{WORDS[0]}</p>{extra}<p>{WORDS[2]}</p></div></body>")]
    df = spark.createDataFrame(pages, "page_id long, html string")
    by = {r["page_id"]: r["text"] for r in html_extract.extract(df, html_extract.learn(df)).collect()}
    assert by[99] == WORDS[0] + "\n" + WORDS[2]
    assert html_extract.main_text(pages[-1][1], html_extract.weights_of({})) == "\n".join(WORDS)


@pytest.mark.parametrize("bad", ["<b>x", "<a \"x", "<a 'x>\"", "<div class=sidebar>x", "</q>", "<!x", "<svg>", "<td></x>", "<x><td><b>", "<p><li>", "<form>"])
def test_broken_markup_takes_linear_time(bad):
    import time
    start = time.process_time()
    html_extract.main_text(bad * 100_000, html_extract.weights_of({}))
    assert time.process_time() - start < 15  # a second or two; a quadratic walk takes hours


def test_one_letter_changes_no_score(labelled):
    model = toxicity.fit([(y, t) for _, t, y in labelled])
    scorer = toxicity.Scorer(model)
    text = sentence() + " " + sentence("VILEST") + " Straße."
    plain, odd = scorer(text), scorer(text + " \u0130.")
    assert plain[0] > 0.7 and odd[0] == plain[0] and odd[1] == plain[1]
    start, stop, _ = odd[1][0]
    assert "VILEST" in text[start:stop]


def test_scores_equal_a_plain_noisy_or(labelled):
    import re
    model = toxicity.fit([(y, t) for _, t, y in labelled])
    scorer = toxicity.Scorer(model)
    for _, text, _ in labelled[:80]:
        clean = least = 1.0
        for line in re.split("[.!?\n]", text):
            words = {w.lower() for w in re.findall(r"[^\W\d_]+", line)}
            if not words:
                continue
            z = model[""] + sum(model.get(f, 0) for w in words for f in [w] + [w[:k] + "-" for k in (4, 5, 6, 7, 8) if k < len(w)])
            p = 1 / (1 + math.exp(-z))
            clean *= 1 - max(0, p - 0.1) / 0.9
            least *= 1 - p
        assert scorer(text)[0] == pytest.approx(1 - clean, abs=1e-9)
        assert 1 - clean <= 1 - least + 1e-9  # at most the noisy-or that training uses
