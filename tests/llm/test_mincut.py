import itertools
import random
import time

from loamworks.llm import mincut

PAGE = """<html><head><title>No</title><style>x{}</style></head><body><header><h1>Site</h1><a href=x>Home</a></header>
<div class='cookie-notice'>We use cookies.</div><main><h1>T &amp; U</h1><p><b>Hello&nbsp; world.</b> A fine long sentence
about things, <a href=q>with a link</a>.<p>Second.<script>var p="</p>";</script></p>
<aside class=related>Read also that thing here.</aside><ul><li>one</li><li>two</li></ul></main>
<section id=comments><h2>Comments</h2><p>I like this very much. It is good to have such an article, thanks for it.</p></section>
<form>Your mail<input></form><footer>c 2020 All.</footer>"""


def test_a_page():
    assert mincut.main_text(PAGE) == "T & U\nHello world. A fine long sentence about things, with a link.\nSecond.\none\ntwo"


def test_odd_pages():
    assert mincut.main_text("") == ""
    assert mincut.main_text("<nav><a href=x>a</a></nav>") == ""
    assert mincut.main_text("<p>Unclosed <b>bold and a sentence that is long enough to stay. And one more.") == (
        "Unclosed bold and a sentence that is long enough to stay. And one more."
    )
    assert mincut.main_text("<article><p>1 < 2 &lt; 3 and it goes on, as text does.</article>") == "1 < 2 < 3 and it goes on, as text does."
    assert len(mincut.main_text("<article>" + "<p>Some words of a long page." * 20_000).split("\n")) == 20_000


def test_cut_is_minimal():
    r = random.Random(1)
    for _ in range(200):
        n = r.randint(1, 7)
        terminal = [(r.randint(0, 9), r.randint(0, 9)) for _ in range(n)]
        ties = [(i, j, r.randint(0, 5)) for i in range(n) for j in range(i) if r.random() < 0.5]

        def cost(x, terminal=terminal, ties=ties):
            return sum(t if keep else s for keep, (s, t) in zip(x, terminal, strict=True)) + sum(w for i, j, w in ties if x[i] != x[j])

        assert cost(mincut.minimum_cut(terminal, ties)) == min(map(cost, itertools.product([False, True], repeat=n)))


def test_query_shape(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t", 5), (2, None, None, "t", 5), (2, None, None, "t", 5)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(mincut.extract(df).collect(), key=lambda r: r.page_id)
    assert [r.n_chars for r in got] == [len(got[0].text), 0, 0]
    assert mincut.extract(df.limit(0)).count() == 0


def test_the_cut_mends_what_the_classifier_gets_wrong():
    """Short paragraphs between long ones, by their neighbours."""
    long_ = "A sentence that goes on for a while, and then some more, as sentences of an article do. Here is another one of them."
    long_ += " " + long_
    text = [long_, "Why", long_, "Ah", long_]
    page = "<div><div>" + "".join(f"<div>{t}</div>" for t in text) + "</div></div>"
    found = mincut.blocks(page)
    alone = [mincut.log_odds(mincut.features(b), mincut.PRIOR) > 0 for b in found]
    assert alone == [True, False, True, False, True]
    assert mincut.main_text(page) == "\n".join(text)


def test_odd_quotes_leave_no_markup():
    assert mincut.main_text('<article><p title="5" x">Hello there, this is text.</p></article>') == "Hello there, this is text."
    assert mincut.main_text('<article><p>Some words and <a href="x"">a link</a> in them.</p></article>') == "Some words and a link in them."
    assert mincut.main_text("<article><p title='a>b'>It is 5 > 4.</p><p data-x=\"a>b\">And so on.</p></article>") == "It is 5 > 4.\nAnd so on."
    assert mincut.main_text('<article><p>Before the break it ends.</p><p title="never closed') == "Before the break it ends."


def test_hostile_pages_take_time_in_proportion():
    n = 1_000_000
    start = time.perf_counter()
    for part in ("<a ", "<div>x", "<b>", "</b>", "<a x=\"", "<a x='\"", "<p>", "<!--", "<script>", "<b><article>", "&", "<b></i>x", "="):
        mincut.main_text("<p>One.</p>" + part * (n // len(part)))
    mincut.main_text("<div>" * 100_000 + "</i>" * 100_000 + "x</div>" * 100_000)
    assert time.perf_counter() - start < 60


def test_class_words_are_learnt():
    """A word that no list names gets its weight from the sample."""
    body = "<p>A sentence that goes on for a while, as they do. And one more of them, of some length.</p>" * 3
    page = f"<html><article>{body}</article><div class=qqbox>Buy it now</div></html>"
    found = [mincut.features(b) for b in mincut.blocks(page)] * 40
    ties = [(i - 1, i, 0.0) for i in range(1, len(found))]
    weights = mincut.regression(found, mincut.labelled(found, ties, mincut.PRIOR))
    assert weights["word:qqbox"] < -0.2
    assert mincut.main_text(page, weights).count("\n") == 2


def brute_text(page, weights):
    """The labels of least cost of all labellings, by trying them all."""
    found = mincut.blocks(page)
    odds = [mincut.log_odds(mincut.features(b), weights) for b in found]
    ties = mincut.edges(found)

    def cost(x):
        return sum(max(-o, 0) if keep else max(o, 0) for keep, o in zip(x, odds, strict=True)) + sum(w for i, j, w in ties if x[i] != x[j])

    best = min(itertools.product([False, True], repeat=len(found)), key=lambda x: (round(cost(x), 6), sum(x)))
    return "\n".join(b.text for b, keep in zip(found, best, strict=True) if keep)


def test_the_query_against_all_labellings(spark, tmp_path):
    r = random.Random(5)
    words = lambda n: " ".join(r.choice(["alpha", "beta.", "gamma", "delta,", "so"]) for _ in range(n))
    pages = []
    for i in range(40):
        parts = [r.choice([f"<p>{words(r.randint(1, 40))}</p>", f"<div class={r.choice(['ad', 'x', 'text'])}>{words(r.randint(1, 30))}</div>", f"<li><a href=x>{words(3)}</a></li>"]) for _ in range(r.randint(0, 9))]
        pages.append((i, "u", r.choice(["<article>", "<div>", "<nav>"]) + "".join(parts)))
    spark.createDataFrame([*pages, (50, None, None), (50, None, None)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    weights = mincut.fit(spark.read.parquet(str(tmp_path / "pages.parquet")))
    got = sorted((r.page_id, r.text, r.n_chars) for r in mincut.op5_mincut(spark, str(tmp_path)).collect())
    want = [(i, brute_text(p, weights)) for i, _, p in pages] + [(50, "")] * 2
    assert got == sorted((i, t, len(t)) for i, t in want)


def test_nested_class_names_take_time_in_proportion():
    """Every element around a block names another class; the text in the innermost; and one element of very many words."""
    n = 40_000
    start = time.perf_counter()
    page = "".join(f"<div class='w{''.join(chr(97 + int(c)) for c in str(i))}'>x." for i in range(n))
    assert len(mincut.main_text(page, mincut.PRIOR | {"in:good": 0.0}).split()) in (0, n)
    wide = "<div class='" + " ".join(f"{a}{b}{c}" for a in "abcdefghijklm" for b in "abcdefghijklm" for c in "abcdefghijklmnopqrstuvwxyz") + "'>"
    mincut.main_text(wide + "<p>One." * 40_000)
    assert time.perf_counter() - start < 20
    (b,) = mincut.blocks("<div class='one two'><section id=two><p class=three>Text<br>more</p></section></div><i class=four>x</i>")[:1]
    assert b.words == {"one", "two", "three"}


def test_weights_do_not_depend_on_the_order_of_rows_or_on_copies(spark):
    body = "<p>A sentence that goes on for a while, as they do. And one more of them, of some length.</p>" * 3
    kinds = [f"<html><article>{body}</article><div class='{w} {w}z'>Buy it now {k}</div></html>" for k in range(30) for w in ("fffq", "tttt", "ggg")]
    rows = [(i, "u", k) for i, k in enumerate(kinds + kinds[:2] * 3000)]
    schema = "page_id long, url string, html string"
    one = mincut.fit(spark.createDataFrame(rows, schema).repartition(3))
    two = mincut.fit(spark.createDataFrame(rows[::-1], schema).coalesce(1))
    assert one == two and one["word:fffq"] < -0.1
    assert mincut.fit(spark.createDataFrame(rows[: len(kinds)], schema)) == one
    assert mincut.fit(spark.createDataFrame([], schema)) == mincut.PRIOR
