import html as entities
import random
import re

import numpy as np
import pytest

from wattframe.llm import html_text
from wattframe.llm.common import table
from wattframe.llm.html_text import main_texts, page_blocks, repeated_tokens

SCHEMA = "page_id long, url string, html string, host string, main string, blocks string, marked string, array string, text string"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<nav><a>Menu</a></nav><article><h1>T &amp; t</h1><p>One\n two<p>three</article><footer>f</footer>", "T & t\nOne two\nthree"),
        ("<body class='no-sidebar'><form><main><p>A<br>b</p><div class='comments'><p>me</p></div><p>c</p></main></form>", "A b\nc"),
        ("<article><script>var t='</p>'</script><style>p{}</style><!-- x --><p>a&nbsp;&#33;<b>b</b>c</article>", "a !bc"),
        ("<article><header><h1>Title</h1></header><p>x<aside>see also</aside><p>y<div class='cookie-notice'>ok?</div>", "Title\nx\ny"),
        ("<aside>never closed<article>body</article>", "body"),
        ("<article>cut off in the middle of <p>a para", "cut off in the middle of\na para"),
        ("<div id='share-bar'>s</div><section class='main'><p hidden>h</p><p style='display:none'>n</p><p>seen</p></section>", "seen"),
        ("<article class='comment'>remark</article><main><p>text</p></main>", "text"),
        ("<ARTICLE><P TITLE=\"a>b\">Upper</P></ARTICLE>", "Upper"),
    ],
)
def test_marked_articles(page, text):
    assert page_blocks(page)[0] == text


def test_pages_without_marks():
    main, blocks, marked = page_blocks("lead <b>bold</b><p>next &lt;b&gt;<nav>menu</nav>")
    assert main is None and blocks == ["lead bold", "next <b>", "menu"] and marked == [False, False, True]
    assert page_blocks("") == (None, [], [])


def brute(streams, least, length):
    """Which tokens are in a run of this length that so many distinct pages have."""
    pages = {}
    for s in streams:
        for k in range(len(s)):
            run = tuple(s[k : k + length])
            if len(run) == length or (len(s) < length and k == 0):
                pages.setdefault(run, set()).add(tuple(s))
    out = []
    for s in streams:
        covered = [False] * len(s)
        for k in range(len(s)):
            run = tuple(s[k : k + length])
            if len(pages.get(run, ())) >= least:
                covered[k : k + len(run)] = [True] * len(run)
        out.append(covered)
    return out


def test_suffix_array_finds_what_brute_force_finds():
    import random

    rng = random.Random(5)
    for _ in range(30):
        chrome = [rng.choice("abc") for _ in range(12)]
        streams = [
            chrome[: rng.randrange(13)] + [rng.choice("abcdef") for _ in range(rng.randrange(30))] + chrome[rng.randrange(13) :]
            for _ in range(rng.randrange(1, 12))
        ]
        streams = [s for s in streams if len(s) >= 6 or not s]
        got = repeated_tokens(streams, 3, 6)
        assert [x.tolist() for x in got] == brute(streams, 3, 6)


def test_hosts_lose_what_they_repeat(spark):
    chrome = "Home News Sport Weather Contact us now"
    own = lambda k: " ".join(f"word{k}{c}" for c in "abcdefgh")
    rows = [(k, f"http://one.example/{k}", f"<p>{chrome}</p><p>{own(k)}</p><p>All rights of one example held</p>") for k in range(8)]
    rows += [(100, "http://two.example/", f"<p>{chrome}</p>"), (101, "http://one.example/x", None), (102, None, "<p>alone</p>")]
    pages = spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA).repartition(4)
    got = {r.page_id: (r.text, r.n_chars) for r in main_texts(pages).collect()}
    assert {k: got[k][0] for k in range(8)} == {k: own(k) for k in range(8)}
    assert got[100] == (chrome, len(chrome)) and got[101] == ("", 0) and got[102] == ("alone", 5)


def test_copies_of_a_page_are_one_page(spark):
    rows = [(k, "http://h/", "<p>a story that mirrors tell word by word again</p>") for k in range(9)]
    got = main_texts(spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA)).collect()
    assert {r.text for r in got} == {"a story that mirrors tell word by word again"} and len(got) == 9


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA).repartition(4)


def test_a_notice_on_few_pages_of_a_large_host_goes(spark):
    """4% of the pages have it, dealt to several arrays; copies of one page don't hide it, and a phrase stays."""
    own = lambda k: f"text {k} begins " + " ".join(f"w{k}x{c}" for c in range(20))
    notice = "<p>This offer ends soon so order your copy today</p>"
    phrase = "at the end of the very long day"
    rows = [(k, f"http://h.example/{k}", f"<p>{own(k)} {phrase} {k}</p>{notice if k % 25 == 0 else ''}") for k in range(1100)]
    rows += [(5000 + k, f"http://h.example/c{k}", "<p>the same old page as all its many copies</p>") for k in range(700)]
    got = {r.page_id: r.text for r in main_texts(frame(spark, rows)).collect()}
    assert len(got) == 1800 and all(got[k] == f"{own(k)} {phrase} {k}" for k in range(1100))
    assert {got[5000 + k] for k in range(700)} == {"the same old page as all its many copies"}


def test_runs_add_up_over_the_arrays_of_a_host(spark, monkeypatch):
    """However a host is dealt, its texts are the same; a long run goes from within a block."""
    rng = random.Random(8)
    some = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(n)) for n in (7, 9, 3, 24)]
    rows = []
    for k in range(60):
        blocks = [f"own{k} {rng.random()} of its own"] + rng.sample(some[:3], rng.randrange(3))
        blocks += [f"begin{k} {some[3]} end{k}"] if k % 15 == 0 else []
        rng.shuffle(blocks)
        rows.append((k, "http://h.example/", "".join(f"<p>{b}</p>" for b in blocks)))
    rows += [(100 + k, "http://h.example/", "<p>short</p>") for k in range(5)]
    one = {r.page_id: r.text for r in main_texts(frame(spark, rows)).collect()}
    monkeypatch.setattr(html_text, "PAGES_PER_ARRAY", 3)
    many = {r.page_id: r.text for r in main_texts(frame(spark, rows)).collect()}
    assert many == one and any(f"begin{k} end{k}" in one[k] for k in range(0, 60, 15))
    assert all(some[0] not in t and some[1] not in t for t in one.values())


def articles(seen, of=60, k0=0, host="h.example"):
    """Pages that mark their article; an unmarked notice is in the article of so many."""
    notice = "<div>Our readers pay for all of this so join them today</div>"
    own = lambda k: f"text {k} begins " + " ".join(f"w{k}x{c}" for c in range(40))
    passage = "a passage that quite a few of these articles share word by word"
    inner = lambda k: f"<p>{own(k)}</p>{notice if k < seen else ''}<p>{passage if k % 3 == 0 else own(-1 - k)}</p>"
    rows = [(k0 + k, f"http://{host}/{k}", f"<nav>menu</nav><article>{inner(k)}</article>") for k in range(of)]
    return rows, {k0 + k: f"{own(k)}\n{passage if k % 3 == 0 else own(-1 - k)}" for k in range(of)}


@pytest.mark.parametrize("per_array", [512, 7])
def test_an_unmarked_notice_in_most_articles_of_a_host_goes(spark, monkeypatch, per_array):
    """However a host is dealt; copies count once, shared passages and a notice on fewer articles stay."""
    monkeypatch.setattr(html_text, "PAGES_PER_ARRAY", per_array)
    rows, want = articles(34)
    rows += [(100 + k, "http://h.example/copy", rows[59][2]) for k in range(50)]
    want |= {100 + k: want[59] for k in range(50)}
    rare, texts = articles(30, k0=1000, host="rare.example")
    few, more = articles(9, of=9, k0=2000, host="few.example")
    got = {r.page_id: (r.text, r.n_chars) for r in main_texts(frame(spark, rows + rare + few + [(5000, "http://h.example/", None)])).collect()}
    assert {k: got[k] for k in want} == {k: (t, len(t)) for k, t in want.items()}
    notice = "Our readers pay for all of this so join them today"
    assert all(got[k][0].replace(f"\n{notice}", "") == t for k, t in (texts | more).items())
    assert sum(notice in got[k][0] for k in texts) == 30 and sum(notice in got[k][0] for k in more) == 9
    assert got[5000] == ("", 0) and len(got) == len(rows) + 60 + 9 + 1


@pytest.mark.parametrize("size", [0, 1, 5, 6, 7, 40])
def test_runs_of_one_page_are_those_of_arrays(size):
    tokens = [random.Random(size).choice("abcd") for _ in range(size)]
    array = html_text._Runs([tokens, ["x"] * 9, tokens[:3]], 6)
    hashes, shared = array.hashes()
    whole = max(0, size - 5) if size >= 6 else size
    got = html_text._runs_of_page(np.array([html_text._hash(t) for t in tokens], np.uint64), 6)
    assert got.tolist() == hashes[array.rank[:whole]].tolist() and shared[array.rank[:whole]].all()


def test_copies_of_an_article_with_small_changes_stay_whole(spark):
    text = "".join(f"<p>paragraph {c} of a story that goes on like this for long</p>" for c in "abcd")
    rows = [(k, "http://h/", f"<article><h1>edition {k} of {k} by {k * k}</h1>{text}</article>") for k in range(20)]
    got = {r.page_id: r.text for r in main_texts(frame(spark, rows)).collect()}
    assert all(got[k] == page_blocks(rows[k][2])[0] for k in range(20))


def test_test_pages(spark):
    """Every article, whole, by a plain reading of these pages."""
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    for page in pages.collect():
        body = page.html.split("<article>")[1]
        body = body.split("</article>")[0].split("<footer>")[0]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>", "\n", body).replace("<br>", " "))
        lines = (" ".join(entities.unescape(line).split()) for line in body.split("\n"))
        assert got[page.page_id] == "\n".join(line for line in lines if line)


def test_nothing(spark):
    assert main_texts(spark.createDataFrame([], SCHEMA)).collect() == []
