"""Main text of pages: markup by example, repeated runs against a plain search."""

import random
import re
from html import unescape

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimloom.llm import main_text
from tests.llm.helpers import SF

SCHEMA = "page_id long, url string, html string"


def run(spark, rows):
    return sorted((tuple(r) for r in main_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def expected(rows):
    return sorted(((i, u, t, len(t)) for i, u, t in rows), key=str)


def test_whole_table_against_its_template(spark):
    """All given pages have one article of h1, p, b and br."""
    rows = []
    for r in pq.read_table(f"{SF}/pages.parquet").to_pylist():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S).group(1)
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:h1|p)>", inner)]
        rows.append((r["page_id"], r["url"], "\n".join(p for p in parts if p)))
    assert sorted((tuple(r) for r in main_text.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()), key=str) == expected(rows)


MARKUP = [
    ("<p>One &amp; two&nbsp;three<br>four</p>", "One & two three four"),
    ("<article><p>a <b>b</b> c<p>d</article><p>outside of it</p>", "a b c\nd"),
    ("<body><nav><a href=/>x</a></nav><article><header><h1>T</h1></header><aside>s</aside><p>x&#33;</p><footer>f</footer></article><footer>g</footer>", "T\nx!"),
    ("<article><p>text <span class='ad'>buy</span>goes on</p><form><p>your name</p></form><div class='share-buttons'>tweet</div></article>", "text goes on"),
    ("<article>a</article><section id=comments><article class=comment>c</article></section>", "a"),
    ("<article><p>a</p><!-- <p>no</p> --><script>var t='</p>x';</script><style>p{}</style><p>b</p><div hidden>h</div><div role='alert'>r</div></article>", "a\nb"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table><p>cut &am", "x\ny\n1 2\n3\ncut &am"),
    ("<header>h</header><main><p>long words here</p><p><a href=/>menu</a></p></main><div class='cookie-notice'>c</div>", "long words here"),
    ("plain text\n of  one block", "plain text of one block"), ("", ""), (None, ""), ("<nav>x</nav>", ""), ("<article> </article><p>z</p>", "z"),
    ("<article><p>Straße ünï 漢字 &#x1F600;</p></article>", "Straße ünï 漢字 😀"), ("<p class=ad>x<p>y", "y"), ("<b><p>a</b></p><p>b", "a\nb"), ("</p></div>a", "a"),
]


@pytest.mark.parametrize("html,text", MARKUP)
def test_markup(html, text):
    assert main_text.fenced_text(html) == text


def test_odd_rows(spark):
    rows = [(k, None if k % 3 else f"http://h{k}.org/", h) for k, (h, _) in enumerate(MARKUP)]
    long = "<article><p>" + " ".join(f"w{k}" for k in range(100_000)) + "</p></article>"
    rows += [(None, None, None), (7, "u", long), (7, "u", long), (8, "not a url", "<div>" * 3000 + "deep")]
    texts = [(k, u, t) for (k, u, _), (_, t) in zip(rows, MARKUP)]
    texts += [(None, None, ""), (7, "u", long[12:-14]), (7, "u", long[12:-14]), (8, "not a url", "deep")]
    assert run(spark, rows) == expected(texts)
    assert run(spark, []) == []
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("host", "page", "open", "text", "n_chars", "name", "k")})
    assert sorted((tuple(r) for r in main_text.main_text(df).collect()), key=str) == expected(texts)


def plain(pages, window, least):
    """Every suffix beside every other of its host."""
    out = []
    for i, u, h in pages:
        own = [b for b in main_text.blocks_of(h) if not b[1]]
        streams = [main_text.tokens_of([b[0] for b in main_text.blocks_of(o) if not b[1]]) for _, v, o in pages if v == u and o != h]
        shared = {tuple(s[k:k + window]) for s in streams for k in range(len(s) - window + 1)}
        tokens, text = main_text.tokens_of([b[0] for b in own]), []
        covered = {j for k in range(len(tokens) - window + 1) if tuple(tokens[k:k + window]) in shared for j in range(k, k + window)}
        at = 0
        for block in own:
            words = block[0].split()
            marks = "".join("x" if at + 1 + j in covered else "." for j in range(len(words)))
            at += 1 + len(words)
            if not main_text._loose(block):
                continue
            runs = [words[m.start():m.end()] for m in re.finditer(r"\.+", marks) if m.end() - m.start() >= least or "x" not in marks]
            if runs:
                text.append(" ".join(w for r in runs for w in r))
        out.append((i, u, "\n".join(text)))
    return out


def test_repeated_runs_against_a_plain_search(spark):
    rng = random.Random(3)
    some = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)) for n in (3, 9, 12, 30, 50)]
    pages = []
    for k in range(60):
        host = "hot.org" if k % 3 else f"h{k % 4}.org"
        parts = [" ".join(rng.choice("ijklmnop") * rng.randint(1, 9) for _ in range(rng.randint(1, 40))) for _ in range(4)]
        parts += [rng.choice(some) + " " + parts[0], some[k % 5], rng.choice(some)]
        rng.shuffle(parts)
        pages.append((k, f"https://{host}/", "".join(f"<div>{p}</div>" for p in parts) + f"<nav>{some[3]}</nav>"))
    pages += [(90, "https://twice.org/", pages[0][2]), (91, "https://twice.org/", pages[0][2])]  # a copy alone makes nothing repeat
    found = run(spark, pages)
    assert found == expected(plain(pages, main_text.WINDOW, main_text.RUN))
    whole = expected((i, u, main_text.fenced_text(h)) for i, u, h in pages)
    assert sum(a != b for a, b in zip(found, whole)) > 30 and dict((r[0], r[2]) for r in found)[90] == dict((r[0], r[2]) for r in whole)[90]


def test_a_page_with_an_article_is_evidence_for_one_without(spark):
    menu = " ".join(f"entry{k}" for k in range(20))
    body = " ".join(f"word{k}" for k in range(30))
    rows = [(1, "http://a.org/1", f"<article><p>{body}</p></article><div>{menu}</div>"), (2, "http://a.org/2", f"<div>{menu}</div><div>{body}</div>"),
            (3, "http://b.org/", f"<div>{menu}</div><div>{body}</div>")]
    assert run(spark, rows) == expected([(1, rows[0][1], body), (2, rows[1][1], body), (3, rows[2][1], f"{menu}\n{body}")])


def test_articles_of_a_host_are_put_in_order(spark):
    """Words that other articles of the host repeat stay and are counted; text outside articles and copies of a page make nothing repeat."""
    rng = random.Random(5)
    some = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)) for n in (8, 9, 10, 30, 50)]
    pages = []
    for k in range(50):
        parts = [" ".join(rng.choice("ijklmnop") * rng.randint(1, 9) for _ in range(rng.randint(1, 30))) for _ in range(3)] + [rng.choice(some) for _ in range(k % 3)]
        rng.shuffle(parts)
        host = "hot.org" if k % 3 else f"h{k % 4}.org"
        pages.append((k, f"https://{host}/{k}", "<article>" + "".join(f"<p>{p}</p>" for p in parts) + f"</article><p>{parts[k % 3]} {some[3]}</p>"))
    alone = " ".join(f"only{k}" for k in range(40))
    pages += [(k, "https://twice.org/", f"<article><p>{alone}</p></article><p>{some[4]}</p>") for k in (90, 91)] + [(92, "https://twice.org/", f"<article>x</article><p>{alone}</p>")]
    expect = []
    for i, u, h in pages:
        streams = {o: main_text.tokens_of(main_text.fenced_text(o).split("\n")) for _, v, o in pages if v.split("/")[2] == u.split("/")[2]}
        n = main_text.WINDOW
        shared = {tuple(s[k:k + n]) for o, s in streams.items() if o != h for k in range(len(s) - n + 1)}
        own = streams[h]
        covered = {j for k in range(len(own) - n + 1) if tuple(own[k:k + n]) in shared for j in range(k, k + n)}
        text = main_text.fenced_text(h)
        expect.append((i, u, text, len(text), sum(own[j] != "\n" for j in covered)))
    df = spark.createDataFrame(pages, SCHEMA).repartition(7)
    assert sorted(tuple(r) for r in main_text.judged_pages(df).collect()) == sorted(expect)
    assert sum(r[4] > 0 for r in expect) > 10 and [r[4] for r in expect[-3:]] == [0, 0, 0]


def test_a_menu_inside_articles(spark):
    """Neighbouring links that the host's articles repeat are a menu; a list of one page alone, and a linked title, stay."""
    def links(n, word):
        return "<ul>" + "".join(f"<li><a href=/>{word} {k}</a></li>" for k in range(n)) + "</ul>"

    title = " ".join(f"title{k}" for k in range(12))
    pages = [(1, "http://a.org/1", f"<article><h1><a href=/>{title}</a></h1><p>first text</p>{links(6, 'entry')}</article>"),
             (2, "http://a.org/2", f"<article><h1><a href=/>{title}</a></h1><p>second text</p>{links(6, 'entry')}<p>end</p></article>"),
             (3, "http://a.org/3", f"<article><p>third text</p>{links(6, 'source')}</article>"),
             (4, "http://b.org/4", f"<article><p>fourth text</p>{links(6, 'entry')}</article>"),
             (5, "http://c.org/5", f"<article>{links(6, 'entry')}</article>"), (6, "http://c.org/6", f"<article>{links(6, 'entry')}</article><p>x</p>")]
    lists = {w: "\n".join(f"{w} {k}" for k in range(6)) for w in ("entry", "source")}
    assert run(spark, pages) == expected([(1, pages[0][1], f"{title}\nfirst text"), (2, pages[1][1], f"{title}\nsecond text\nend"), (3, pages[2][1], f"third text\n{lists['source']}"),
                                          (4, pages[3][1], f"fourth text\n{lists['entry']}"), (5, pages[4][1], lists["entry"]), (6, pages[5][1], lists["entry"])])


def test_an_empty_article_is_judged_by_the_host(spark):
    menu, body = (" ".join(f"{w}{k}" for k in range(20)) for w in ("entry", "word"))
    rows = [(1, "http://a.org/1", f"<article> </article><div>{menu}</div><div>{body}</div>"), (2, "http://a.org/2", f"<article><p>x</p></article><div>{menu}</div>")]
    assert run(spark, rows) == expected([(1, rows[0][1], body), (2, rows[1][1], "x")])


def test_copies_in_other_slices(spark):
    """A page that comes again in other slices counts once there too, but learns what its one original learns."""
    word = " ".join(f"word{k}" for k in range(25))
    pages = [(k, f"http://h{k % 2}.org/{k}", f"<article><p>{' '.join(f'own{k}x{j}' for j in range(15))}</p>" + (f"<p>{word}</p>" if k in (0, 1, 2) else "") + "</article>") for k in range(6)]
    again = [(i + 10 * t, u, h) for t in range(5) for i, u, h in pages]
    found = [tuple(r) for r in main_text.judged_pages(spark.createDataFrame(again, SCHEMA).repartition(9)).collect()]
    # pages 0 and 2 are of one host, page 1 is alone on its own
    assert sorted((r[0], r[4]) for r in found) == sorted((i, 25 if i % 10 in (0, 2) else 0) for i, _, _ in again)


def test_entries_count_distinct_pages():
    values, page = np.array([5, 3, 5, 3, 5, 9, 7, 7], "u8"), np.array([1, 1, 2, 1, 2, 3, 1, 2], "u8")
    counts = np.array([1, 1, 1, 1, 1, 0, 1, 0], bool)
    assert [x.tolist() for x in main_text._entries(values, page, counts)] == [[3, 5, 7, 9], [1, 2, 1, 0]]
    assert [x.tolist() for x in main_text._entries(values, page, ~np.zeros(8, bool))] == [[3, 5, 7, 9], [1, 2, 2, 1]]
    assert [len(x) for x in main_text._entries(values[:0], page[:0], counts[:0])] == [0, 0]


def test_pages_are_parsed_and_shuffled_once(spark, monkeypatch):
    """Also where the slices are dealt to more tasks than there are shuffle partitions."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for task in (main_text.TASK, 10_000):
        monkeypatch.setattr(main_text, "TASK", task)
        df = main_text.judged_pages(pages)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan[:plan.index("Initial Plan")]
        assert final.count("MapInArrow _slices(") == 1 and final.count("ReusedExchange [slice") >= 3
