"""HTML extraction and WARC archives."""

import base64
import collections
import gzip
import hashlib
import itertools
import json
import random
import re

import pytest

from loomcat.llm import html_text, warc
from loomcat.llm.common import table

PAGES = "page_id long, url string, html string, text string"


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("<article><h1>A &amp; b</h1><p>One\n  two&nbsp;three<br>four.</p></article>", "A & b\nOne two three four."),
        ("<nav><a href=/>Home</a></nav><article><p>Text.</p><aside>Aside</aside><div class='ad'>Buy</div></article><footer>&copy; x</footer>", "Text."),
        ("<header>Site</header><main><header><h1>T</h1></header><ul><li>a<li>b <b>c</b></ul><form><label>Mail</label></form></main>", "T\na\nb c"),
        ("<article><p>Text <script>var a='<p>no</p>'</script>more</p></article><div id=comments><p>Nice one, a long comment about it all.</p></div>", "Text more"),
        ("<article><p>Cut off in a ta<b", "Cut off in a ta"),
        ("<article><p>x<!-- a comment <p>no --></p><script>never ends <p>no</p>", "x"),
        ("<article><p>&lt;b&gt; &#233;&#x41; &amp &unknown; &am", "<b> éA & &unknown; &am"),
        ("<div class='cookie-consent'>We use cookies</div><div hidden>gone</div><article><div><p>kept</p></div></article>", "kept"),
        ("<body><div><p>Words enough to make a paragraph of a page, and it ends here.</p></div><div><a href=1>one</a> <a href=2>two</a></div></body>", "Words enough to make a paragraph of a page, and it ends here."),
        ("<body><div class='masthead'>Site</div><div class='article'><div class='article-header'><h1>T</h1></div><p>Text of it.</p><div class='share'>Share</div></div></body>", "T\nText of it."),
        ("<main><p>Long words of a paragraph that has a meaning.</p><div><a href=1>One story</a></div><div><a href=2>Two stories</a></div><div><a href=3>Three stories</a></div></main>", "Long words of a paragraph that has a meaning."),
        ("<article></div></p></span><p>stray ends</p></article>", "stray ends"),
    ],
)
def test_main_text(page, wanted):
    assert html_text.main_text(page) == wanted


LONG = "The first measurement was taken in a dry winter, and the second one followed in the rainy spring of the year after. "
P1, P2, P3 = (f"{LONG}{x}" * 1 for x in ("It was repeated twice.", "Nobody had asked for it, but the data were kept.", "All of this is in the tables below."))
#: Pages with their main text, told by hand.
HAND = [
    (f"<div id=page class=has-sidebar><article><h1>Title</h1><p>{P1}</p></article><div class=sidebar><a href=1>Shop</a></div></div>", f"Title\n{P1}"),
    (f'<div class="site with-footer"><main><h1>Title</h1><p>{P1}</p><p>{P2}</p></main></div><footer>Imprint</footer>', f"Title\n{P1}\n{P2}"),
    (f'<article><h1>On law</h1><p>{P1}</p><section class="legal-analysis"><h2>Analysis</h2><p>{P2}</p></section><section class="search-algorithms"><p>{P3}</p></section></article>', f"On law\n{P1}\nAnalysis\n{P2}\n{P3}"),
    (f'<article><p>{P1}</p><div class="related-work"><h2>Related work</h2><p>{P2}</p></div></article>', f"{P1}\nRelated work\n{P2}"),
    (f"<article><p>Press the <button>Start</button> key once, then wait for the light. {P1}</p><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", f"Press the Start key once, then wait for the light. {P1}\nSo x=2 holds."),
    (f"<article><h1>T</h1><p>{P1}</p><p>{P2}</p></article><div class='c'><p>I read this with joy, and my whole family did so too, thank you.</p><p>Me too.</p></div>", f"T\n{P1}\n{P2}"),
    (f"<article><h1>T</h1><p>{P1}</p></article><section><h3>3 Comments</h3><div><b>Ann</b> I read this with joy, and my whole family did so too.</div><div>Thank you!</div></section>", f"T\n{P1}"),
    (f'<main><article><h1>T</h1><p>{P1}</p><p>Yes.</p><p>{P2}</p></article><ol class="comment-list"><li><article class="comment"><p>{P3} I agree.</p></article></li></ol></main>', f"T\n{P1}\nYes.\n{P2}"),
    (f'<div class="layout-sidebar"><div class="nav-menu"><a href=1>Home</a> <a href=2>News</a></div><div id="main-content"><h1>T</h1><p>{P1}</p><ul><li>one</li><li>two</li></ul><p>{P2}</p></div><div class="related-posts"><a href=3>More</a></div></div>', f"T\n{P1}\none\ntwo\n{P2}"),
    (f"<table><tr><td><a href=1>Home</a><br><a href=2>About</a></td><td><h1>T</h1><p>{P1}</p><p>{P2}</p></td></tr></table><p>(c) 2001 by us</p>", f"T\n{P1}\n{P2}"),
    (f"<body><article><h1>T</h1><p>{P1}</p><div class='ad-box'>Buy two lamps and pay for one of them only today.</div><p>{P2}</p><form>Your mail <input> <button>Send</button></form></article></body>", f"T\n{P1}\n{P2}"),
    (f"<header class='site-header'><h1>The Paper</h1><nav>News Sport</nav></header><article><header><h2>T</h2><p>By Ann</p></header><p>{P1}</p><aside>Box</aside></article><footer>(c)</footer>", f"T\nBy Ann\n{P1}"),
    (f"<article><h2>One</h2><p>{P1}</p></article><article><h2>Two</h2><p>{P2}</p></article><div role=complementary><p>Join us now.</p></div>", f"One\n{P1}\nTwo\n{P2}"),
    (f"<article><p>{P1}</p><dl><dt>Term</dt><dd>Its meaning.</dd></dl><table><tr><th>Year</th><td>2001</td></tr></table><pre>x = 1</pre><blockquote>Said so.</blockquote></article>", f"{P1}\nTerm\nIts meaning.\nYear\n2001\nx = 1\nSaid so."),
    (f"<div class='cookie-banner'><p>We use cookies to make this site better for all of its readers.</p></div><div><div><p>{P1}</p><p>{P2}</p></div></div><div class='newsletter-signup'>Get our mail.</div>", f"{P1}\n{P2}"),
]


@pytest.mark.parametrize("k", range(len(HAND)))
def test_pages_told_by_hand(k):
    page, wanted = HAND[k]
    assert html_text.main_text(page) == wanted


def test_the_cut_decides(spark, data):
    """Labels by the classifier alone differ from those of the cut, and the cut's are right on every page."""
    rows = table(spark, data, "pages").collect()
    weights = html_text.learn(table(spark, data, "pages").select("page_id", "html").withColumnRenamed("page_id", "id"))
    alone = both = 0
    for r in rows:
        told = html_text.labelled(r.html, weights)
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.DOTALL)[1]
        lines = [" ".join(html_text.html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert "\n".join(t for t, _, keep in told if keep) == "\n".join(x for x in lines if x)
        alone += sum((cost > 0) != keep for _, cost, keep in told)
        both += len(told)
    assert 0 < alone < both / 10


def test_extract_equals_page_by_page(spark, data):
    """The query's texts are those of the pages one by one, with the weights of the sample's cells counted by hand."""
    df = table(spark, data, "pages")
    counts = sum((html_text.cells(r.html) for r in df.collect()), collections.Counter())
    weights = html_text.fit(counts)
    assert {r.id: r.text for r in html_text.extract(df, sample=10**6).collect()} == {r.page_id: html_text.main_text(r.html, weights) for r in df.collect()}


def test_minimum_cut_equals_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randrange(1, 8)
        excess = [rng.randrange(-9, 10) + rng.random() for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.random() * 6) for _ in range(rng.randrange(12))]
        cost = lambda side: sum(-e if s else 0 for e, s in zip(excess, side, strict=True)) + sum(c for i, j, c in edges if side[i] != side[j])  # noqa: B023, E731
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_text.minimum_cut(excess, edges)) == pytest.approx(best)


def test_articles_of_the_test_pages(spark, data):
    got = {r.id: r for r in html_text.extract(table(spark, data, "pages")).collect()}
    for p in table(spark, data, "pages").collect():
        r = got[p.page_id]
        assert r.n_chars == len(r.text) and "track(" not in r.text and "©" not in r.text
        first = p.html.split("<h1>")[1].split("</h1>")[0]
        assert r.text.startswith(" ".join(html_text.html.unescape(first).split()))


def test_odd_pages(spark):
    rows = [(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "<p>a" * 3, "x"), (2, "u", "<article>" + "<div>" * 3000 + "deep" + "<p>w</p>" * 20_000, "x")]
    got = html_text.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(spark.createDataFrame([], PAGES)).count() == 0


def rows_of_pages():
    rows = [(i, f"https://e.invalid/{i}", f"<p>{i % 7} é</p>" if i % 3 else f"<p>own {i}</p>", "x") for i in range(60)]
    return rows + [(100, None, None, "x"), (90, "a b\r\nX: y", "", "x"), (None, "u", None, "x"), (5, "u", rows[5][2], "x"), (5, "u", "<p>other</p>", "x"), (101, "u", "<p>a\r\n\r\nWARC/1.1\r\n" + "z" * 300_000, "x")]


@pytest.mark.parametrize("roll", [1, 3000, 1 << 28])
def test_archives_round_trip(spark, tmp_path, roll):
    rows = rows_of_pages()
    folder = f"file://{tmp_path}/warc"
    warc.write(spark.createDataFrame(rows, PAGES).repartition(5), folder, roll_bytes=roll)
    got = warc.read(spark, folder).collect()
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert sorted((str(r.id), r.payload_bytes, r.payload_digest) for r in got) == sorted((str(i), len((h or "").encode()), digest(h)) for i, _, h, _ in rows)
    for r in got:
        same = [i for i, _, h, _ in rows if digest(h) == r.payload_digest]
        least = min(i for i in same if i is not None)
        if r.record_type == "revisit":
            assert r.refers_to == least and (r.id != least or same.count(least) > 1)
        else:
            assert r.id == least and r.refers_to is None
    assert sum(r.record_type == "response" for r in got) == len({digest(h) for _, _, h, _ in rows})


def test_archives_are_deterministic_and_whole(spark, tmp_path):
    def files(name):
        folder = f"file://{tmp_path}/{name}"
        warc.write(spark.createDataFrame(rows_of_pages(), PAGES), folder, roll_bytes=2000)
        return {p.name: p.read_bytes() for p in (tmp_path / name).glob("*.warc.gz")}

    one, two = files("one"), files("two")
    assert one == two and len(one) > 3 and not list((tmp_path / "one").glob("*.tmp"))
    named = [json.loads(line) for line in (tmp_path / "one/manifest.json").read_text().splitlines()]
    assert {m["file"]: (m["bytes"], m["sha256"]) for m in named} == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in one.items()}
    ids = [m.get("first_id") for m in sorted(named, key=lambda m: m["file"])]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x)
    member = gzip.decompress(next(iter(one.values())))
    assert member.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_commits_survive_repeats_and_breaks(spark, tmp_path):
    """Another attempt of a task writes under its own names; a commit that broke off is finished, and one that lost a file fails."""
    folder, df = f"file://{tmp_path}/a", spark.createDataFrame(rows_of_pages(), PAGES).coalesce(1)
    warc.write(df, folder, roll_bytes=2000)
    before = {p.name: p.read_bytes() for p in (tmp_path / "a").glob("shard*")}
    (tmp_path / "a/attempts").mkdir()
    files = warc._Files(folder, 0, 1 << 20)
    files.add(1, b"another attempt of the first task")
    files.close()
    assert {p.name: p.read_bytes() for p in (tmp_path / "a").glob("shard*")} == before and list((tmp_path / "a/attempts").glob("*.tmp"))
    rows = [(f"attempts/{n}.x.tmp", n, 1, len(b), hashlib.sha256(b).hexdigest(), 1, 1) for n, b in before.items()]
    first = sorted(before)[0]
    (tmp_path / "a" / first).rename(tmp_path / "a/attempts" / f"{first}.x.tmp")
    (tmp_path / "a/manifest.json").unlink()
    warc.commit(spark.createDataFrame(rows, warc.FILES), folder)
    assert {p.name: p.read_bytes() for p in (tmp_path / "a").glob("shard*")} == before and warc.read(spark, folder).count() == df.count()
    (tmp_path / "a/attempts").mkdir()
    with pytest.raises(FileNotFoundError):
        warc.commit(spark.createDataFrame([("attempts/no.tmp", "no", 1, 1, "", 1, 1)], warc.FILES), folder)


def test_many_rows_without_ids(spark, tmp_path):
    """Rows without an id are spread; each revisits the response of its payload, and record ids stay apart."""
    rows = [(None, f"u{i % 9}", "" if i % 2 else None, "x") for i in range(300)] + [(None, "u", f"own {i % 5}", "x") for i in range(40)] + [(7, "u", "", "x"), (9, "u", "own 1", "x"), (9, "u", "own 1", "x")]
    warc.write(spark.createDataFrame(rows, PAGES).repartition(3), f"file://{tmp_path}/n")
    got = warc.read(spark, f"file://{tmp_path}/n").collect()
    assert collections.Counter((r.id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == collections.Counter({(7, 0, "response", None): 1, (None, 0, "revisit", 7): 300, (9, 5, "response", None): 1, (9, 5, "revisit", 9): 1, (None, 5, "revisit", 9): 8, (None, 5, "response", None): 32})
    ids = [line for p in (tmp_path / "n").glob("shard*") for line in gzip.decompress(p.read_bytes()).decode().splitlines() if line.startswith("WARC-Record-ID")]
    assert len(ids) == len(set(ids)) == len(rows)


def test_damage_is_noticed(spark, tmp_path):
    text = warc.record(1, "u", b"abc", hashlib.sha1(b"abc").digest(), 0, None, False)
    import io

    fields, block = next(warc.records(io.BytesIO(text)))
    assert warc.read_record(fields, block)[2] == 3
    with pytest.raises(ValueError, match="digest"):
        warc.read_record(fields, block[:-1] + b"x")
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(io.BytesIO(text[:-6])))


def test_empty_archive(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    warc.write(spark.createDataFrame([], PAGES), folder)
    assert warc.read(spark, folder).count() == 0
