import random
import re

from stintflow.llm import pages

from . import cases


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_longest_common_subsequence():
    pick = random.Random(2)
    for _ in range(300):
        a, b = ([pick.randint(0, 5) for _ in range(pick.randint(0, 12))] for _ in range(2))
        places = pages.common(a, b)
        rest = iter(b)
        assert len(places) == lcs(a, b) and all(a[k] in rest for k in places)


def test_articles_of_the_given_pages(spark):
    import html
    table = spark.read.parquet(f"{cases.SMALL}/pages.parquet")
    got = {r.page_id: r for r in pages.extract(table).collect()}
    for r in table.collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article.replace("<br>", " "))]
        assert got[r.page_id].text == "\n".join(x for x in lines if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_unwanted_parts():
    page = """<html><head><title>T</title></head><body><div class="ad">Buy</div><header><h1>Site</h1></header><div id="cookie-notice">We use</div><nav>Menu</nav><main><article>
    <header><h1>Title &amp; more</h1></header><p>One <a href=x>two</a>  three<script>x("</p>")</script><aside>side</aside><div class="comments"><article><p>first!</article></div><pre>a
 b</pre><form><label>Mail</label></form><ul><li>i1<li>i2</ul><!-- gone --></article></main><section class="comments"><p>nice</section><footer>f</footer>"""
    assert pages.blocks(page)[0] == ["Title & more", "One two three", "a b", "i1", "i2"]
    assert pages.blocks('<div class="ad">x<article><p>text')[0] == ["text"]
    assert pages.blocks("<div>a &lt;b&gt;</div><p class=lead>q<p>r")[0] == ["a <b>", "q", "r"]
    assert pages.blocks(None)[0] == pages.blocks("")[0] == []


def test_markup_without_end_takes_linear_time():
    for page in ('<a "' * 50_000, "<" * 100_000, "<div>" * 20_000, "<p>x" * 20_000, "<!" * 50_000, "<script" * 20_000):
        pages.blocks(page)


def rows():
    site = lambda n, body: f"<body><div>Home of things</div><div>{body}</div><p>Imprint and terms {'' if n else 'x'}</p></body>"
    return [(n, f"http://h{n % 2}.org/a/{n}?q=1", site(1, f"own text of page {n} " * 3)) for n in range(20)] + [
        (50, None, None), (51, "http://lonely.org/x", site(1, "only page here")), (52, "no url", ""), (53, "http://copy.org/a", site(1, "same")), (54, "http://copy.org/b", site(1, "same"))]


def test_lines_shared_with_the_neighbour_go(spark):
    table = spark.createDataFrame(rows(), "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "'clash' AS host", "'clash' AS path", "0 AS deleted").coalesce(1)
    got = {r.page_id: r.text for r in pages.extract(table).collect()}
    assert all(got[n] == " ".join((f"own text of page {n} " * 3).split()) for n in range(20))
    assert got[50] == got[52] == "" and got[51] == "Home of things\nonly page here\nImprint and terms"
    assert got[53] == got[54] == "Home of things\nsame\nImprint and terms"
    assert pages.extract(table.limit(0)).collect() == []


def texts(spark, rows, parts=1):
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    return {r.page_id: r.text for r in pages.extract(table).collect()}


def plain(body):
    return f"<body><div>Home of many things and of all their makers</div><div>{body}</div><p>Imprint, terms and everything else that is said everywhere</p></body>"


def test_copies_are_compared_with_the_nearest_other_page(spark):
    rows = [(n, f"http://h.org/a/{n}", plain("one")) for n in range(3)] + [(3, "http://h.org/a/3", plain("another")), (4, "http://h.org/b", plain("one"))]
    assert texts(spark, rows) == {0: "one", 1: "one", 2: "one", 3: "another", 4: "one"}


def test_the_number_of_partitions_changes_nothing(spark):
    rows = [(n, f"http://h{n // 7}.org/a/{n:02}", plain(f"text {n // 3 % 3 if n % 2 else n}")) for n in range(40)]
    rows += [(100 + n, f"http://m.org/{n:02}", f"<main><p>You are here: home</p><p>Long and own words number {n // 2} of many</main>") for n in range(14)]
    was, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for count in ("1", "5", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", count)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found.append(texts(spark, rows, 3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] == found[2]
    assert all("Imprint" not in text and "here" not in text for text in found[0].values())


def test_template_lines_in_a_page_wide_main_go_and_shared_sentences_stay(spark):
    page = lambda n: f"<main><p>You are here: home</p><p>Own words of page {n}, which are many and long</p>{'<p>A sentence of two</p>' if n in (3, 4) else ''}<p>Note: closed today</main>"
    got = texts(spark, [(n, f"http://m.org/{n}", page(n)) for n in range(8)])
    assert got == {n: f"Own words of page {n}, which are many and long" + ("\nA sentence of two" if n in (3, 4) else "") for n in range(8)}
    few = texts(spark, [(n, f"http://m.org/{n}", page(n)) for n in range(3)])
    assert all(text.startswith("You are here") for text in few.values())


def test_versions_of_an_article_do_not_delete_it(spark):
    rows = [(n, f"http://v.org/{n}", f"<article><p>{'The same long story. ' * 9}</p><p>Version {n}</article>") for n in range(9)]
    assert all(text.startswith("The same long story.") for text in texts(spark, rows).values())


def test_linked_blocks_are_compared(spark):
    rows = [(n, f"http://l.org/{n}", f"<div><a href=/>Home and all the rest</a></div><p>Body {n}</p><p><a href=x>Source of page {n}</a></p>") for n in range(4)]
    assert texts(spark, rows) == {n: f"Body {n}\nSource of page {n}" for n in range(4)}


def text_of(page):
    return pages.blocks(page)[0]


def test_names_raise_a_doubt_only():
    assert text_of('<div class="site has-sidebar"><article><p>Words of the article</article></div>') == ["Words of the article"]
    assert text_of('<div class="sidebar wide"><article><p>Words of the article</article></div>') == ["Words of the article"]
    assert text_of('<main class="content no-sidebar"><p>Words</main>') == ["Words"]
    assert text_of('<form id="aspnet"><input type=hidden><div><article><p>Words</article></div></form>') == ["Words"]
    assert text_of('<article><div class="entry-header"><h1>Headline</h1></div><p>Words</article>') == ["Headline", "Words"]
    assert text_of('<article><p>We <span class="banner">really</span> mean it.</article>') == ["We really mean it."]
    assert text_of('<article><p>Words of it<p><span class="ad">Buy <b>now</b></span><p>and more</article>') == ["Words of it", "and more"]
    assert text_of('<article><p>Words<div class="reader-feedback"><p>first!</div><div class="comments"><article><p>No. ' + "x " * 500 + "</article></div></article>") == ["Words"]
    assert text_of('<section class="comments"><article><p>first!</article></section><article><p>Words</article>') == ["Words"]
    assert text_of('<div class="page-with-banner promo"><p>' + "Most of the page. " * 9 + '</div><div class="promo"><p>Buy</div>') == [("Most of the page. " * 9).strip()]
    assert text_of("<p>Some words here<form><p>No controls</form><form><input><p>Name</form>") == ["Some words here", "No controls"]
    assert text_of("<p>Some words here<form><select><option>a</select><p>Name</form>") == ["Some words here"]


def test_tags_with_many_or_long_attributes():
    many = " ".join(f'a{k}="v"' for k in range(150))
    long = f'data-x="{"<b> y " * 2_000}"'
    for attributes in (many, long, f"{many} {long}", "title=Bob's", f"data-y='{'x' * 5000}<'"):
        assert text_of(f'<article><div {attributes}>text</div><p {attributes} class="comments">no</article>') == ["text"], attributes[:60]


def test_deep_and_wide_pages_take_linear_time():
    import time
    for page in ('<div class="ad">x' * 40_000, "<form><input>x" * 40_000, '<a x="' * 60_000, "<a x='\">" * 40_000, "<article><p>x" * 40_000, '<span class="ad">x' * 40_000, '<a "<a\' ' * 40_000):
        start = time.time()
        pages.blocks(page)
        assert time.time() - start < 20, page[:30]


def test_long_pages_are_compared_in_linear_memory(monkeypatch):
    pick = random.Random(4)
    monkeypatch.setattr(pages, "DIRECT_BITS", 40)
    for _ in range(200):
        a, b = ([pick.randint(0, 6) for _ in range(pick.randint(0, 30))] for _ in range(2))
        places = pages.common(a, b)
        rest = iter(b)
        assert len(places) == lcs(a, b) and all(a[k] in rest for k in places) and places == sorted(set(places))
    monkeypatch.undo()
    a = list(range(30_000))
    b = [k if k % 3 else -k for k in a]
    assert pages.common(a, b) == [k for k in a if k % 3 or not k]


def brute(rows):
    """The rules of the module with plain lists: rows (page_id, host, path, lines, marks an article), in order of host and path."""
    def subsequence(a, b):
        return [k for k, x in enumerate(a) if x in b]  # lines occur once a page and in the same order everywhere
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    out = {}
    for at, (key, host, path, lines, marked) in enumerate(rows):
        def others(order):
            seen, found = {tuple(lines)}, []
            for r in order:
                if r[1] == host and tuple(r[3]) not in seen:
                    seen.add(tuple(r[3]))
                    found.append(r)
            return found
        before, after = others(rows[:at][::-1])[:pages.WITNESSES], others(rows[at + 1:])[:pages.WITNESSES]
        gone = set()
        if not marked and (before or after):
            other = max(before[:1] + after[:1], key=lambda r: len(__import__("os").path.commonprefix([r[2], path])))
            gone = set(subsequence(lines, other[3]))
        elif marked:
            seen, near = set(), []
            for k in range(pages.WITNESSES):
                for r in before[k:k + 1] + after[k:k + 1]:
                    if tuple(r[3]) not in seen:
                        seen.add(tuple(r[3]))
                        near.append(r)
            size = lambda x: sum(map(len, x))
            true = [r for r in near if 2 * size([lines[k] for k in subsequence(lines, r[3])]) <= max(size(lines), size(r[3]))][:pages.WITNESSES]
            if len(true) >= pages.FEWEST:
                gone = set.intersection(*[set(subsequence(lines, r[3])) for r in true])
        out[key] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_whole_operator_against_brute_force(spark):
    pick = random.Random(11)
    rows = []
    for k in range(160):
        host, marked = f"h{k % 4}.org", k % 4 > 1
        template = [f"Menu of {host}", f"Section {pick.randrange(2)} of {host}"]
        own = [f"Own line {k if pick.random() < 0.9 else 7} {n} " + "word " * pick.randint(1, 20) for n in range(pick.randint(1, 4))]
        lines = [" ".join(x.split()) for x in [template[0], *own, template[1]]]
        if k % 16 == 12 and k > 16:
            lines = rows[k - 16][3]
        rows.append((k, host, f"/{pick.randrange(5)}/{k:03d}", lines, marked))
    table = [(k, f"https://{host}{path}?q", (("<article>" if marked else "") + "".join(f"<p>{x}</p>" for x in lines) + ("</article>" if marked else "")), "x") for k, host, path, lines, marked in rows]
    want = brute(rows)
    assert len({len(want[k].split("\n")) - len(lines) for k, _, _, lines, _ in rows}) > 1
    for parts in (1, 7):
        df = spark.createDataFrame(table, "page_id long, url string, html string, row string").repartition(parts)
        assert {r.page_id: r.text for r in pages.extract(df).collect()} == want
