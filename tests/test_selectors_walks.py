"""Selectors against an independent matcher, listings on defective pages, walks, and greedy batches."""

import random

import pytest

from marisight.operators import chunking, listings, posts, walks
from marisight.sources import feeds, selectors
from marisight.sources.html_nodes import Tree, page_selected

PAGE = """<DIV id=a class="x y"><ul><li>one<li class=b>two<ul><li><a href="/f.pdf">F</a></ul><li>three</ul><p>para<div>in</div>
<table><tr><td>1<td>2<tr><td>3<td><a href=z>4</a></table></DIV><h2>H</h2><p>s1<p>s2"""


def found(selector, page=PAGE):
    return [(r["tag"], r["text"]) for r in page_selected(page, (("q", selector, ()),))]


@pytest.mark.parametrize(
    "selector, want",
    [
        ("li li", ["F"]),
        ("ul > li", ["one", "two F", "F", "three"]),
        ('div#a.x li.b a[href$=".pdf"]', ["F"]),
        ("h2 + p", ["s1"]),
        ("h2 ~ p", ["s1", "s2"]),
        ("td:nth-of-type(2)", ["2", "4"]),
        ("tr td:first-child, a", ["F", "1", "3", "4"]),
        ("[class~=y] > p", ["para"]),
        ("p div", []),
        ("li:last-child", ["F", "three"]),
        ("ul>li+li", ["two F", "three"]),
    ],
)
def test_selectors(selector, want):
    assert [text for _, text in found(selector)] == want


@pytest.mark.parametrize("selector", ["", "a >", "> a", "a,,b", "a[", "a:hover", "a b ,"])
def test_wrong_selectors_are_errors(selector):
    with pytest.raises(ValueError):
        selectors.compiled(selector)


def slowly(nodes, chain):
    """Nodes that match a chain, by going back from its last step."""

    def matches(node, i):
        if not ((chain[i].tag in ("*", node.tag)) and chain[i].test(node)):
            return False
        joint = chain[i].joint
        if not joint:
            return True
        if joint == ">":
            return node.parent is not None and matches(node.parent, i - 1)
        if joint == "+":
            return node.previous is not None and matches(node.previous, i - 1)
        step = (lambda n: n.parent) if joint == " " else (lambda n: n.previous)
        at = step(node)
        while at is not None:
            if matches(at, i - 1):
                return True
            at = step(at)
        return False

    return [n.pos for n in nodes if matches(n, len(chain) - 1)]


def test_random_selectors_on_random_pages():
    rng = random.Random(9)
    for _ in range(60):
        tags = ["div", "p", "li", "ul", "td", "tr", "table", "a", "span"]
        page = "".join(rng.choice([f"<{t} class={rng.choice('abc')}>", f"</{t}>", "x"]) for t in rng.choices(tags, k=80))
        nodes = Tree(page).nodes
        made = {}
        for i in range(12):
            parts = [rng.choice([rng.choice(tags), f".{rng.choice('abc')}", f"{rng.choice(tags)}.{rng.choice('abc')}", "*"]) for _ in range(rng.randrange(1, 4))]
            made[str(i)] = "".join(p + (rng.choice([" ", " > ", "+", " ~ "]) if k < len(parts) - 1 else "") for k, p in enumerate(parts))
        got = selectors.Matcher(made).names(nodes)
        for name, selector in made.items():
            assert [n.pos for n, names in zip(nodes, got) if name in names] == slowly(nodes, selectors.compiled(selector)[0]), selector


def test_many_unclosed_elements_take_linear_time():
    tree = Tree("<div>" * 20_000 + "</span>" * 20_000 + "x" + "<p>" * 20_000)
    assert len(tree.nodes) == 40_000 and tree.text(tree.nodes[0]) == "x"


def test_owners_are_the_nearest():
    rows = page_selected("<ul><li>a<ul><li><a href=1>b</a></ul><a href=2>c</a></ul><a href=3>d</a>", (("item", "li", ()), ("link", "a", ("item",))))
    owners = {r["text"]: dict(r["owners"]) for r in rows if r["name"] == "link"}
    inner = next(r["pos"] for r in rows if r["name"] == "item" and r["text"] == "b")
    outer = next(r["pos"] for r in rows if r["name"] == "item" and r["text"] != "b")
    assert owners == {"b": {"item": inner}, "c": {"item": outer}, "d": {}}


def test_rules_fall_back_in_order(spark):
    pages = spark.createDataFrame(
        [
            (1, "mcmc", "https://h/l", '<div class="article-list-box"><a href="/first">x</a><div class="article-list-content"><h4>none</h4><a class="btn" href="/f.pdf">PDF</a></div><div class="date">3 Mac 2024</div></div>'),
            (2, "mof", "https://h/l", '<div class="item-page"><a href="/berita/1">abc</a><a href="/arkib3/2">abcdef</a></div><a href="/berita/9">elsewhere</a>'),
            (3, "moe", "https://h/l", '<table id="example"><tbody><tr><td><a href="/a"></a></td><td>3 Mac 2024</td></tr><tr><td>no link</td><td>x</td></tr></tbody></table>'),
            (4, "rmp", "https://h/l", '<div class="sfnewsItem"><a data-sf-field="Title" href="javascript:x">no</a><a data-sf-field="Title" href="/n">yes</a><div class="sfnewsMetaInfo">on 3 Mac 2024</div></div>'),
            (5, "unknown", "https://h/l", "<article><h2><a href=/x>x</a></h2></article>"),
            (6, "moh", "https://h/l", None),
        ],
        "page_id long, site string, url string, html string",
    )
    got = {(r.page_id, r.title, r.link, r.published_at) for r in listings.listings_by(pages, listings.SITES, "site").collect()}
    assert got == {(1, "x", "https://h/first", "2024-03-03"), (2, "abcdef", "https://h/arkib3/2", ""), (3, "Untitled", "https://h/a", "2024-03-03"), (4, "yes", "https://h/n", "2024-03-03")}


def test_items_of_a_tree(spark):
    xml = '<tree><item id="a" text="A"><item id="b" text="B &amp; C"><userdata name="myurl">loadResult("/d/DR-03022025.pdf",1)</userdata></item></item><item id="c" text="/no.pdf"/></tree>'
    answers = spark.createDataFrame([("", '<item id="p" text=""/><item id="" text=""/>'), ("p", '<item id="q"/>'), ("q", '<item id="r"/>'), ("r", xml), ("x", xml)], "id string, xml string")
    got = {(r.id, r.item, r.text, r.address) for r in feeds.tree_items(answers).where("id = 'r'").collect()}
    assert got == {("r", "a", "A", ""), ("r", "b", "B & C", "/d/DR-03022025.pdf"), ("r", "c", "/no.pdf", "")}
    assert [(r.parent, r.link, r.title, r.published_at) for r in feeds.tree_walk(answers, "https://h").collect()] == [("r", "https://h/d/DR-03022025.pdf", "B & C", "2025-02-03")]


def test_chains_go_round_and_end(spark):
    nexts = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(20)] + [("a", "b"), ("b", "a")], "url string, next_url string")
    starts = spark.createDataFrame([(1, "p0"), (2, "a"), (3, "p18"), (4, "none")], "n int, url string")
    got = sorted((r.n, r.step, r.url) for r in walks.chains(starts, nexts, 7).collect())
    assert got == sorted([(1, i, f"p{i}") for i in range(7)] + [(2, i, "ab"[i % 2]) for i in range(7)] + [(3, 0, "p18"), (3, 1, "p19"), (3, 2, "p20"), (4, 0, "none")])


def test_batches_never_exceed_their_limit(spark):
    rows = [("d", i, "x" * n) for i, n in enumerate((6, 6, 6, 4, 12, 1))] + [(None, 0, "y" * 9), (None, 1, "y"), (None, 2, None), ("e", 0, "")]
    got = {(r.doc_id, r.chunk_index): r.embed_batch for r in chunking.embed_batches(spark.createDataFrame(rows, "doc_id string, chunk_index int, chunk_text string"), most_chars=10).collect()}
    assert [got["d", i] for i in range(6)] == [0, 1, 2, 2, 3, 4] and [got[None, i] for i in range(3)] == [0, 0, 0] and got["e", 0] == 0


def test_series_answers_whatever_the_order_of_the_table(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F

    from marisight.plans.walk_queries import series_answers

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_orderdate", F.date_trunc("year", "o_orderdate"))  # many of one day
    got = []
    for name, order in (("up", F.asc), ("down", F.desc)):
        orders.coalesce(1).sortWithinPartitions(order("o_orderkey")).write.parquet(f"file://{tmp_path}/{name}/orders.parquet")
        got.append(sorted(map(tuple, series_answers(spark, f"file://{tmp_path}/{name}").collect())))
    assert got[0] == got[1] and got[0]


def test_pages_of_one_file_are_parsed_by_many_tasks(spark):
    from pyspark.sql import functions as F

    from marisight.sources.html_nodes import selected

    pages = spark.range(0, 400, 1, 1).select(F.col("id").alias("page_id"), F.concat(F.lit("<a>"), F.col("id").cast("string"), F.lit("</a>")).alias("html"))
    found = selected(pages, {"a": ("a", ())}).select("page_id", "text", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in found}) >= 4
    assert sorted((r.page_id, r.text) for r in found) == [(i, str(i)) for i in range(400)]


ODD = ("<p class=a>x", "</p>", "<DIV ID='b' a>", "</div >", "<br/>", "<img src=x/>", "<a href='/q?a=1&amp;b'>", "</a>", "t &lt; u", "a < b", "<!-- <p> -->", "<!-- c -->", "<!DOCTYPE x>", "<![CDATA[ k ]]>", "<title>A &amp; <b>", "</title>", "<script>if(a<b){'</p>'}</script>", "<style></style>", "</ x>", "<li>", "<3", "<!-- open")


def test_plain_tags_are_read_as_the_library_reads_them():
    from html.parser import HTMLParser

    from marisight.sources.html_nodes import Scanner

    def noted(kind):
        class Noting(kind):
            def start(self, tag, attrs):
                self.seen.append((tag, attrs))

            def handle_starttag(self, tag, attrs):
                self.start(tag, {k: v or "" for k, v in attrs})

            def handle_endtag(self, tag):
                self.seen.append("/" + tag)

            def handle_data(self, data):
                self.seen.append((data,))

            def unknown_decl(self, data):
                self.seen.append("!" + data)

        made = Noting() if kind is Scanner else Noting(convert_charrefs=True)
        made.seen = []
        return made

    rng = random.Random(4)
    for _ in range(3000):
        page = "".join(rng.choices(ODD[: rng.choice((12, 21, len(ODD)))], k=rng.randrange(12)))
        library, own = noted(HTMLParser), noted(Scanner)
        library.feed(page)
        library.close()
        assert len(list(own.read(page))) >= 0 and own.seen == library.seen, page


def test_a_large_page_is_given_in_parts():
    """A page's nodes leave as they end, so what is held doesn't grow with the page."""
    from marisight.sources import html_nodes

    wanted = (("item", "li", ()), ("link", "a[href]", ("item",)))
    page = "<ul>" + "".join(f"<li><a href=/{i}>{i}</a>" for i in range(5000)) + "</ul>"
    parts, held = [], 0
    matcher, owning, _ = html_nodes._matcher(wanted)
    reading = html_nodes.Selection(matcher, owning)
    for part in reading.taken(page, 100):
        held = max(held, len(reading.texts))
        parts.append(len(part))
    assert sum(parts) == 10_000 and max(parts) <= 102 and held <= 2
    assert [(r["pos"], r["text"]) for r in page_selected(page, wanted) if r["name"] == "link"] == [(2 * i + 2, str(i)) for i in range(5000)]


def test_each_extractor_reads_a_page_once(spark):
    pages = spark.createDataFrame([(1, "https://h/l", "<li>x</li>")], "page_id long, url string, html string")
    once = (listings.labelled_files(pages), listings.targets(pages, "button", "a"), listings.headed_links(pages), walks.numbered_next(pages), walks.questions(pages), posts.attached(pages))
    for found in once:
        assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_a_crawl_makes_its_links_once(spark):
    from pyspark.sql import functions as F

    from marisight.operators.links import crawl

    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def after(n):
        made.add(1)
        return n + 1

    edges = spark.range(5).select(F.col("id").alias("url"), after.asNondeterministic()("id").alias("link"))
    got = crawl(spark.createDataFrame([(0,)], "url long"), edges).collect()
    assert sorted((r.url, r.level) for r in got) == [(i, i) for i in range(6)] and made.value == 5


def test_chunks_of_many_documents_leave_in_parts(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(chunking, "CHARS_AT_ONCE", 50)  # read where the function is made
    blocks = spark.createDataFrame([(d, i, f"h{i // 2}", f"text {d} {i}", "paragraph") for d in range(40) for i in range(4)], "doc_id long, block_idx int, section_heading string, text string, block_type string")
    got = chunking.chunks(blocks).orderBy("doc_id", "chunk_index").collect()
    assert [(r.doc_id, r.chunk_index, r.chunk_text) for r in got] == [(d, i, f"text {d} {2 * i}\n\ntext {d} {2 * i + 1}") for d in range(40) for i in range(2)]


def test_plain_and_other_items_read_alike(spark):
    plain = "<item><title> T </title><link>/a</link><pubDate>d</pubDate></item>"
    inner = "<item><image><title>inner</title></image><title>T</title><link>/a</link></item>"
    items = [plain, plain.replace("<title>", "<title x='1'>"), plain.replace(" T ", "<![CDATA[T]]>"), inner, "<item><title></title><link>/a&amp;b</link></item>", "<item></item>"]
    got = feeds.rss_items(spark.createDataFrame([("<rss>" + "\n".join(items) + "</rss>",)], "xml string")).collect()
    assert [(r.title, r.link, r.pub_date) for r in got] == [("T", "/a", "d")] * 3 + [("T", "/a", ""), ("Untitled", "/a&b", ""), ("Untitled", "", "")]


def test_addresses_from_the_root(spark):
    from urllib.parse import urljoin

    from marisight.functions import urls
    from pyspark.sql import functions as F

    hrefs = ["/o/1.pdf", "/", "/a/./b", "/a/../b", "/a/..", "/.x/b", "/q?c=/../1", "/p#/./x", "/a//b", "//other/x", "/q?a=1&page=2"]
    rows = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", urls.absolute(F.col("h"), F.lit("https://h.example/c/5?x#y")).alias("u")).collect()
    assert {r.h: r.u for r in rows} == {h: urljoin("https://h.example/c/5?x#y", h) for h in hrefs}


def test_one_reading_finds_the_next_page_of_either_kind(spark):
    from pyspark.sql import functions as F

    from marisight.functions import urls
    from marisight.operators.walks import next_href, numbered_next
    from marisight.sources.html_nodes import page_values

    item = lambda n, more="": f"<li class='page-item{more}'><a href='/p{n}'>{n}</a></li>"
    made = [
        "", "<p>no links</p>", "<a href='/1'>one</a><a href='/n'>NEXT</a><a rel=next href='/later'>x</a>", "<link rel='next' href='/l'><a class='next' href='/m'>2</a>", "<a class=next>2</a><a href='/q'> &rsaquo; </a>",
        "<div class='the-pagination'><div class='alignleft'><a href='/0'>old</a></div><div class='alignright'><a href='/2'>on</a></div></div>", item(1) + item(2, " active") + item(3), item(3) + item(2, " active") + item(3, " disabled"),
        item(1, " active") + "<li class='page-item next'><a href='#'>n</a></li><li class='page-item next'><a href=' /m '>n</a></li>" + item(2), item(9) + item(9, " active"), item("x", " active") + item(2), item(1, " active") + item(2) + "<a href='/z'>Seterusnya</a>",
        "<a title='a>b' href='/no'>x</a><a title=\"<\" class=\"x next\" href='/t'>x</a>", "<a href='/a&amp;b'>&raquo;</a>", "a < b <a href='/s' rel='next'>", "<a rel='next'>x</a>" + item(1, " active") + item(2),
    ]
    pages = spark.createDataFrame([(f"http://h/{i}", page) for i, page in enumerate(made)], "url string, html string")
    marked = listings.next_page(pages.withColumn("page_id", F.col("url")), (*listings.NEXT, "div[class*=pagination] div[class*=alignright] a[href]")).withColumnRenamed("page_id", "url")
    want = {(r.url, r.next_url) for r in marked.unionByName(numbered_next(pages).join(marked, "url", "left_anti")).collect()}
    found = page_values(pages, next_href, "numbered boolean, href string", ("url",)).select("url", urls.absolute(F.col("href"), F.col("url")).alias("next_url"))
    assert {(r.url, r.next_url) for r in found.collect()} == want and len(want) == 12


def test_feed_files_are_written_line_by_line(spark, sf_dir, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.readwriter import DataFrameWriter

    from marisight.plans import walk_queries

    longest, text = [], DataFrameWriter.text

    def noted(writer, path, *more, **named):
        longest.append(writer._df.agg(F.max(F.length("value"))).first()[0])
        return text(writer, path, *more, **named)

    monkeypatch.setattr(DataFrameWriter, "text", noted)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert len(walk_queries.feed_files(spark, sf_dir).collect()) == orders.count()
    assert max(longest) < 500  # no row holds a file
    walk_queries._feed_folder(orders, str(tmp_path / "feeds"), 100)
    assert len(longest) == 2 and max(longest) < 500
    written = {f.parent.name: f.read_text().splitlines() for f in tmp_path.glob("feeds/file=*/part-*")}
    assert len(written) == 5 * -(-orders.count() // 100) + 1 and written.pop("file=broken")[0].endswith("<link>x")
    assert all(lines[0].startswith("<?xml") and lines[-1] == "</channel></rss>" and all(x.startswith("<item>") for x in lines[1:-1]) for lines in written.values())
    got = [r.link for r in feeds.feed_files(spark, str(tmp_path / "feeds")).collect()]
    assert sorted(got) == sorted(f"https://x.example/{r.o_orderkey}" for r in orders.select("o_orderkey").collect())
