import random
import re
import time
from html import unescape

import numpy as np
import pytest

from terrasift.llm import pages
from terrasift.llm.pages import Page, Tags, decoded, extract_texts, fit_trees, rule_odds, training_variants


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")


@pytest.fixture(scope="module")
def trees(table):
    return fit_trees(table)


def kept(trees, source):
    page = Page(source)
    return page.text(trees.odds(np.array(page.features())).tolist())


def test_whole_table(table, trees):
    """Every page of the table has one article of paragraphs, so plain cuts give its text."""
    sources = {r.page_id: r.html for r in table.collect()}
    got = {r.page_id: r for r in extract_texts(table, trees).collect()}
    assert got.keys() == sources.keys()
    for page_id, source in sources.items():
        body = re.search(r"<article>(.*?)</article>", source, re.S)[1].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(x for x in parts if x)
        assert (got[page_id].text, got[page_id].n_chars) == (want, len(want))


def test_held_out_variants(table, trees):
    """Surroundings and wrappers with other text than the trees were fitted on."""
    sources = [r.html for r in table.orderBy("page_id").limit(40).collect()]
    right = total = 0
    for k, source in enumerate(sources):
        for text in training_variants(source, sources[k - 1], 10_000 + k):
            page = Page(text)
            want = {t for n, t, _ in page.runs if t and page.gold[n]}
            got = set(kept(trees, text).split("\n"))
            right, total = right + 2 * len(got & want), total + len(got) + len(want)
    assert right / total > 0.97


def test_kinds_of_surroundings(trees):
    long = "This is the long text of the article, with commas, and with stops. " * 5
    source = f"""<html><body><header><p>Site name</p></header><div class="cookie-notice"><p>We use cookies, accept them.</p></div>
      <main><h1>Title &amp; more</h1><p>{long}</p><aside><p>See also this, and that.</p></aside><p>{long}</p>
      <form><p>Subscribe to our letter</p></form><section class="comments"><p>I liked it, thanks.</p></section></main>
      <footer><p>All rights reserved.</p></footer></body></html>"""
    assert kept(trees, source).split("\n") == ["Title & more", long.strip(), long.strip()]


def test_decoding_is_hierarchical():
    page = Page("<div><p>a</p><p>b</p></div><p>c</p>")
    assert page.text([1, -9, 5, 3, 2]) == "c"            # a dropped node keeps nothing below
    assert page.text([1, -1, 5, -3, 2]) == "a\nc"         # a good child outweighs a doubtful parent
    assert page.text([-3, -1, -5, -3, 1]) == ""


def test_broken_markup():
    page = Page('<p>one<br>two <b>x<p>three<ul><li>a<li>b</ul>&lt;&#233;&nbsp;z <p title="a>b">q</p><a href="x>y">r<script>var t="</p>";</script>s<!-- no --')
    assert [t for _, t, _ in page.runs if t] == ["one two x", "three", "a", "b", "<é z", "q", "rs"]
    for odd in ("", "<", "<<<>>>", "</p></p>", "<p", "<!--", "<script>", "<p " + "a=\"" * 2000, "<div>" * 3000 + "x", "&#xfffffff; &bogus; &am &#" + "9" * 5000, "<p>" * 3000):
        assert isinstance(Page(odd).text(rule_odds(Page(odd))), str)


@pytest.mark.parametrize("before", [
    "<html><head><title>t</title></head><body>",
    "<html><head><title>t</title><meta charset=utf-8><body>",           # the end of head may be left out
    "<head><title>t</title><link rel=x>",                               # and body as well
    "<title>t</title>",
    "<head><script>for(i=0;i<n;i++){x()}</script></head><body>",
    "<head><script>if(a<b){s='it'}else{t=\"</head>\"}</script><body>",
    "<head><style>a>b{content:'<q \"'}</style></head><body>",
    "<head><title>a <b 'c</title><body>",
    "<body><SCRIPT>x<!--y</Script >",
    "<body><svg><style>a<b'</style><title>x<y</title></svg>",
    "<body><template><template>x</template>y</template>",
    "<body><textarea>a<b \"</textarea>"])
def test_raw_elements_and_open_heads(before):
    page = Page(before + "<p>one</p><script>for(i=0;i<n;i++){y('<p>')}</script><p>two</p>")
    assert [t for _, t, _ in page.runs if t] == ["one", "two"]


PLAIN_TAG = re.compile(  # one pattern, which looks at the rest of the page again for every tag
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>""", re.S)


def test_tags_as_one_pattern_finds_them():
    bits = ["<p>", "</p>", "<a ", "<a \"", "<p x='", "\"", "'", ">", "<", " ", "t", "</", "<!d>", "<!-- c -->", "<!-- ", "<?x ", "<b/>", "<c d=\"e>f\">", "<g'h", "=", "<1>"]
    draw = random.Random(7)
    for _ in range(20_000):
        source = "".join(draw.choices(bits, k=draw.randint(0, 25)))
        want = [(*m.span(), m[1] or m[4] or "", m[2] or m[5] or "", m[3] or m[6] or "") for m in PLAIN_TAG.finditer(source)]
        tags, got = Tags(source), []
        while tag := tags.after(got[-1][1] if got else 0):
            got.append(tag)
        assert got == want, source
    assert [t for _, t, _ in Page("a<!-->b<!--->c").runs] == ["abc"]


@pytest.mark.parametrize("unit", ["<a ", "<a \"", "<a \">\" ", "<a '\">\" ", "<!", "<a<b", "</script ", "<script></script ", "<x>", "<b>", "<h1>", "<p>", "<a><p></a>", "&#9"])
@pytest.mark.parametrize("tail", ["", ">", "\"></p>", "stray", "open"])
def test_time_grows_with_length(unit, tail):
    """A megabyte of each takes a second or a few; where every tag looked at all of the rest it took hours."""
    n = 1_000_000 // len(unit)
    tail = {"stray": "</p>" * n + "</i>" * n, "open": "<b>" * n + "<h2>" * n + "<li>" * n}.get(tail, tail)
    start = time.process_time()
    page = Page((unit * n + tail)[:1_000_000 if len(tail) < 10 else 1_500_000])
    assert isinstance(page.text(rule_odds(page)), str)
    assert time.process_time() - start < 60


def test_numbers_beyond_characters():
    assert decoded("&#" + "9" * 5_000 + ";b&#0000000000065;&#x41;&#128512;") == "\ufffdbAA\U0001f600"


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2), (2, "u", "plain text", 3), (3, "u", "<nav>x</nav><p>y</p>", 4)],
                                 "page_id long, url string, html string, text int")
    got = extract_texts(rows)  # no page marks its article
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, "", 0), (1, "", 0), (2, "plain text", 10), (3, "y", 1)]
    assert extract_texts(rows.limit(0)).count() == 0
