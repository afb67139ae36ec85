"""The operators on small cases, against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from shelfscan.llm import bpe, cascade, components as components_module, jaccard_join, langid, packing, quality_gam, substring_dedup, token_counts, topk, wrapper
from shelfscan.llm.chunks import chunks
from shelfscan.llm.components import components
from shelfscan.llm.tables import checkpointed

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Nulls, empty and white texts, repeated rows, one very long text, odd characters.
ODD = [None, "", " \n\t", "a", "a", "\x00b", "Ünï 漢字 🎉", "  two  spaces ", "x " * 30_000, "1234 $$$ ###", " \x85"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, "no id", None, None, None), (3, "a", "en", "s", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.001')}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def words(text):
    return WORD.findall(text or "")


# main text of pages


def test_article_without_the_rest():
    page = """<html><head><title>T</title></head><body><header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div id="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>One<br>two <b>bold</b>
    <p>Next&nbsp;one</p><div class="ad">Buy</div><form>Mail <input></form><script>var t="</p>";</script><ul><li>x<li>y</ul>
    <section class="comments"><p>nice post</p></section></article><aside>More</aside><footer>&copy; me</footer></body></html>"""
    assert wrapper.main_text(page) == "Head & line\nOne two bold\nNext one\nx\ny"


def test_names_never_drop_the_article():
    body = "<h1>Head</h1><p>All of the story is told here</p>"
    rest = '<div class="ad">Buy</div><div id="cookie-notice">We use cookies</div>'
    for page in (
        '<div class="content no-sidebar"><article>{}</article></div>', '<div id="page" class="has-sidebar">{}</div>',
        '<article class="post comments-open">{}</article>', '<article id="notice-of-meeting">{}</article>',
        '<article class="notice">{}</article>', '<div class="widget"><main>{}</main></div>', '<div class="sidebar">{}</div>',
        '<main><div class="notice">{}</div></main>', '<form id="aspnetForm" action="/"><div>{}</div></form>', '<form>{}</form>',
        '<main><article class="post">{}<article class="comment">nice</article></article></main>',
    ):
        html = f"<html><body class=search>{rest}{page.format(body)}</body></html>"
        assert wrapper.main_text(html) == "Head\nAll of the story is told here", page


def test_copies_are_no_template(spark):
    plain = "<body><div>Welcome</div><article><h1>H {0}</h1><p>Text {0}</p></article></body>"
    copy = "<body><div>Welcome</div><article><h1>One</h1><p>Two</p><blockquote>Three</blockquote><p>Four</p></article></body>"
    story = "<article><h1>Head</h1><p>The whole story</p><div>Seen {0} times</div></article>"
    bare = "<body><h1>Head</h1><div>{1}</div><h2>Seen {0}</h2></body>"
    long = "The whole story. " * 30
    rows = [*(("a", plain.format(i)) for i in range(9)), *[("a", copy)] * 5, *(("b", story.format(i)) for i in range(5))]
    rows += [*(("c", bare.format(i, long)) for i in range(5)), *[("d", copy.replace("article", "div"))] * 4]
    rows += [("d", "<body><div>Welcome</div><p>Lone</p></body>")]
    rows = [(i, f"http://{h}.example/", page) for i, (h, page) in enumerate(rows)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce(pages)).collect()}
    whole = [f"H {i}\nText {i}" for i in range(9)] + ["One\nTwo\nThree\nFour"] * 5
    whole += [f"Head\nThe whole story\nSeen {i} times" for i in range(5)] + [f"Head\n{long.strip()}\nSeen {i}" for i in range(5)]
    whole += ["Welcome\nOne\nTwo\nThree\nFour"] * 4 + ["Welcome\nLone"]
    assert [got[i] for i in range(len(rows))] == whole


def wrapper_of(pages):
    """The wrapper of pages, by the plain rule: equal ones once, one after the other."""
    trees = {wrapper._page(t): t for t in map(wrapper._fold, map(wrapper.parse, pages))}
    out = None
    for tree in trees.values():
        out = wrapper._merged(out, wrapper._slots(tree)) if out else wrapper._slots(tree)
    return wrapper._read(wrapper._written(out))


def test_slots_count_all_different_pages_in_any_order(spark):
    pages = [f"<body><div>Same</div><p>{i % 150}</p>{'<h2>x</h2>' * (i % 5 == 0)}</body>" for i in range(300)]
    found = wrapper_of(pages)
    assert found.listed() == wrapper_of(pages[::-1]).listed()
    assert found.pages == 150 and [c.pages for c in found.children[0].children] == [150, 150, 30]
    rows = [(i, "http://h.example/", page) for i, page in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(7)
    assert [r.wrapper for r in wrapper.induce(table).collect()] == [wrapper._written(found)]


def test_template_equals_a_plain_count(spark):
    blocks = {"h1": "Title {0}", "h2": "Seen by all of our readers", "p": "Text {0}", "pre": "On some pages", "div": "Call {1}"}
    pages = []
    for i in range(24):
        has = [t for k, t in enumerate(blocks) if t in ("h1", "p") or (i + k) % (2 + k) != 0]
        pages.append("<body>" + "".join(f"<{t}>{blocks[t].format(i, i % 2)}</{t}>" for t in has) + "</body>")
    found = wrapper_of(pages)
    texts = {t: [re.findall(f"<{t}>(.*?)</{t}>", p) for p in pages] for t in blocks}
    for i, page in enumerate(pages):
        left = []
        for tag in blocks:
            held = [x[0] for x in texts[tag] if x]
            constant = len(set(held)) == 1 and 2 * len(held) > len(pages)
            if texts[tag][i] and (not constant or tag == "h2"):  # a heading stays before content
                left += texts[tag][i]
        assert wrapper.main_text(page, found) == "\n".join(left)


def test_matches_equal_a_plain_table():
    chance = random.Random(5)

    def tree(levels):
        below = [tree(levels - 1) for _ in range(chance.randrange(5))] if levels else []
        return wrapper.Slot(chance.choice("abc"), below, 1, 0)

    def plain(a, b):
        if a.label != b.label:
            return 0
        rows = [[0] * (len(b.children) + 1)]
        for x in a.children:
            row = [0]
            for j, y in enumerate(b.children):
                row.append(max(rows[-1][j + 1], row[j], rows[-1][j] + plain(x, y)))
            rows.append(row)
        return 1 + rows[-1][-1]

    cells = wrapper.CELLS
    for n in range(300):
        a, b = (wrapper.Slot("r", [tree(2) for _ in range(chance.randrange(7))], 1, 0) for _ in "ab")
        assert wrapper._match(a, b, {}) == plain(a, b)
        try:
            wrapper.CELLS = 4 if n % 2 else cells
            pairs = wrapper._aligned(a.children, b.children)
        finally:
            wrapper.CELLS = cells
        assert [x for x, _ in pairs if x] == a.children and [y for _, y in pairs if y] == b.children
        if [x.label for x in a.children] != [y.label for y in b.children]:
            assert 1 + sum(plain(x, y) for x, y in pairs if x and y) == plain(a, b)


def test_blocks_are_matched_whatever_their_number():
    def section(i, *more):
        return wrapper.Slot("section", [*(wrapper.Slot(f"h{i // 4**k % 4}", [], 1, 0) for k in range(5)), *more], 1, 0)

    for n in (20, 600):
        left = [section(i) for i in range(n)]
        right = [section(i, wrapper.Slot("p", [], 1, 0)) for i in range(1, n)]
        assert wrapper._aligned(left, right) == [(left[0], None), *zip(left[1:], right, strict=True)]


def test_no_bound_changes_which_blocks_are_paired(monkeypatch):
    chance = random.Random(8)

    def tree(levels):
        below = [tree(levels - 1) for _ in range(chance.randrange(5))] if levels else []
        return wrapper.Slot(chance.choice("abc"), below, 1, 0)

    for _ in range(150):
        a, b = ([tree(chance.randrange(1, 4)) for _ in range(chance.randrange(12))] for _ in "ab")
        found = []
        for few, cells, pairs in ((10**9, 10**9, 10**9), (32, 1 << 22, 1 << 18), (0, 4, 2), (1, 40, 2), (0, 10**9, 1)):
            for name, most in (("FEW", few), ("CELLS", cells), ("PAIRS", pairs)):
                monkeypatch.setattr(wrapper, name, most, raising=False)
            found.append([(id(x), id(y)) for x, y in wrapper._aligned(a, b)])
        assert all(pairs == found[0] for pairs in found)


def test_fixed_titles_of_articles_stay():
    recipe = (
        "<h1>Cake {0}</h1><p>How we have baked cake number {0} all these years</p><h2>Ingredients</h2><p>Flour and eggs {0}</p>"
        "<p>Good luck</p><h2>Method</h2><pre>See <b>below</b></pre><p>Bake it for {0} minutes or more</p>"
    )
    after = "<h2>Newsletter</h2><pre>Sign up</pre>"
    for page in ("<body><article>{}</article></body>", "<body><div>Cakes of the world</div><div>{}</div></body>"):
        pages = [page.format(recipe.format(i) + after) for i in range(9)]
        found = wrapper_of(pages)
        marked = "article" in page
        want = "Cake 3\nHow we have baked cake number 3 all these years\nIngredients\nFlour and eggs 3\nGood luck\nMethod\n"
        assert wrapper.main_text(pages[3], found) == want + "See below\n" * marked + "Bake it for 3 minutes or more"


def test_formulas_and_other_things_within_a_line():
    line = (
        "<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be <svg><g/><text>no</text></svg> one"
        "<script>x</script> or <button>Press</button>two</p>"
    )
    assert wrapper.main_text(line) == "Let x=1 be one or two"


def test_headlines_references_and_comments():
    head = "<body><div id=main><header><h1>The headline</h1></header><p>Body text</p></div></body>"
    assert wrapper.main_text(head) == "The headline\nBody text"
    site = "<body><header><h1>Site</h1></header><div><header><h1>Site</h1><ul><li>Home</ul></header><p>Body text</p></div></body>"
    assert wrapper.main_text(site) == "Body text"
    cited = "<body><div id=c><p>An intro of quite a few words</p><ul><li><a href=x>Smith 2001, On cakes</a></li></ul></div></body>"
    assert wrapper.main_text(cited) == "An intro of quite a few words\nSmith 2001, On cakes"
    menu = "<body><div><ul><li><a href=x>Home</a></li></ul><p>Story {0} of quite a few words</p><ul><li><a>Next {0}</a></ul></div></body>"
    pages = [menu.format(i) for i in range(5)]
    assert wrapper.main_text(pages[2], wrapper_of(pages)) == "Story 2 of quite a few words"
    notes = '<article><p>Story</p><div class="post-comments">nice</div><div class="author-newsletter-box">send</div></article>'
    assert wrapper.main_text(notes) == "Story"


def test_deep_and_long_pages():
    for n in (900, 100_000):
        deep = "".join(f"<div>t{i}" for i in range(n)) + "".join(f"</div>e{i}" for i in range(n))
        assert wrapper.main_text(deep).split("\n") == [f"t{i}" for i in range(n)] + [f"e{i}" for i in range(n)]
    hidden = "<div>" * 300 + "a<nav><div>menu</div></nav>b<div class=ad>Buy<p>now</p></div>c" + "</div>" * 300 + "<p>d</p>"
    assert wrapper.main_text(hidden) == "a\nb\nc\nd"
    letters = "abcdefghij"
    pages = [
        "<body>" + "".join(f'<p class="{"".join(letters[int(c)] for c in str(i))}{k}z">t{i}{k}</p>' for i in range(20_000)) + "</body>"
        for k in ("x", "y")
    ]
    began = time.process_time()
    found = wrapper_of(pages)
    assert time.process_time() - began < 20 and len(found.children[0].children) == 40_000


def test_pages_of_any_columns(spark):
    schema = "page_id bigint, url string, html string, host string, `__html` array<int>, wrapper string, text string"
    rows = [(2**53 + 1, "http://a.example/", "<p>One</p>", "h", [1], "w", "old"), (None, None, None, None, None, None, None)] * 2
    pages = spark.createDataFrame(rows, schema)
    got = wrapper.extract(pages, wrapper.induce(pages))
    assert got.columns == ["page_id", "url", "host", "__html", "wrapper", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(2**53 + 1, "http://a.example/", "h", [1], "w", "One"), (None, None, None, None, None, "")] * 2, key=str
    )
    none = pages.limit(0)
    assert wrapper.extract(none, wrapper.induce(none)).collect() == []


def test_odd_pages_have_a_text():
    for page in (None, "", "plain", "<", "<p", "</p></p>", "<!-- open", "<script>x", "<p>a<p>b", "<![CDATA[x]]>y", "&#0;&bogus;"):
        assert isinstance(wrapper.main_text(page), str)
    assert wrapper.main_text("<p>a<p>b") == "a\nb"


def test_constant_slots_are_template(spark):
    page = "<body><div>Welcome to us</div><div><p>Story {0}</p><p>Same words</p></div><div>Call now</div></body>"
    rows = [(i, "http://h.example/", page.format(i)) for i in range(5)] + [(9, None, None), (9, "x", "<p>alone</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = wrapper.extract(pages, wrapper.induce(pages)).collect()
    assert sorted((r.page_id, r.text) for r in found) == [
        *((i, f"Story {i}\nSame words") for i in range(5)), (9, ""), (9, "alone"),
    ]


def test_pages_equal_an_independent_reading(spark, sf_dir):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in wrapper.extract(pages, wrapper.induce(pages)).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside.replace("<br>", " ")))
        tidy = [re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts]
        assert got[row.page_id] == "\n".join(filter(None, tidy))


# repeated passages


def kept_words(rows, window=13):
    first, out = {}, {}
    for i, text in sorted(rows):
        for k in range(len(words(text)) - window + 1):
            first.setdefault(tuple(words(text)[k : k + window]), i)
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = " ".join(x for x, g in zip(w, gone, strict=True) if not g), len(w), sum(gone)
    return out


def test_removed_passages_equal_brute_force(spark, texts):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    more = [" ".join([*(rng.choice("abcdefg") for _ in range(30)), *passage[rng.randrange(20) :], "end"]) for _ in range(30)]
    rows = [*texts.items(), *enumerate(more, 10_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit("clash"))
    for window in (13, 5, 3):
        got = substring_dedup.remove_repeats(df, window).collect()
        assert {r.doc_id: (r.kept, r.n_words, r.n_removed) for r in got} == kept_words(rows, window)


def test_removal_of_odd_rows(odd, none):
    got = {(r.doc_id, r.text): (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(odd).collect()}
    assert got[0, None] == (0, 0) and got[None, "no id"] == (2, 0) and got[8, ODD[8]] == (30_000, 0)
    assert len(substring_dedup.remove_repeats(odd).collect()) == odd.count()
    assert substring_dedup.remove_repeats(none).count() == 0


# token counts


def longest_match(word, first, further):
    pieces, at, known = 0, 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1
        pieces, at, known = pieces + 1, end, further
    return pieces


def test_counts_equal_greedy_matching():
    rng = random.Random(5)
    for _ in range(60):
        make = lambda n: {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(n)}
        first, further = make(12), make(8)
        count = token_counts.Automaton(first, further).count
        for _ in range(200):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            assert count(word) == longest_match(word, first, further), (word, first, further)


def test_counts_of_documents(docs, odd, none, texts):
    first, further = map(set, token_counts.pieces_of(RANKS))
    for r in token_counts.count_tokens(docs, RANKS).collect():
        if r.doc_id % 10 == 0:
            w = words(texts[r.doc_id])
            assert (r.n_words, r.n_tokens) == (len(w), sum(longest_match(x.encode(), first, further) for x in w))
    assert token_counts.count_tokens(odd, RANKS).filter("doc_id = 0").first()["n_tokens"] == 0
    assert token_counts.count_tokens(none, RANKS).count() == 0


def test_words_of_any_script_are_cut(spark):
    tokens = bpe.load_ranks(RANKS)
    single = {bytes([i]) for i in range(256)}
    assert single <= set(tokens)
    first = {t[1:] for t in tokens if t[:1] == b" "} | single
    body = ["한국어 문장", "ภาษาไทยไม่มีช่องว่าง", "中国人民", "漢字", "plain words"]
    df = spark.createDataFrame(list(enumerate(body)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.count_tokens(df, RANKS).collect()}
    for i, text in enumerate(body):
        n = [longest_match(w.encode(), first, set(tokens)) for w in words(text)]
        assert got[i] == (len(n), sum(n))
    assert all(got[i][1] > got[i][0] for i in range(4))


# packing


@pytest.mark.parametrize("choose", ["norm", "dot"])
def test_slots_keep_every_capacity(choose):
    rng = random.Random(1)
    caps = packing.Capacities(tokens=64, documents=5, attention=1500, choose=choose)
    counts = Counter(rng.randint(1, 38) for _ in range(3000))
    bins, placed = defaultdict(list), Counter()
    for s in packing.plan_slots(counts, caps):
        assert s.rank == placed[s.length]
        placed[s.length] += s.count
        for k in range(s.count):
            bins[s.sequence + k].append((s.offset, s.length))
    assert placed == counts
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        sizes = [n for _, n in pieces]
        assert sum(sizes) <= 64 and len(sizes) <= 5 and sum(n * n for n in sizes) <= 1500
    with pytest.raises(ValueError):
        packing.plan_slots({39: 1}, caps)


def test_packed_documents(spark, docs, odd, none, texts):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    for part, known in ((docs, texts), (odd.filter("doc_id <> 3"), dict(enumerate(ODD)))):
        rows = packing.pack_documents(part, path, packing.Capacities(tokens=512)).collect()
        by_doc, sequences = defaultdict(list), defaultdict(list)
        for r in rows:
            by_doc[r.doc_id].append(r)
            sequences[r.sequence_id].append((r.offset, r.length))
        assert set(by_doc) == {i for i in known if i != 3 or part is docs}
        for i, pieces in by_doc.items():
            ids = np.array([*plain.encode(known[i] or "", add_special_tokens=False).ids, 0], "<u4")
            pieces.sort(key=lambda r: r.piece)
            assert all(r.length == 512 for r in pieces[1:]) and sum(r.length for r in pieces) == len(ids)
            for r in pieces:
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 512
        # best-fit comes within a fiftieth of what could be reached at most
        assert len(sequences) <= 1 + 1.02 * sum(r.length for r in rows) / 512
    assert packing.pack_documents(none, path).count() == 0


# language


def test_languages_are_told_apart(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = langid.prototypes(docs.filter(~langid.held_out()))
    rows = langid.identify(docs.filter(langid.held_out()), learned).collect()
    right = sum(r.lang == r.lang_pred for r in rows) / len(rows)
    assert right > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd, none, docs):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, langid.prototypes(docs)).collect()}
    for i in (0, 1, 2, 9, 10):
        assert got[i] == ("und", 0)
    assert got[4][0] != "und"
    assert langid.identify(none, langid.prototypes(docs)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.prototypes(none)).collect()} == {"und"}


def test_bundles_do_not_depend_on_their_neighbours(monkeypatch):
    body = ["the cat", "", "Ünï", "x" * 50, "one two three " * 20, "a\x00b"]
    together = langid.bundles(body, 128, 3)
    assert all((together[i] == langid.bundles([t], 128, 3)[0]).all() for i, t in enumerate(body))


# similarity join


def test_classes_equal_brute_force(spark, texts):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    near = []
    for i in range(80):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(60)] = f"n{rng.randrange(1000)}"
        near.append(" ".join(copy))
    short = ["a b c", "A B c", "a b c d e", "a b c d e f", "a", "", None] * 2
    shared = [" ".join([*base[:35], *(f"s{i}-{k}" for k in range(rng.randrange(5, 40)))]) for i in range(60)]
    rows = [*texts.items(), *enumerate([*near, *short, *shared], 10_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    lower = str.maketrans({k: k + 32 for k in range(65, 91)})
    sets = {}
    for i, t in rows:
        w = words((t or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    inverted = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for x in s for j in inverted[x])
        for x in s:
            inverted[x].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def test_one_deletion_keys_make_up_for_empty_segments():
    rng = np.random.default_rng(4)
    found = 0
    for _ in range(300):
        size = int(rng.integers(9, 60))
        a = np.unique(rng.integers(0, 1 << 60, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: len(a) - len(a) // 9], rng.integers(0, 1 << 60, len(a) // 9).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        keys = []
        for s in (a, b):
            mine = set()
            for low in (False, True):
                groups = jaccard_join._Groups(s, np.array([0, len(s)]), low, 80)
                mine |= {(int(k), int(groups.group[0])) for k in groups.rows()[1]}
            keys.append(mine)
        assert keys[0] & keys[1]
        found += 1
    assert found > 100


def test_classes_of_odd_rows(odd, none):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(odd.filter("doc_id <> 3")).collect()}
    assert got[0] == (0, 0) and got[2] == (0, 2) and got[8] == (1, 8) and got[4] == (1, 4)
    assert jaccard_join.near_duplicates(none).count() == 0


def test_rows_without_an_id_are_linked(spark):
    base = [f"w{i}" for i in range(60)]
    near, other = [*base[:-1], "z"], [f"v{i}" for i in range(60)]
    bodies = [
        (None, base), (7, base), (5, near), (-3, [*base[:-1], "y"]), (None, other), (None, [*other[:-1], "z"]),
        (None, [*other[:-1], "z"]), (9, ["alone"] * 9), (None, None),
    ]
    df = spark.createDataFrame([(i, w and " ".join(w)) for i, w in bodies], "doc_id bigint, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()]
    expected = [(i, 56, -3) for i in (None, 7, 5, -3)] + [(None, 56, None)] * 3 + [(9, 1, 9), (None, 0, None)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in [*range(41), 100]}, 200: 200, 201: 200}


def test_rounds_of_few_edges_have_few_partitions(spark, monkeypatch):
    parts = []
    monkeypatch.setattr(components_module, "checkpointed", lambda df: parts.append(df.rdd.getNumPartitions()) or checkpointed(df))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        links = spark.range(60).selectExpr("id AS a", "id + 3 AS b")
        got = {r.node: r.root for r in components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i % 3 for i in range(63)}
    assert len(parts) > 2 and max(parts[1:]) <= spark.sparkContext.defaultParallelism

# memory of a task's tables


def _peak(make) -> tuple[object, float]:
    """What ``make`` returns, and the most MB it held at once."""
    tracemalloc.start()
    try:
        return make(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_language_tables_of_many_short_texts_are_bounded(monkeypatch):
    rng = random.Random(3)
    some = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéèüö") for _ in range(40)) for _ in range(6000)]
    langid.bundles(["warm up"], 512, 3)
    got, peak = _peak(lambda: langid.bundles(some, 512, 3))
    assert peak < 250
    monkeypatch.setattr(langid, "CELLS", 1 << 30)
    assert (got[:200] == langid.bundles(some, 512, 3)[:200]).all()


def test_sets_of_a_batch_are_made_in_small_blocks():
    rng = random.Random(4)
    batch = pa.record_batch({
        "doc_id": pa.array(range(600), pa.int64()),
        "text": [" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(600)],
    })

    def rows(some):
        return [(x["doc_id"], x["node"]) for out in run(iter(some)) for x in out.to_pylist()]

    make = lambda ids, elements, first: {"doc_id": ids, "node": jaccard_join._nodes(elements, first)}
    run = jaccard_join._each(jaccard_join.SHINGLE, make)
    one = rows([batch.slice(i, 1) for i in range(600)])
    got, peak = _peak(lambda: rows([batch]))
    assert got == one and peak < 20


# top-k


def test_top_k_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, -0.5]), (1, [1.0, -0.5]), (2, [1.0, -0.5]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [2.0]), (7, [])]
    df = topk.scaled_floor(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = [tuple(r) for r in topk.top_k(df, df.filter("vec_id = 0"), 3).orderBy("rank").collect()]
    assert got == [(0, 1, 6, 131072), (0, 2, 1, 81920), (0, 3, 2, 81920)]
    assert topk.top_k(df.limit(0), df, 3).count() == 0
    assert topk.top_k(df, df.limit(0), 3).count() == 0


def test_top_k_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = random.Random(9)
    rows = [(i, [rng.randrange(-3, 4) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<bigint>")
    expected = []
    for q, x in rows[::20]:
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in rows if i != q)[:5]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), 5).collect()
    assert sorted(tuple(r) for r in got) == expected


def _vectors(kind):
    """Ids and vectors, some of them alike: of small or large numbers, or of few numbers and any length."""
    rng = random.Random(4)
    most = 3 if kind == "ragged" else 10 ** {"small": 2, "medium": 5, "large": 9}[kind]
    number = lambda: rng.choice([0, 0, 0, 0, 0, rng.randint(-most, most)]) if kind == "ragged" else rng.randint(-most, most)
    rows = [(i, [number() for _ in range(rng.choice([0, 1, 3, 40]) if kind == "ragged" else 5)]) for i in range(200)]
    return [*rows, (7, rows[8][1]), (7, rows[8][1]), (205, rows[3][1]), (210, [])]


@pytest.mark.parametrize("kind", ["small", "medium", "large", "ragged"])
def test_top_k_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "CANDIDATES", 60)
    monkeypatch.setattr(topk, "QUERIES", 9)
    rows = _vectors(kind)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<bigint>")
    expected = []
    for q, x in (r for r in rows if r[0] % 10 == 0):
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)[:4]  # noqa: B905
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    got = topk.top_k(df, df.filter("vec_id % 10 = 0"), 4).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_top_k_broadcasts_no_block(spark, plan_of):
    df = spark.createDataFrame(_vectors("small"), "vec_id bigint, embedding array<bigint>")
    assert "Broadcast" not in plan_of(topk.top_k(df, df.filter("vec_id % 10 = 0"), 4), run=True)


def test_top_k_hands_over_one_pair_of_small_blocks_in_a_task(spark, monkeypatch):
    for name, most in (("CANDIDATES", 10), ("QUERIES", 5), ("CANDIDATE_BLOCKS", 4), ("QUERY_BLOCKS", 2), ("CELLS", 150)):
        monkeypatch.setattr(topk, name, most)
    df = spark.createDataFrame(_vectors("small"), "vec_id bigint, embedding array<bigint>")
    pairs = topk._pairs(df, df.filter("vec_id % 10 = 0"), "vec_id", "embedding")
    held = pairs.select(F.spark_partition_id().alias("task"), "c", "q", "bytes", F.octet_length("numbers").alias("size")).collect()
    blocks, asked = {r.c for r in held}, {r.q for r in held}
    assert len(blocks) > 4 and len(asked) > 1 and len(held) == len(blocks) * len(asked) == len({r.task for r in held})
    assert {r.bytes for r in held} == {2}  # numbers of eight bytes were packed as such
    assert sum({r.c: r.size for r in held}.values()) == 2 * sum(len(x) for _, x in _vectors("small"))


# byte-level encoding


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_ids_equal_the_library(reference, texts, monkeypatch):
    rng = random.Random(6)
    letters = "abcdeéè \n\t  'st🎉漢字0129,.!?#@   re ve "
    some = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    some += ["z" * 3000, *[t for t in ODD if t], *list(texts.values())[:40]]
    encode = bpe.encoder(RANKS, P.PATTERN).encode
    for text in some:
        assert np.frombuffer(encode(text), "<u4").tolist() == reference.encode_ordinary(text)
        assert "".join(chunks(text)) == text


def test_forgetting_states_changes_no_id(reference, monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 40)
    encode = bpe.Transducer(bpe.load_ranks(RANKS)).encode
    rng = random.Random(8)
    for _ in range(100):
        piece = "".join(rng.choice("inthersoabcd") for _ in range(rng.randrange(1, 200)))
        assert encode(piece.encode()) == reference.encode_ordinary(piece)


def test_streaming_decoder_equals_python():
    rng = random.Random(7)
    for _ in range(2000):
        raw = bytes(rng.choice(b"A\xc3\xa9\xe2\x82\xac\xf0\x9f\x98\x80\xed\xa0\xe0\x80\xff") for _ in range(12))
        stream = bpe.Utf8Stream()
        assert "".join(stream.feed(raw[i : i + 1]) for i in range(12)) + stream.end() == raw.decode("utf-8", "replace")


def test_documents_come_back(docs, odd, none):
    for part in (docs, odd):
        back = bpe.decode_documents(bpe.encode_documents(part, RANKS, P.PATTERN), RANKS)
        assert back.filter("coalesce(text, '') <> decoded").count() == 0
    assert bpe.encode_documents(none, RANKS, P.PATTERN).count() == 0


def test_tables_given_keep_their_schema(docs):
    given = docs.select("doc_id", "text")
    encoded = bpe.encode_documents(given, RANKS, P.PATTERN)
    assert given.columns == ["doc_id", "text"] and encoded.columns == ["doc_id", "text", "ids"]
    assert bpe.decode_documents(encoded, RANKS).columns == ["doc_id", "text", "ids", "decoded"]
    assert encoded.columns == ["doc_id", "text", "ids"]


def test_steps_with_tokens_of_any_length_equal_plain_merges():
    """A state keeps the sizes of tokens in one byte each where these are short, else in more."""
    rng = random.Random(9)
    for longest in (5, 200, 300):
        tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abab", b"bc", b"ca", b"cab"]
        while len(tokens[-1]) < longest:
            tokens.append(tokens[-1] + rng.choice(tokens[256:261]))
        ranks = {token: i for i, token in enumerate(dict.fromkeys(tokens))}
        transducer = bpe.Transducer(ranks)
        for _ in range(60):
            piece = b"".join(rng.choice(tokens[256:]) for _ in range(rng.randrange(1, 9)))[:700]
            if piece not in ranks:
                assert transducer.encode(piece) == [ranks[t] for t in bpe.merge_plainly(piece, ranks)]
        if longest == 200:
            keys = [key for key in transducer.states if len(key) > 4]
            assert all(len(key) % 2 == 0 and transducer._parts(key)[0] == key[4 : 2 + len(key) // 2] for key in keys)


# quality rules


def test_counts_of_rules_equal_brute_force(docs, odd):
    for part in (docs.limit(60), odd):
        for r in cascade.judge(part).collect():
            t, w = r.text or "", words(r.text)
            grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
            often = Counter(grams)
            covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
            lines = [x for x in t.split("\n") if WORD.search(x)]
            assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
            assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
            assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
            assert not (r.base_failed and r.kept)


def test_the_order_of_rules_changes_no_verdict(spark, docs, none):
    counted = cascade.measured(docs.limit(80)).persist()
    rules = cascade.standard_rules()
    one, other = (counted.select("doc_id", cascade.verdict(r).alias("k")).collect() for r in (rules, rules[::-1]))
    assert sorted(one) == sorted(other) and len({r.k for r in one}) == 2
    assert cascade.judge(none).count() == 0
    quick = [cascade.Estimate("a", 1.0, 0.5), cascade.Estimate("b", 0.1, 0.2)]
    named = docs.limit(20).withColumn("words", F.lit("w")).withColumn("lines", F.lit(3)).withColumn("n_lines", F.lit(4))
    judged = cascade.judge(named)
    assert set(judged.columns) >= {*named.columns, "kept"} and judged.filter("words = 'w' AND lines = 3 AND n_lines = 4").count() == 20
    assert [r.name for r in cascade.ordered([cascade.Rule(n, F.lit(True)) for n in "ab"], quick)] == ["b", "a"]


def test_rules_run_without_python(docs):
    plan = cascade.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# quality classifier


def test_held_out_labels_are_found(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_gam.train(quality_gam.learnable(docs), quality_gam.learnable(labels), "quality")
    unseen = labels.join(quality_gam.learnable(labels), "doc_id", "left_anti")
    rows = quality_gam.score(docs.join(unseen, "doc_id"), model).collect()
    assert len(rows) > 50 and sum((r.score >= 0.5) == r.quality for r in rows) / len(rows) > 0.97


def test_classifier_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1), (4, None)], "doc_id bigint, quality int")
    model = quality_gam.train(odd, labels, "quality")
    scores = [r.score for r in quality_gam.score(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    empty = quality_gam.train(none, labels.limit(0), "quality")
    assert {r.score for r in quality_gam.score(odd, empty).collect()} == {0.5}


def test_an_interaction_is_learnt():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.95


def test_hashes_are_of_whole_results(spark, sf_dir):
    folder = sf_dir.replace("sf0.01", "sf0.001")
    got = {r.doc_id: r for r in bpe.op8_bpe(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_pairs_of_runs(monkeypatch):
    firsts, n = np.array([0, 3, 4, 9]), 11
    ends = [3, 4, 9, 11]
    expected = [(p, q) for a, b in zip(firsts, ends, strict=True) for p in range(a, b) for q in range(p + 1, b)]
    for most in (1, 3, 100):
        monkeypatch.setattr(jaccard_join, "PAIRS", most)
        got = [(int(p), int(q)) for x, y in jaccard_join._pairs_of_runs(firsts, n) for p, q in zip(x, y, strict=True)]
        assert got == expected


def test_crowded_buckets_are_compared_in_blocks(spark, monkeypatch):
    """All pairs of a bucket with different roots and near bitmaps, once, however the bucket is cut."""
    rng = random.Random(9)
    shape = "node bigint, n_shingles bigint, bits binary"
    base = rng.getrandbits(1024)
    nodes = [(i, 100, (base ^ sum(1 << rng.randrange(1024) for _ in range(rng.choice([3, 30])))).to_bytes(128)) for i in range(40)]
    bits, root = {i: int.from_bytes(b) for i, _, b in nodes}, {i: i % 17 for i in range(40)}
    buckets = {5: range(40), 6: range(0, 40, 3), 7: [1, 2]}
    rows = [(same, len(list(m)), i, root[i]) for same, m in buckets.items() for i in m]
    looked_at = spark.createDataFrame(rows, "same bigint, size bigint, node bigint, root bigint")
    expected = {
        (a, b) for m in buckets.values() for a in m for b in m
        if a < b and root[a] != root[b] and 180 * (bits[a] ^ bits[b]).bit_count() <= 20 * 200
    }
    assert 10 < len(expected) < 700
    for crowd in (1024, 7, 1):
        monkeypatch.setattr(jaccard_join, "CROWD", crowd)
        found = jaccard_join._crossing_pairs(looked_at, spark.createDataFrame(nodes, shape), 80).collect()
        assert sorted((r.a, r.b) for r in found) == sorted(expected)


def test_a_run_may_go_on_in_the_next_batch():
    import pyarrow as pa

    names = ["same", "unit", "side", "alone", "node", "root", "n", "bits"]
    rows = [(s, 0, 0, True, i, i, 50, bytes(128)) for s, i in [(1, 1), (1, 2), (1, 3), (2, 4), (2, 5), (3, 6)]]
    for size in (1, 2, 4, 10):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*p, strict=True)], names) for p in parts]
        got = [(a, b) for out in jaccard_join._crossing(80)(iter(batches)) for a, b in zip(*out.to_pydict().values(), strict=True)]
        assert got == [(1, 2), (1, 3), (2, 3), (4, 5)]


def test_what_is_kept_of_a_text_stands_as_it_was(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [
        (1, f"Zero line\n\n{passage}\n"), (2, f"  First line\there\n\n{passage}\nLast  line \n"), (3, passage), (4, "\n untouched  text\n"),
        (5, f"a {passage}"), (6, None), (7, " \n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.kept for r in substring_dedup.remove_repeats(docs, as_is=True).collect()}
    assert got[1] == rows[0][1] and got[2] == "  First line\there\n\nLast  line \n" and got[3] == "" and got[4] == rows[3][1]
    assert got[5] == "a " and got[6] in ("", None) and got[7] == " \n"


def test_needed_sets_take_one_worker_a_task(docs, odd):
    for part in (docs.limit(50), odd):
        needed = part.filter("doc_id % 3 = 0").select("doc_id")
        sets = jaccard_join._needed_sets(part, needed, 5)
        plan = sets._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"\bMapInArrow\b|PythonMapInArrow", plan)) == 1
        made = jaccard_join.documents_of(part, 5)
        sizes = {r.node: r.n_shingles for r in made.join(needed, "doc_id").collect()}
        got = {r.node: len(r.elements) // 8 for r in sets.collect()}
        assert sizes and sizes.items() <= got.items()


def test_recent_keys_are_looked_up_and_old_ones_made_again(monkeypatch):
    monkeypatch.setattr(bpe, "RECENT", 2)
    made = []
    recent = bpe.Recent(lambda key: made.append(key) or key.encode())
    for key in "abacadaeaa":
        assert recent(key) == key.encode()
    assert made.count("a") <= 2 and len(recent.young) + len(recent.old) <= 4
    long = "x" * 100
    assert recent(long) == recent(long) == long.encode() and made.count(long) == 2
