"""The corpus operators on small tables and against brute force or SQL."""

import hashlib
import html
import math
import random
import re
import string
import time
import zlib

import numpy as np
import pytest
import xxhash

import check
import corpus_pipeline
from tamarack.llm import chunking, exact, jaccard, mixing, pii, quality, queries, sentencepiece_fst, toolcalls, toxicity, wrappers

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, component long, n long, key string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ROWS = [
    (1, "the cat sat on the mat today ok", "b", 9, 9, "x"),
    (2, "the  cat sat\non the mat today ok", "a", 9, 9, "x"),
    (2, "the  cat sat\non the mat today ok", "a", 9, 9, "x"),
    (3, None, None, None, None, None),
    (4, "", "", 1, 1, ""),
    (None, "mail a@b.co now", None, 1, 1, "k"),
    (None, None, "a", 1, 1, "k"),
    (5, LONG, "b", 1, 1, "k"),
    (6, LONG + " tail", "b", 1, 1, "k"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, None, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_sql(spark, name, monkeypatch):
    monkeypatch.setattr(check.entry, "queries", lambda: queries.QUERIES)
    monkeypatch.setattr(check.entry, "oracle_sql", lambda: queries.ORACLES)
    assert check.difference(spark, FOLDER, name)[0] is None


def test_empty_tables(empty, labels):
    for run in (pii.op1, exact.op4, sentencepiece_fst.op5, mixing.op6, chunking.op9, jaccard.op10):
        assert run(empty).count() == 0
    assert quality.op7(empty, labels).count() == toxicity.op8(empty, labels).count() == 0
    pages = empty.selectExpr("doc_id as page_id", "key as url", "text as html")
    assert wrappers.op3(pages).count() == 0
    turns = empty.selectExpr("doc_id as conv_id", "n as turn", "key as role", "text")
    assert toolcalls.op2(turns).count() == 0


def spans_of(text):
    """Base spans by the documented patterns."""

    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            doubled = [int(d) * 2 - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind != "phone" or 9 <= len(digits) <= 15

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = [
        (m.start(), i, m.end(), k) for i, (k, p) in enumerate(patterns.items()) for m in re.finditer(p, text) if fits(k, m[0])
    ]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_pii_base_spans(spark):
    texts = [
        "é a@b.c_d@e.f x 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 4111 1111-1111 1111 +1 (705) 555-5593, +12 3",
        "😀 +49 30 123456789 4111111111111112 5500005555555559 a.b+c@x-y.co.uk. @x.y 1..2",
        "aa" * 3000 + "@" + "a." * 3000 + "b",
        "1" * 5000,
        "",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.op1(rows).collect()}
    for i, t in enumerate(texts):
        assert got[i].spans == spans_of(t)
        assert got[i].base_sha256 == hashlib.sha256(spans_of(t).encode()).hexdigest()


def test_pii_odd_rows_and_whole_table(spark, odd, documents):
    got = pii.op1(odd).collect()
    assert len(got) == len(ROWS)
    assert [r.n_email for r in got if r.spans] == [1]
    whole = {r.doc_id: r.base_sha256 for r in queries.QUERIES["op1_pii"](spark, FOLDER).collect()}
    assert whole == {i: hashlib.sha256(spans_of(t).encode()).hexdigest() for i, t in documents}


def test_pii_bootstrap_discovers(spark):
    texts = [f"word{i} support mailbox u{i}@host{i}.org and more" for i in range(12)] + ["other support mailbox u99@intranet here"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.op1(rows).collect()}
    start = texts[12].index("u99")
    assert found[12] == f"email:{start}:{start + len('u99@intranet')}"


def test_pii_discovers_runs_and_right_contexts(spark):
    seeds = [f"word{'abcdefghijkl'[i]} call +1 (705) 555-55{i + 10} today please" for i in range(12)]
    seeds += [f"{'abcdefghijkl'[i]} u{i}@host{i}.org wrote back" for i in range(12)]
    texts = [
        ("someone should call (521) 555-6210 tomorrow", "phone", "(521) 555-6210"),
        ("call 521 555 62104", "phone", "521 555 62104"),
        ("then jane[at]host.org wrote back", "email", "jane[at]host.org"),
        ("then (joe@intranet) wrote back", "email", "joe@intranet"),
    ]
    rows = [(i, t) for i, t in enumerate(seeds + [t for t, _, _ in texts])]
    found = {r.doc_id: r.spans for r in pii.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, kind, value) in enumerate(texts, len(seeds)):
        assert found[i] == f"{kind}:{text.index(value)}:{text.index(value) + len(value)}"


def test_pii_bootstrap_goes_on_until_settled(spark):
    # Each value of a level stands behind a word that all values of the level before stand behind: four levels.
    levels = [[f"v{k}x{i}" for i in range(20 if k < 4 else 1)] for k in range(5)]
    base = [("email", v, "", "") for v in levels[0]]
    others = [(w, f"after{v}", "") for a, b in zip(levels, levels[1:]) for v in b for w in (*a, v)]
    found = pii.bootstrap(
        spark.createDataFrame(base, "kind string, value string, left string, right string"),
        spark.createDataFrame(others, "value string, left string, right string"),
    )
    assert {tuple(r) for r in found.collect()} == {(v, "email") for level in levels[1:] for v in level}


def test_tool_calls_order_and_validation(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "add", '{"y": 2, "x": 1}', []),
            (1, "b", 2, "add", '{"x": "no"}', ["d"]),
            (1, "c", 3, "add", "broken", ["b"]),
            (1, "d", 4, "gone", None, ["a"]),
            (1, "a", 9, "add", '{"x": 5, "y": 5}', []),
            (2, "p", 1, "add", '{"x": 1, "y": 2, "z": 3}', ["q"]),
            (2, "q", 2, "add", '{"x": 1, "y": 2.5}', ["p"]),
            (None, "n", 1, "add", '{"x": 1, "y": 2}', []),
        ],
        "conv_id long, call_id string, place long, name string, arguments string, needs array<string>",
    )
    results = spark.createDataFrame(
        [(1, "a", 5, 'say "3"'), (1, "zz", 6, "lost"), (None, "n", 2, None)], "conv_id long, call_id string, place long, content string"
    )
    schema = spark.createDataFrame(
        [("add", "x", "integer", True, 0), ("add", "y", "number", True, 0)],
        "name string, argument string, type string, required boolean, min_length int",
    )
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link_calls(calls, results, schema).collect()}
    one = sorted((r.depth, r.place, c) for (v, c), r in got.items() if v == 1 and r.n_calls)
    order = [c for _, _, c in one]
    assert order.index("a") < order.index("d") < order.index("b") < order.index("c")
    assert got[1, "a"].json == '{"arguments":{"x":1,"y":2},"id":"a","name":"add","needs":[],"result":"say \\"3\\""}'
    assert got[1, "a"].n_calls == 2 and got[1, "a"].status == "linked"
    assert got[1, "b"].errors == "x: not integer; y: missing"
    assert got[1, "c"].errors == "arguments: not an object"
    assert got[1, "d"].errors == "tool: unknown"
    assert got[1, "zz"].status == "orphan_result"
    assert got[2, "p"].status == got[2, "q"].status == "cyclic"
    assert got[None, "n"].status == "linked"


PAGE = (
    '<html><head><title>t</title><script>var a="</p>";</script></head><body><header>Site</header><div class="cookie-notice">We use</div>'
    '<nav><ul><li><a>m</a></li></ul></nav><{tag}><h1>A &amp; B {i}</h1><p>One <b>two</b>\n three{i}<p>Four &lt;{i}<br>five'
    '<div class="ad">buy</div><form>mail</form><!-- x --></{tag}><section id="comments"><p>first!</p></section>'
    "<aside>side</aside><footer>f</footer></body></html>"
)


@pytest.mark.parametrize("tag", ["article", "main", 'div id="content"', "div"])
def test_main_text(spark, tag):
    pages = [PAGE.replace("</{tag}>", f"</{tag.split()[0]}>").replace("{tag}", tag).replace("{i}", str(i)) for i in range(3)]
    rows = [(i, f"http://h{i % 2}.org/{i}", p) for i, p in enumerate(pages)] + [(7, None, None), (8, "x", ""), (None, "::", "<p>a<b")]
    got = {r.page_id: r.text for r in wrappers.op3(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == f"A & B {i}\nOne two three{i}\nFour <{i} five"
    assert got[7] == got[8] == ""
    assert len(got) == 6


def inferred_wrapper(pages):
    return wrappers.Wrapper(wrappers.inferred([wrappers.expression(p) for p in pages]), len(pages))


def test_slots_are_bound_to_places_of_the_expression(spark):
    # The text of a label, but at the place of a varying slot with the same path.
    bodies = [f"body {i}" for i in range(8)]
    bodies[3] = "Notes"
    pages = [f"<div><p>Notes</p><h2>t{i}</h2><p>{b}</p></div>" for i, b in enumerate(bodies)]
    wrapper = inferred_wrapper(pages)
    places = [p for p in wrapper.bound(wrappers.read_page(pages[3])[0]) if wrapper.keys[p][0] == "s"]
    assert [bool(wrapper.labels[p]) for p in places] == [True, False, False]
    # Every page matches its host's expression.
    rng = random.Random(4)
    block = lambda d: "".join(
        f"<{t}>{rng.choice('abc') if d > 2 or rng.random() < 0.5 else block(d + 1)}</{t}>" for t in rng.choices(("div", "p", "ul", "h2"), k=rng.randint(1, 5))
    )
    odd = [block(0) for _ in range(40)]
    given = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    for pages in (odd, given):
        wrapper = inferred_wrapper(pages)
        for page in pages:
            tokens, _ = wrappers.read_page(page)
            places = wrapper.bound(tokens)
            assert [wrapper.keys[p] for p in places] == ["s" + t[1:] if t[0] == "#" else "t" + t for t in tokens]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_articles_keep_what_all_pages_say(spark, tag):
    page = f"<body><p>Site</p><{tag}><h1>One title</h1><p>One lead</p><p>Revision {{}}</p></{tag}></body>"
    rows = [(i, f"http://h.org/{i}", page.format(i)) for i in range(8)]
    got = wrappers.op3(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"One title\nOne lead\nRevision {i}" for i in range(8)}


def test_names_alone_remove_nothing():
    text = lambda page: inferred_wrapper([page]).article(page)
    long = "<div>" + "word " * 50 + "</div>"
    for name in ('class="content with-sidebar"', 'class="post has-comments"'):
        assert text(f"<body>{long}<div {name}><article><p>A b</p></article></div></body>") == "A b"
        assert text(f"<body>{long}<main><div {name}><article><p>A b</p></article></div>{long}</main></body>") == "A b"
        assert text(f"<body>{long}<div {name}><main><p>A b</p></main></div></body>") == "A b"
    assert text("<body><div id='search-results'><p>One two three</p></div><div>x</div></body>") == "One two three"
    assert text("<article><h1 class='page-header'>T</h1><p>One two three</p></article>") == "T\nOne two three"
    assert text("<body><form id='page'><main><p>One two</p></main></form></body>") == "One two"
    assert text("<article class='!mt-0'><p>One two</p></article>") == "One two"
    # Names still count where the host's words agree.
    comments = "<section class='comments'><article class='comment'><p>first</p></article></section>"
    assert text(f"<body><article><p>One two three</p><div class='share'>Share</div>{comments}</article>{comments}</body>") == "One two three"
    assert text(f"<body><main><p>One two three</p>{comments}</main></body>") == "One two three"


COMMENTS = "".join(f"<div class='comment'><p>reader {{i}} says {k} and many more words than the article has</p></div>" for k in range(6))
ASIDES = {
    "section class='comments'": COMMENTS,
    "div id='comments'": COMMENTS,
    "div class='related-posts'": "<ul>" + "".join(f"<li>another story {{i}} {k} with a long title</li>" for k in range(9)) + "</ul>",
    "div class='cookie-banner'": "<p>" + "we use cookies {i} " * 40 + "</p>",
}


@pytest.mark.parametrize("body", ["article", "main", "div class='story'"])
@pytest.mark.parametrize("name", ASIDES)
@pytest.mark.parametrize("n", [1, 8])
def test_what_stands_aside_goes_whatever_its_length(body, name, n):
    end = lambda tag: f"</{tag.split()[0]}>"
    aside = f"<{name}>{ASIDES[name]}{end(name)}"
    inside = f"<body><{body}><h1>T {{i}}</h1><p>Short {{i}}</p>{aside}{end(body)}</body>"
    below = f"<body><{body}><h1>T {{i}}</h1><p>Short {{i}}</p>{end(body)}{aside}</body>"
    for page in (inside, below):
        pages = [page.replace("{i}", str(i)) for i in range(n)]
        wrapper = inferred_wrapper(pages)
        assert [wrapper.article(p) for p in pages] == [f"T {i}\nShort {i}" for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9])
def test_what_all_pages_say_stays_however_many_there_are(n):
    pages = [f"<body><div>Home</div><div class='story'><h1>Same title</h1><p>Same lead</p><p>Body {i} text</p></div></body>" for i in range(n)]
    wrapper = inferred_wrapper(pages)
    assert [wrapper.article(p) for p in pages] == [f"Same title\nSame lead\nBody {i} text" for i in range(n)]
    same = [pages[0]] * n
    assert {inferred_wrapper(same).article(p) for p in same} == {"Same title\nSame lead\nBody 0 text"}


def test_names_of_what_an_element_has_are_no_asides():
    text = lambda page: inferred_wrapper([page]).article(page)
    for name in ("post has-comments", "entry-content sidebar-left", "wrap with-sidebar", "story comments-open", "post widget"):
        assert text(f"<article><h1>T</h1><p>Lead</p><div class='{name}'><p>One two</p></div></article>") == "T\nLead\nOne two"
    # An element named aside that holds all there is besides headings is the text.
    assert text("<article><h1>T</h1><div class='widget'><p>One two</p></div></article>") == "T\nOne two"
    assert text("<main><article class='post'><p>One two</p></article><article class='comment'><p>a b c d e f</p></article></main>") == "One two"


def test_repetitions_are_found_as_by_trying_all_periods():
    rng = random.Random(12)
    for _ in range(300):
        letters, stream = rng.choice(["ab", "abcd", "abcdefgh"]), []
        while len(stream) < 60:
            stream += rng.choices(letters, k=rng.randint(1, 12)) * rng.choice([1, 1, 2, 3])
        codes, above = wrappers._codes(stream), rng.randint(0, 12)
        squares = [p for p in range(above + 1, len(stream) // 2 + 1) if any(stream[i : i + p] == stream[i + p : i + 2 * p] for i in range(len(stream) - 2 * p + 1))]
        assert wrappers._next_period(codes, above) == (squares[0] if squares else 0)
    start = time.monotonic()
    rng = random.Random(13)
    page = "".join(f"<{t}>word {i}</{t}>" for i, t in enumerate(rng.choices(("p", "div", "ul", "h2", "section", "table"), k=200_000)))
    wrapper = wrappers.Wrapper(wrappers.expression(page), 1)
    assert wrapper.article(page).count("\n") == 199_999
    assert time.monotonic() - start < 60


def test_long_streams_are_aligned_and_folded_as_short_ones(monkeypatch):
    rng = random.Random(6)
    streams = [[["t", rng.choice("abcde")] for _ in range(n)] for n in (90, 70)]
    whole = [sum(i[0] == "t" for i in wrappers._middle(*streams))]
    monkeypatch.setattr(wrappers, "ALIGNED", 40)
    cut = wrappers._middle(*streams)
    assert [sum(i[0] == "t" for i in cut)] == whole and whole[0] > 30
    flat = lambda items: sum(([i[1]] if i[0] == "t" else flat(i[1]) for i in items), [])
    assert len(flat(cut)) == 90 + 70 - whole[0]
    # A repeated group of 60 items.
    body = [["t", f"x{i}"] for i in range(59)] + [["s", "/p", "d", 1, 1]]
    folded = wrappers.fold(body * 3 + [["t", "end"]])
    assert [i[0] for i in folded] == ["+", "t"] and len(folded[0][1]) == 60


def test_whole_pages(spark):
    got = {r.page_id: r for r in queries.QUERIES["op3_html_text"](spark, FOLDER).collect()}
    for page in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", page.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)[^>]*>", body)]
        assert got[page.page_id].text == "\n".join(b for b in blocks if b)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


def test_exact_odd_rows(odd):
    got = exact.op4(odd).collect()
    assert len(got) == len(ROWS)
    same = [r for r in got if r.doc_id in (1, 2)]
    assert {r.keep_id for r in same} == {1} and [r.group_size for r in same] == [3, 3, 3] and sum(r.kept for r in same) == 1
    nothing = [r for r in got if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {r.keep_id for r in nothing} == {3} and len(nothing) == 3
    kept = exact.drop_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 5, 6]


def test_perfect_hash_is_minimal_and_checks_bytes():
    words = np.random.default_rng(1).integers(0, 2**63, (5000, 4)).astype(np.uint64)
    table, slot = exact.PerfectHash.build(words)
    assert sorted(slot) == list(range(5000)) and (table.find(words) == slot).all()
    others = words.copy()
    others[:, 3] ^= np.uint64(1)
    assert (table.find(others) == -1).all()


def test_pieces_agree_with_the_library(documents):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    machine = sentencepiece_fst.Transducer(sentencepiece_fst.read_model(sentencepiece_fst.MODEL))
    rng = random.Random(2)
    alphabet = "abcdehinorst  _-éß漢😀\n\t*#0123"
    noise = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text in [t for _, t in documents] + noise + ["", " ", "   ", "a" * 5000, "\x00\x1f"]:
        ids = machine.encode(text)
        assert ids == library.encode(text)
        assert machine.decode(ids) == text


def test_paths_of_chunks_are_remembered_over_many_others():
    searched = []
    memory = sentencepiece_fst._Paths(lambda chunk: searched.append(chunk) or b"")
    for i in range(600_000):
        memory[str(i)]
    assert memory["0"] == b"" and len(searched) == 600_000
    assert len(memory) + len(memory.older) <= 2 * sentencepiece_fst.REMEMBERED


def test_unigram_path_is_the_cheapest():
    pieces = [("<unk>", 0.0, 2), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -2.5, 1), ("ba", -3.0, 1), ("aba", -9.0, 1), ("▁", -1.0, 1)]
    machine = sentencepiece_fst.Transducer({"pieces": pieces, "bpe": False, "fallback": False, "prefix": True, "squeeze": True})
    assert [pieces[i][0] for i in machine.encode(" aba  z")] == ["▁", "ab", "a", "▁", "<unk>"]


def test_pieces_odd_rows(odd):
    got = sentencepiece_fst.op5(odd).collect()
    assert len(got) == len(ROWS) and all(r.exact for r in got)
    back = sentencepiece_fst.decode(sentencepiece_fst.encode(odd)).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in ROWS)


def test_mix_odd_rows(odd):
    got = mixing.op6(odd).collect()
    assert len(got) == len(ROWS)
    assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in got)
    whole = sum(r.size for r in got)
    by_source = {}
    for r, row in zip(sorted(got, key=lambda r: (r.doc_id or 0, r.size)), sorted(ROWS, key=lambda r: (r[0] or 0, len(r[1] or ""))), strict=True):
        by_source[row[2]] = r.target
        assert r.target <= 3 * r.source_size
    assert abs(sum(by_source.values()) - whole) < 1e-6 or all(r.target == 3 * r.source_size for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.op6(odd.repartition(3)).collect()), key=repr)
    taken = mixing.apply_mix(odd)
    assert taken.columns == odd.columns and taken.count() == sum(r.taken // r.size for r in got if r.size)


def accuracy(spark, name, label, folder="/root/testdata/sf0.1"):
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in queries.QUERIES[name](spark, folder).collect() if r.held_out and r.doc_id in known]
    right = [r.predicted == known[r.doc_id] for r in got]
    rare = [r.predicted == known[r.doc_id] for r in got if known[r.doc_id] == (label == "toxic")]
    return sum(right) / len(right), sum(rare) / len(rare)


def test_quality_on_held_out_rows(spark, odd, labels):
    right, bad = accuracy(spark, "op7_quality", "quality")
    assert right > 0.97 and bad > 0.9
    got = quality.op7(odd, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_marginals_agree_with_enumeration():
    rng = np.random.default_rng(3)
    scores, steps = rng.normal(size=4), rng.normal(size=(2, 2))
    good, counts, norm = quality._chains(scores, np.array([0]), np.array([4]), steps)
    weights = {}
    for path in np.ndindex(2, 2, 2, 2):
        weights[path] = np.exp(sum(s * scores[i] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
    total = sum(weights.values())
    assert np.allclose(norm, np.log(total))
    assert np.allclose(good, [sum(w for p, w in weights.items() if p[i]) / total for i in range(4)])
    assert np.allclose(counts[1, 0], sum(w * sum(a == 1 and b == 0 for a, b in zip(p, p[1:])) for p, w in weights.items()) / total)


def slopes(f, at, e=1e-6):
    """Numeric slopes of f."""
    return np.array([(f(at + e * d) - f(at - e * d)) / (2 * e) for d in np.eye(len(at))])


def test_quality_fits_one_likelihood():
    """The value by enumeration of all paths, the slope by differences, at weights where chains differ in weight."""
    rng = np.random.default_rng(8)
    lengths = np.array([3, 1, 4])
    starts, total, width = np.array([0, 3, 4]), 8, 2
    x, y = rng.normal(size=(total, width)), np.repeat([1.0, 0.0, 0.0], lengths)
    weight, ridge = np.repeat([0.5, 2.0, 0.3], lengths), np.array([0.1, 0.2, 0.3, 0.3, 0.3, 0.3])
    params = rng.normal(size=width + 4)

    def by_paths(at):
        steps, scores, value = at[width:].reshape(2, 2), x @ at[:width], -(ridge * at**2).sum() / 2
        for s, n in zip(starts, lengths, strict=True):
            of = lambda p: sum(g * scores[s + i] for i, g in enumerate(p)) + sum(steps[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
            value += weight[s] * (of([int(v) for v in y[s : s + n]]) - np.log(sum(np.exp(of(p)) for p in np.ndindex(*[2] * n))))
        return value

    value, slope = quality.likelihood(params, x, y, starts, lengths, weight, ridge)
    assert np.isclose(value, by_paths(params)) and np.allclose(slope, slopes(by_paths, params), atol=1e-6)


def test_toxicity_fits_the_cumulative_link():
    rng = np.random.default_rng(9)
    links, grade, thresholds = rng.normal(size=12) * 3, np.arange(12) % 4, np.array([-0.5, 0.1, 2.0])

    def plain(links, thresholds):
        below = lambda k: 1.0 if k == 3 else 0.0 if k < 0 else 1 / (1 + np.exp(links - thresholds[k]))
        p = np.stack([np.broadcast_to(below(k), len(links)) - below(k - 1) for k in range(4)], axis=1)
        return np.log(p[np.arange(len(links)), grade])

    value, by_link, by_threshold = toxicity.likelihood(links, thresholds, grade)
    assert np.allclose(value, plain(links, thresholds))
    assert np.allclose(by_link, slopes(lambda x: plain(x, thresholds).sum(), links), atol=1e-6)
    assert np.allclose(by_threshold.sum(axis=0), slopes(lambda t: plain(links, t).sum(), thresholds), atol=1e-6)
    far = toxicity.likelihood(np.array([700.0, -700.0]), thresholds, np.array([0, 3]))
    assert all(np.isfinite(v).all() for v in far)


def test_toxicity_scores_against_plain_sums(spark):
    """Every document's severity from the fitted numbers, word by word and without the operator's code."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in toxicity.severities(docs, model).collect():
        words = {w.strip(".,;:!?\"'()[]{}|*#$%&-") for w in text[r.doc_id].lower().split()} - {""}
        keys = [k for w in words for k in [w] + [f"{n}^{w[:n]}" for n in (4, 5, 6) if len(w) >= n]]
        link = sum(float(model.weights[zlib.crc32(k.encode()) % len(model.weights)]) for k in keys)
        above = [1 / (1 + math.exp(min(700.0, t - link))) for t in model.thresholds]
        assert math.isclose(r.severity, sum(above), abs_tol=1e-6) and math.isclose(r.score, above[0], abs_tol=1e-6)


def test_toxicity_on_held_out_rows(spark, odd, labels):
    right, toxic = accuracy(spark, "op8_toxicity", "toxic")
    assert right > 0.97 and toxic > 0.85
    assert toxicity.op8(odd, labels).count() == len(ROWS)


def test_severity_grows_with_toxic_words():
    rng = random.Random(4)
    docs, grade = [], []
    for i in range(600):
        words = {rng.choice("abcdefgh") * 4 for _ in range(5)}
        bad = rng.sample(["vile1", "vile2", "vile3"], i % 4)
        docs.append(np.array([s for w in sorted(words | set(bad)) for s in toxicity.slots_of(w)]))
        grade.append(i % 4)
    model = toxicity.fit(docs, np.array(grade))
    assert (np.diff(model.thresholds) > 0).all()
    severity = [model.above(np.array([model.link(t)]))[0].sum() for t in ("aaaa", "aaaa vile1", "aaaa vile1 vile2", "vile1 vile2 vile3")]
    assert severity == sorted(severity) and severity[0] < 0.5 < 2.5 < severity[3]


def test_fingerprints_against_brute_force(spark, odd, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op9_fingerprints"](spark, FOLDER).collect()}
    rows = sorted(documents)
    for k, (i, text) in enumerate(rows):
        new = chunking.edited(text, rows[(k + 1) % len(rows)][1])
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert got[i].fingerprint == chunking.fingerprint(text.encode())
        assert got[i].edited_fingerprint == chunking.fingerprint(new.encode())
        assert got[i].near_next == chunking.likeness(chunking.chunks(text.encode()), chunking.chunks(rows[(k + 1) % len(rows)][1].encode()))
    assert chunking.op9(odd).count() == len(ROWS)
    one = odd.filter("doc_id = 1").collect()[0].text
    assert chunking.op9(odd.filter("doc_id = 1")).first().edited_sha256 == hashlib.sha256(chunking.edited(one, one).encode()).hexdigest()


def test_chunks_resist_shifts():
    text = LONG.encode()
    a, b = chunking.chunks(text), chunking.chunks(b"some words in front " + text)
    assert chunking.likeness(a, b) > 0.95
    ends = chunking.borders(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= chunking.LARGEST and sizes[:-1].min() >= chunking.LEAST


def near_components(rows):
    """(size of the set, smallest linked id) by comparing all pairs that share a shingle."""
    table = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    sets, owners, home = {}, {}, {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        home[i] = i
        for s in sets[i]:
            owners.setdefault(s, []).append(i)

    def find(i):
        while home[i] != i:
            i = home[i]
        return i

    for pair in {(a, b) for o in owners.values() for k, a in enumerate(o) for b in o[k + 1 :]}:
        shared = len(sets[pair[0]] & sets[pair[1]])
        if 100 * shared >= 75 * (len(sets[pair[0]]) + len(sets[pair[1]]) - shared):
            a, b = find(pair[0]), find(pair[1])
            home[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_against_all_pairs(spark, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op10_near_duplicates"](spark, FOLDER).collect()}
    assert got == near_components(documents)


def test_near_duplicates_in_large_groups(spark):
    rng = random.Random(5)
    word = lambda: xxhash.xxh32_hexdigest(str(rng.random()))[:5]
    base, passage = [word() for _ in range(60)], [word() for _ in range(30)]
    texts = []
    for _ in range(90):  # near copies, some of them out of reach of each other
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = word()
        texts.append(" ".join(words))
    texts += [" ".join(passage + [word() for _ in range(rng.randint(2, 12))]) for _ in range(60)]
    texts += [" ".join(passage[:n]) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] * 2
    rows = list(enumerate(texts))
    got = jaccard.op10(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_components(rows)


def test_near_duplicates_odd_rows(odd):
    got = jaccard.op10(odd).collect()
    assert len(got) == len(ROWS)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(1, 1), (2, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 5)]
    assert jaccard.keep_one(odd).columns == odd.columns


def test_one_row_of_each_component_stays(spark):
    near = [" ".join(["same"] + [f"w{i}" for i in range(60)] + [f"end{k}"]) for k in range(4)]
    other = " ".join(f"z{i}" for i in range(40))
    rows = [(None, near[0], "a"), (7, near[1], "b"), (7, near[2], "c"), (9, near[3], "d"), (None, other, "e"), (None, other + " x", "f"), (None, "", "g"), (3, "", "h")]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text == "") for r in got)
    assert ids == [(False, 3, True), (False, 7, False), (True, 0, False), (True, 0, True)]


def test_all_frequent_shingles_are_known(spark, monkeypatch):
    """Ten documents share 205,000 shingles and nine of them 15,000 more, too few to link: these come last in all of them."""
    rng = np.random.default_rng(3)
    said = lambda n: " ".join(map(str, rng.integers(0, 1 << 30, n).tolist()))
    by_ten, by_nine = said(205_000), said(15_000)
    texts = [f"{said(85_000)} {by_ten} {by_nine if i else said(15_000)}" for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(10)
    pairs = []
    find = jaccard.close
    monkeypatch.setattr(jaccard, "close", lambda among, outlines: pairs.append(among.count()) or find(among, outlines))
    got = jaccard.op10(docs).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(i, i) for i in range(10)]
    assert all(r["n_shingles"] == 305_000 - 4 for r in got)
    assert sum(pairs) == 0


def test_frequent_cells_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_HEAVY", 1_000)
    step = (1 << 29) // 4_000
    often = spark.range(4_000).selectExpr(f"id * {step} AS cell", "CASE WHEN id % 10 = 0 THEN 20 + id % 3 WHEN id % 2 = 0 THEN 9 ELSE 8 END AS m")
    cells, counts = jaccard.frequent_cells(often)
    # All of the 400 most frequent, and of the 1,600 next as many as there is room for.
    assert 950 <= len(cells) <= 1_050 and (np.diff(cells.astype(np.int64)) > 0).all()
    assert (counts >= 20).sum() == 400 and set(counts.tolist()) == {9, 20, 21, 22}
    assert jaccard.frequent_cells(often.filter("m > 9"))[0].tolist() == [10 * i * step for i in range(400)]
    known = jaccard.Frequent(cells, counts)
    asked = (np.arange(4_000) * step).astype(np.uint64) << np.uint64(35)
    assert known.how_often(asked)[::10].tolist() == [20 + i % 3 for i in range(0, 4_000, 10)]
    assert (known.how_often(asked) > 0).sum() == len(cells)


def test_boundary_follows_cost():
    few = {n: 1 for n in range(1, 40)}
    assert jaccard.boundary(few, 1000.0, [1e9, 1e9, 1e9, 1e9, 0.0]) == 32
    assert jaccard.boundary({30: 10**6}, 1e7, [1.0, 1.0, 1.0, 1.0, 1.0]) == 0


def test_pipeline_keeps_columns_and_effects(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_pieces", "ids"]
    kept = {r.doc_id for r in got.collect()}
    copies = exact.op4(spark.read.parquet(f"{FOLDER}/documents.parquet")).filter("not kept").select("doc_id", "keep_id").collect()
    assert not any(r.doc_id in kept and r.keep_id in kept for r in copies)


def test_outlines_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for m in (1, 2 * n // 3, 3 * n):
            b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, m, dtype=np.uint64)]))
            assert jaccard.outlines_differ(jaccard.outline(a), jaccard.outline(b)) <= len(np.setxor1d(a, b))
        assert jaccard.outlines_differ(jaccard.outline(a), jaccard.outline(a)) == 0


def test_counted_cells_survive_packing():
    for cells in ([], [0], [7, 7, 7], [1, 5, 1 << 20, (1 << 32) - 1]):
        given = np.array(cells, dtype=np.uint32)
        assert jaccard._from_steps(jaccard._steps(given)).tolist() == cells


CLASHING = "doc_id long, text string, source string, _row long, _d string, _key long, _h long, id long, doc string, name string, src string, node long"


@pytest.mark.parametrize("stage", [exact.drop_duplicates, jaccard.keep_one, mixing.apply_mix])
def test_stages_keep_columns_whatever_their_names(spark, empty, stage):
    rows = [(r[0], r[1], r[2], i, "d", 5, 6, 7, "doc", "name", "src", 8) for i, r in enumerate(ROWS)]
    table = spark.createDataFrame(rows, CLASHING)
    got = stage(table)
    assert got.schema == table.schema
    assert set(map(tuple, got.collect())) <= set(rows) and got.count() > 0
    assert stage(empty).count() == 0 and stage(empty).columns == empty.columns


def test_stages_tell_rows_of_one_id_apart(spark):
    a, b, c = ("x%d " * 30 % tuple(range(k, k + 30)) for k in (0, 100, 200))
    rows = [(1, a), (1, a), (1, b), (None, a), (None, c), (None, c), (2, b), (3, c), (4, ""), (4, ""), (None, None), (5, " ")]
    table = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    key = lambda r: (r is None, repr(r))
    texts_of = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=key)
    assert texts_of(exact.drop_duplicates(table)) == sorted([(1, a), (1, b), (3, c), (4, ""), (5, " ")], key=key)
    everything = [(1, a), (1, b), (3, c), (4, ""), (4, ""), (None, None), (5, " ")]
    assert texts_of(jaccard.keep_one(table)) == sorted(everything, key=key)


def test_null_and_empty_conversations_are_two(spark):
    turns = [(c, t, r, x) for c in (None, "") for t, r, x in ((1, "user", "hi"), (2, "assistant", f"from {c}"))]
    table = spark.createDataFrame([t for t in turns + turns], "conv_id string, turn long, role string, text string")
    got = sorted(((r.conv_id, r.n_calls, r.n_results, r.status, r.json) for r in toolcalls.op2(table).collect()), key=repr)
    assert [g[:4] for g in got] == [("", 2, 2, "linked"), (None, 2, 2, "linked")]
    assert "from None" in got[1][4] and "from None" not in got[0][4]


def test_needed_calls_that_are_missing_are_reported(spark):
    calls = [("c", "a", 1, "reply", '{"prompt":"x","turn":1}', ["gone", "b", "away"]), ("c", "b", 2, "reply", '{"prompt":"y","turn":2}', [])]
    calls = spark.createDataFrame(calls, "conv_id string, call_id string, place long, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([("c", "a", 3, "ok"), ("c", "b", 4, "ok")], "conv_id string, call_id string, place long, content string")
    got = {r.call_id: r for r in toolcalls.link_calls(calls, results, toolcalls.reply_schema(calls)).collect()}
    assert (got["a"].status, got["a"].errors, got["a"].depth) == ("invalid", "needs: no call away; needs: no call gone", 1)
    assert (got["b"].status, got["b"].errors) == ("linked", "")


def rolling(data):
    """Ends of chunks by one byte after the other, from the constants alone."""
    ends, start, h = [], 0, 0
    for i, byte in enumerate(data):
        h = (2 * h + int(chunking.GEAR[byte])) % 2**32
        size = i + 1 - start
        mask = int(chunking.STRICT) if size < chunking.NORMAL else int(chunking.LOOSE)
        if size >= chunking.LARGEST or i + 1 == len(data) or (size >= chunking.LEAST and h & mask == 0):
            ends.append(i + 1)
            start = i + 1
    return ends


def test_chunk_borders_by_a_loop_over_bytes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 8, 9, 31, 32, 33, 400, 5000):
        data = rng.integers(97, 103, n, dtype=np.uint8).tobytes()
        assert chunking.borders(data) == rolling(data)
    assert chunking.borders(b"a" * 1000) == rolling(b"a" * 1000)


def test_fingerprints_of_the_largest_id_and_of_none(spark):
    last = 2**63 - 1
    table = spark.createDataFrame([(last, "the last text"), (None, "none"), (1, "first"), (None, "more")], "doc_id long, text string")
    got = chunking.op9(table).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(["1", "None", "None", str(last)])
    edited = {r.doc_id: r.edited_sha256 for r in got}
    assert edited[1] == hashlib.sha256(b"firs" + b"t").hexdigest()
    after = [hashlib.sha256(b"the last t" + text).hexdigest() for text in (b"non", b"mor")]
    assert edited[last] in after


def test_near_copies_far_from_their_list_equal_all_pairs(spark):
    """Copies of one text with more and more words changed, and copies of those: links beside the largest component."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(150)]

    def changed(words, n):
        words = list(words)
        for at in rng.sample(range(len(words)), n):
            words[at] = f"n{rng.randrange(10**9)}"
        return words

    said = [changed(base, rng.choice([0, 1, 2, 3, 4, 5, 6, 7])) for _ in range(260)]
    for _ in range(12):
        far = changed(base, rng.choice([5, 6, 7, 8]))
        said += [far] * rng.choice([1, 9]) + [changed(far, rng.choice([1, 2, 3])) for _ in range(3)]
    said += [base[:70] + [f"p{i}-{j}" for j in range(rng.choice([10, 20, 80]))] for i in range(60)]
    texts = [" ".join(w) for w in said]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    low = list(range(len(texts)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = root(i), root(j)
                low[max(a, b)] = min(a, b)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.op10(rows).collect()}
    assert got == {i: root(i) for i in range(len(texts))}
    assert len(set(got.values())) > 20
