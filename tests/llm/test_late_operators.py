"""Merkle manifest, periodic runs and URL filters against brute force."""

import hashlib
import random
import zlib

import pytest

from tamarack.llm import merkle, periods, queries, reputation

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, tree long, idx long, n long, digest string, path string"
LONG = "Head " + " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (1, "The cat", "b", "en", 7),
    (2, "Same", "a", None, None),
    (2, "Same", "a", None, None),
    (2, "Other of the same id", "a", "de", 3),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (None, "No Id", None, "fr", 5),
    (None, "No Id", "a", "fr", 5),
    (5, LONG, "é", "en", 30_000),
    *((i, f"Text {i}", "hot", "en", i) for i in range(100, 400)),
    *((i, f"Text {i}", "sixteen", "en", i) for i in range(500, 516)),
    *((i, f"Text {i}", "seventeen", "en", i) for i in range(600, 617)),
    *((i, f"Text {i}", f"small{i}", "en", i) for i in range(700, 720)),
]


def table(spark, rows):
    clash = [(*r, 9, 9, 9, "x", "y") for r in rows]
    return spark.createDataFrame(clash, SCHEMA)


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def tree_of(digests, arity):
    """(root, siblings of each leaf level by level as (before, after) texts)"""
    paths = [[] for _ in digests]
    of = list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + arity] for i in range(0, len(digests), arity)]
        for leaf, at in enumerate(of):
            run, slot = runs[at // arity], at % arity
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            of[leaf] = at // arity
        digests = [H("".join(run)) for run in runs]
    return digests[0], paths


def manifest_of(rows):
    def leaf(doc_id, text, source, lang, n_chars):
        fields = ["-" if f is None else f"{len(str(f).encode())}:{f}" for f in (doc_id, source, lang, n_chars, text)]
        return H("".join(fields))

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = {}
    for r in rows:
        sources.setdefault(r[2], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = members, *tree_of([leaf(*r) for r in members], 16)
    root, tops = tree_of([trees[s][1] for s in order], 16)
    out = []
    for s, top in zip(order, tops):
        members, subroot, paths = trees[s]
        for r, path in zip(members, paths):
            changed = (r[0], None if r[1] is None else r[1].translate(lower), *r[2:]) if crc(r[0]) % 5 == 0 else r
            folded = leaf(*changed)
            for before, after in path + top:
                folded = H(before + folded + after)
            proof = H("".join(b + a for b, a in path + top))
            out.append((r[0], leaf(*r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def test_merkle_agrees_with_brute_force(spark):
    got = sorted((tuple(r) for r in merkle.op11(table(spark, ODD)).collect()), key=repr)
    assert got == manifest_of(ODD)
    assert {True, False} == {r[-1] for r in got}


@pytest.mark.parametrize("rows", [[], ODD[:1], ODD[1:3], ODD[4:5]])
def test_merkle_of_few_rows(spark, rows):
    got = sorted((tuple(r) for r in merkle.op11(table(spark, rows)).collect()), key=repr)
    assert got == (manifest_of(rows) if rows else [])


def test_binary_manifest(spark):
    digests = [H(str(i)) for i in range(37)]
    rows = spark.createDataFrame([("s", i, bytes.fromhex(d)) for i, d in enumerate(digests)], "source string, id long, digest binary")
    out, root = merkle.manifest(rows, order=["id"], arity=2)
    expected, paths = tree_of(digests, 2)
    assert root == expected
    for r in out.collect():
        assert [(s.before.hex(), s.after.hex()) for s in r.path] == paths[r.id]


def brute_runs(words):
    """All runs by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(24, 3 * q) and not any(all(words[k] == words[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def row_of(doc_id, text):
    """The contract's row by brute force."""
    words, space = [], " \t\n\x0b\x0c\r"
    for part in "".join(" " if c in space else c for c in text or "").split(" "):
        words += [part] if part else []
    n, h = len(words), crc(doc_id)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    four = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *four, H("".join(f"{s},{e},{q}\n" for s, e, q in runs)), H(kept)


def random_words(rng):
    kinds, out = rng.choice([1, 2, 3, 5, 50]), []
    while len(out) < rng.choice([30, 100, 250]):
        way = rng.randrange(5)
        if way == 0:
            out += [rng.randrange(kinds) for _ in range(rng.randrange(20))]
        elif way == 1:
            unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 12))]
            out += (unit * 40)[: rng.randrange(10, 120)]
        elif way == 2 and out:
            a = rng.randrange(len(out))
            unit = out[a : a + rng.randrange(1, 40)]
            out += (unit * 9)[: rng.randrange(len(unit) * 6 + 1)]
        elif way == 3 and out:
            a = rng.randrange(len(out))
            out += out[a : a + rng.randrange(1, 60)]
        else:
            out.append(rng.randrange(1000))
    return [str(w) for w in out]


def test_runs_agree_with_brute_force():
    rng = random.Random(3)
    for _ in range(120):
        lists = [random_words(rng) for _ in range(rng.choice([1, 3, 8]))]
        got = periods.runs_of([[w.encode() for w in t] for t in lists])
        assert [[tuple(r) for r in runs] for runs in got] == [brute_runs(t) for t in lists]


def test_runs_of_structured_words():
    a, b = ["a"], ["b"]
    for _ in range(12):
        a, b = b, b + a
    for words in (b, ["x"] * 23, ["x"] * 24, (["x"] * 8 + ["y"]) * 12, ["p", "q"] * 12 + ["r"] + ["p", "q"] * 12):
        assert [tuple(r) for r in periods.runs_of([[w.encode() for w in words]])[0]] == brute_runs(words)


def test_long_runs_are_found_in_near_linear_time():
    words = [str(i % 977).encode() for i in range(200_000)]
    assert periods.runs_of([words]) == [[periods.Run(0, 200_000, 977)]]
    assert periods.runs_of([[b"a"] * 200_000]) == [[periods.Run(0, 200_000, 1)]]


def test_periodic_rows_of_odd_texts(spark):
    rng = random.Random(5)
    rows = [(i, " \t".join(random_words(rng)) + "\u00a0x\u2003y\x1cz\x85") for i in range(200)]
    rows += [(None, None), (None, "a b c " * 30), (7, ""), (7, " \n"), (8, "one"), (8, "one"), (5, "ä\u00a0b " * 50)]
    got = periods.op12(table(spark, [(*r, None, None, None) for r in rows])).collect()
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted((row_of(*r) for r in rows), key=key)
    pieces = periods.periodic_runs(table(spark, [(*r, None, None, None) for r in rows]), piece=50).collect()
    assert sorted(map(tuple, pieces), key=key) == sorted(map(tuple, got), key=key)
    assert periods.op12(table(spark, [])).count() == 0


def test_periodic_rows_of_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_periodic_runs"](spark, FOLDER).collect()
    key = lambda r: repr(tuple(r))
    short = {r.doc_id for r in docs if len((r.text or "").split()) <= 600}
    assert len(short) > 100 and len(got) == len(docs)
    assert sorted((tuple(r) for r in got if r.doc_id in short), key=key) == sorted((row_of(*d) for d in docs if d.doc_id in short), key=key)
    assert any(r.n_runs for r in got)


URLS = [
    (1, "https://a.example.org/es/1"),
    (2, "https://example.org/en/123"),
    (3, "http://x.ORG/Q"),
    (4, "https://notexample.org/es/1"),
    (5, "https://example.org"),
    (6, "https://com/fr/x?y=://z"),
    (7, "HTTP://User@Shop.Com:80/de/?a#b"),
    (8, "https://shop.com/en/1"),
    (9, "no scheme"),
    (9, "no scheme"),
    (None, None),
    (10, "://"),
    (11, "x://é.net?q"),
    (12, "https://www.shop.co.uk/de/"),
    (13, "https://1.2.3.4/de/"),
    (14, "https://shop.com/de"),
    (15, "https://shop.comm/fr/"),
]


def judge(url):
    """(host, path, rule, the rule's verdict) of the contract."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    stop = min([rest.find(c, end) for c in "?#" if rest.find(c, end) >= 0], default=len(rest))
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:stop]
    fits = [r for r in reputation.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    top = max(fits, key=lambda r: len(r[0] + r[1]), default=(None,) * 3)
    return host, path, None if top[0] is None else top[0] + top[1], top[2]


def urls(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", "n") for r in rows], "page_id long, url string, host string, path string, name string")


def test_url_parts_and_rules(spark):
    got = sorted((tuple(r)[:5] for r in reputation.op13(urls(spark, URLS)).collect()), key=repr)
    for (_, _, _, rule, verdict), (page, url) in zip(got, sorted(URLS, key=lambda u: repr((u[0], *judge(u[1])[:2])))):
        assert (rule, verdict if rule else None) == judge(url)[2:]
    assert [r[:3] for r in got] == sorted(((p, *judge(u)[:2]) for p, u in URLS), key=repr)
    assert reputation.op13(urls(spark, [])).count() == 0


def strength_of(groups):
    """The estimate of the docstring, from (n, bad, mean above)."""
    known = [(n, y, m) for n, y, m in groups if n and 0 < m < 1]
    pairs = sum(n * (n - 1) for n, _, _ in known)
    if not pairs:
        return 2.0
    excess = sum((y - n * m) ** 2 / (m * (1 - m)) - n for n, y, m in known)
    return 1 / min(max(excess / pairs, 1 / 10_001), 1 / 1.1) - 1


def test_reputation_is_drawn_to_what_is_above(spark):
    hosts = {  # name: (domain, suffix, labelled, bad)
        "a.bad.com": ("bad.com", "com", 40, 38),
        "b.bad.com": ("bad.com", "com", 30, 29),
        "new.bad.com": ("bad.com", "com", 0, 0),
        "a.good.com": ("good.com", "com", 50, 1),
        "b.good.com": ("good.com", "com", 20, 0),
        "once.good.com": ("good.com", "com", 1, 1),
        "fine.net": ("fine.net", "net", 60, 0),
        "unknown.net": ("unknown.net", "net", 0, 0),
        "x.y.co.uk": ("y.co.uk", "co.uk", 12, 11),
    }
    pages = []
    for host, (_, _, n, bad) in hosts.items():
        pages += [(f"http://{host.upper()}:80/p{i}", i < bad) for i in range(n)] + [(f"http://{host}/new", None)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, bad boolean")
    got = {r.host.split(":")[0]: r for r in reputation.judged(rows, rules=(), bad=rows["bad"]).collect()}

    total = lambda at, key: {
        k: [sum(h[i] for h in hosts.values() if h[at] == k) for i in (2, 3)] for k in {h[at] for h in hosts.values()}
    }
    whole = [sum(h[i] for h in hosts.values()) for i in (2, 3)]
    above = dict.fromkeys(total(1, None), (whole[1] + 0.5) / (whole[0] + 1))
    for at in (1, 0):
        counts = total(at, None)
        strength = strength_of([(*counts[k], above[k]) for k in counts])
        drawn = {k: (y + strength * above[k]) / (n + strength) for k, (n, y) in counts.items()}
        above = {h[0]: drawn[h[1]] for h in hosts.values()} if at else drawn
    strength = strength_of([(n, y, above[d]) for d, _, n, y in hosts.values()])
    for name, (domain, _, n, y) in hosts.items():
        share = (y + strength * above[domain]) / (n + strength)
        bound = share - 1.645 * (share * (1 - share) / (n + strength + 1)) ** 0.5
        r = got[name]
        assert (r.evidence, r.bad_share) == (n, pytest.approx(share, abs=2e-6))
        assert r.bound == pytest.approx(max(bound, 0), abs=2e-6)
        assert r.verdict == ("block" if bound >= 0.5 else "allow")
    assert {n for n in hosts if got[n].verdict == "block"} >= {"a.bad.com", "b.bad.com", "x.y.co.uk"}
    assert got["once.good.com"].verdict == got["unknown.net"].verdict == "allow"
