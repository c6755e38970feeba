"""Operators against plain Python, and on NULLs, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import itertools
import random
import time
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from brute import LONG, ODD
from pyspark.sql import functions as F

from factorloom.llm import bpe, decon, graph, html, jaccard, linededup, packing, quality, secrets, shards, urls

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# --- quality rules ---


def test_quality_features(odd, none):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    got = rows(quality.features(odd), "doc_id", *names)
    assert got == sorted(((d, *brute.quality(t)) for d, t, _ in ODD), key=repr)
    assert quality.features(none).count() == 0


def test_quality_repeats(make):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += ["x y z\n" * 30, "a " * 7, "a " * 8, "a " * 9, "1 2 3 4 5 6 7 8 9 " * 2]
    got = rows(quality.features(make([(i, t, "s") for i, t in enumerate(texts)])), "doc_id", "n_repeat_words", "n_dup_lines")
    assert got == sorted(((i, brute.quality(t)[4], brute.quality(t)[3]) for i, t in enumerate(texts)), key=repr)


def test_cascade_order_does_not_matter(odd, none):
    verdicts = {repr(rows(quality.judge(odd, o).where("rejected_by is null"), "doc_id")) for o in (quality.RULES, quality.RULES[::-1])}
    assert len(verdicts) == 1
    good = quality.keep_good(odd)
    assert good.columns == odd.columns and repr(rows(good, "doc_id")) in verdicts
    assert quality.keep_good(none).count() == 0
    assert quality.order_rules(none) == list(quality.RULES)
    assert sorted(r.name for r in quality.order_rules(odd)) == sorted(r.name for r in quality.RULES)


# --- URL filter ---


def test_urls(spark):
    rules = [("com", "/en/", "block"), ("a.com", "/en/7", "allow"), ("a.com", "/en/7", "block"), ("b.org", "", "block"), (None, "/", "block"), ("c.d", None, "allow")]
    pages = [
        (1, "http://X.A.com/en/70?q"), (1, "http://X.A.com/en/70?q"), (2, "https://com/en/"), (3, "http://xcom/en/"), (4, "http://b.org"), (5, None),
        (6, "no scheme"), (7, "a://b.org://c"), (8, "ftp://z.b.org?x/y"), (None, "http://c.d/"), (9, "http://com/en"), (10, "http://" + "a." * 2000 + "com/en/" + "x" * 5000),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumns({c: F.lit("?") for c in ("key", "host", "path", "rule", "tail", "head")})
    got = {r.page_id: (r.rule, r.verdict) for r in urls.verdicts(df, spark.createDataFrame(rules, "host string, path string, action string")).collect()}
    assert got == {
        1: ("a.com/en/7", "block"), 2: ("com/en/", "block"), 3: (None, "allow"), 4: ("b.org", "block"), 5: (None, "allow"), 6: (None, "allow"),
        7: (None, "allow"), 8: ("b.org", "block"), None: ("c.d", "allow"), 9: (None, "allow"), 10: ("com/en/", "block"),
    }
    empty = spark.createDataFrame([], "host string, path string, action string")
    assert {r.verdict for r in urls.verdicts(df, empty, default="block").collect()} == {"block"}
    assert urls.verdicts(df.limit(0), empty).count() == 0


# --- BPE ---


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_like_tiktoken(tiktoken_encoding):
    rng = random.Random(5)
    points = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    pools = [points, points[32:127], " \n\t\r\x0b\x0c\xa0\u3000\x85ab1'sé", points[:0x3000]]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.choice([0, 1, 9, 60]))) for _ in range(2000)]
    texts += ["".join(rng.choice(p) for _ in range(200)) for p in pools] + ["<|endoftext|> it's  two", "x" * 5000, LONG]
    codec = bpe.codec(RANKS, PATTERN)
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_encoding.encode_ordinary(text)
        assert codec.decode(ids) == text.encode() and codec.encode([text]) == [ids]


def split_token(token, ranks):
    """The two parts that are merged last when ``token`` is built from lower ranks."""
    parts, below = [bytes([b]) for b in token], ranks[token]
    while len(parts) > 2:
        near = [ranks.get(a + b, below) for a, b in zip(parts, parts[1:])]
        i = min(range(len(near)), key=near.__getitem__)
        if near[i] >= below:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def test_bpe_like_merges():
    """Each match as a BPE model of the ``tokenizers`` library has it, whose merges are made from the ranks."""
    from tokenizers import models

    ranks, char, rng = bpe.read_ranks(RANKS), bpe.byte_characters(), random.Random(6)
    shown = lambda token: "".join(char[b] for b in token)
    pairs = [split_token(t, ranks) for t in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__)]
    model = models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=[(shown(p[0]), shown(p[1])) for p in pairs if len(p) == 2])
    words = ["".join(rng.choice("etaoinéßñ一") for _ in range(rng.randint(1, 12))) for _ in range(3000)] + ["x" * 5000]
    for word, ids in zip(words, bpe.codec(RANKS, PATTERN).encode(words)):
        assert np.frombuffer(ids, "<u4").tolist() == [t.id for t in model.tokenize(shown(word.encode()))]


def test_bpe_merges_a_match_once_a_batch(monkeypatch):
    codec, calls = bpe.Codec(RANKS, PATTERN), []
    merge = codec.merged
    codec.merged = lambda m: calls.append(m) or merge(m)
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 20)  # several parts a batch
    texts = ["a b a b", "", "b a"] * 50
    assert codec.encode(texts) == codec.encode(texts[:3]) * 50
    assert sorted(calls) == sorted([b"a", b" b", b" a", b"b"] * 2)
    assert codec.encode([]) == [] and codec.encode(["", ""]) == [b"", b""]
    sizes = np.array([1000] * 3000 + [bpe.PART + 1, 5])
    cuts = [(s.start, s.stop) for s in bpe.pieces(sizes, sizes, bpe.ROWS, bpe.CHARS)]
    assert cuts == [(0, 3000), (3000, 3001), (3001, 3002)]  # a long text is encoded by parts


def test_bpe_split_like_the_pattern(monkeypatch):
    import regex

    assert PATTERN == bpe.SPLIT  # else all is left to the regex engine
    rng = random.Random(9)
    pools = [" \n\t\xa0\u3000a1'sé.", "' strevmldTL", [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]]
    texts = ["".join(rng.choice(pools[i % 3]) for _ in range(rng.choice([0, 1, 2, 5, 60]))) for i in range(3000)]
    texts += ["", "a \n\n", "\n\nb", "'re'll 's''s", " 's", "x  's", "'l", "l'", "  ", "it's"]
    ends = np.cumsum([len(t) for t in texts])
    starts = bpe.match_starts(bpe.code_points("".join(texts)), np.array([e - len(t) for e, t in zip(ends, texts) if t]))
    want = [e - len(t) + m.start() for e, t in zip(ends.tolist(), texts) for m in regex.finditer(PATTERN, t)]
    assert starts.tolist() == want
    codec, other = bpe.codec(RANKS, PATTERN), bpe.Codec(RANKS, f"(?:{PATTERN})")  # the second is found match by match
    calls = []
    monkeypatch.setattr(codec, "looked_up", lambda m: calls.append(len(m)) or bpe.Codec.looked_up(codec, m))
    assert codec.encode(["a b a b"] * 50) == other.encode(["a b a b"] * 50) and calls == [3]
    assert codec.encode(texts) == other.encode(texts) == [x for t in texts for x in other.encode([t])]
    monkeypatch.setattr(bpe, "PART", 7)
    monkeypatch.setattr(bpe, "MATCHES", 3)
    monkeypatch.setattr(bpe, "CACHED", 20)
    assert [x for t in texts for x in codec.encode([t])] == other.encode(texts) == [x for t in texts for x in other.encode([t])]


def test_bpe_offsets(odd, none):
    coded = bpe.encode(odd, RANKS, PATTERN, offsets=True, decoded=True)
    texts = Counter((d, t or "") for d, t, _ in ODD)
    for r in coded.collect():
        text = bytes(r.decoded).decode()
        assert texts[r.doc_id, text] > 0 and r.n_tokens == len(r.starts) == len(r.ids) // 4
        codec, at = bpe.codec(RANKS, PATTERN), 0
        character = [i for i, c in enumerate(text) for _ in c.encode()]  # of each byte
        for i, a, z in zip(np.frombuffer(r.ids, "<u4").tolist(), r.starts, r.ends):
            assert (a, z) == (character[at], character[at + len(codec.bytes[i]) - 1] + 1)
            at += len(codec.bytes[i])
    assert bpe.encode(none, RANKS, PATTERN).count() == 0
    back = bpe.decode(coded.withColumn("ids", F.when(F.col("doc_id") != 2, F.col("ids"))), RANKS, PATTERN, out_col="back")
    assert all(r.back is None if r.doc_id in (2, None) else r.back == r.decoded for r in back.collect())


# --- packing ---


def test_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(60):
        length = rng.randint(1, 40)
        sizes = sorted((rng.randint(1, length) for _ in range(rng.randint(0, 80))), reverse=True)
        free, count = [], 0
        for s in sizes:  # the same rule by linear search
            fits = [c for c in free if c >= s]
            free.remove(min(fits)) if fits else None
            count += not fits
            free.append((min(fits) if fits else length) - s)
        bins = packing.best_fit(sizes, length)
        assert len(bins) == count and sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[i] for i in b) for b in bins) == sorted(free)


@pytest.mark.parametrize("width", [1, 2, 4])
def test_packing_round_trip(spark, none, width):
    rng = random.Random(width)
    docs = [(i, rng.randbytes(width * rng.choice([0, 1, 5, 16, 17, 40, 333]))) for i in range(200)] + [(900, None), (901, b"")]
    df = spark.createDataFrame(docs, "doc_id long, ids binary").withColumns({c: F.lit("?") for c in ("key", "block", "bin", "start")})
    packed = packing.pack(df, 16, width, pad=7, block_tokens=500).cache()
    assert {r.doc_id: bytes(r.ids) for r in packing.unpack(packed, width).collect()} == {i: x for i, x in docs if x}
    for r in packed.collect():
        assert len(r.ids) == 16 * width and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 16
        assert r.resets == r.cu_seqlens[:-1] and len(r.doc_ids) == len(r.doc_starts) == len(r.resets)
        assert bytes(r.ids[r.n_tokens * width :]) == (7).to_bytes(width, "little") * (16 - r.n_tokens)
    again = packing.pack(df.repartition(7), 16, width, pad=7, block_tokens=500)
    assert rows(packed, *packed.columns) == rows(again, *packed.columns)
    assert packing.pack(none.select("doc_id", F.encode("text", "UTF-8").alias("ids")), 8).count() == 0


def test_packing_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, b"ab")] * 5 + [(None, b"c"), (None, b"c")], "doc_id long, ids binary")
    assert sum(r.n_tokens for r in packing.pack(df, 8, 1).collect()) == 12


def test_packing_by_a_column_of_sizes(spark):
    docs = [(i, bytes(4 * (i % 37))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, ids binary").withColumn("n", F.octet_length("ids") / 4)
    packed = [packing.pack(df, 16, block_tokens=200, size_col=c) for c in (None, "n")]
    assert rows(packed[0], *packed[0].columns) == rows(packed[1], *packed[1].columns)


# --- decontamination ---


def test_masks_miss_nothing():
    for lost in itertools.combinations(range(decon.SPAN), decon.CHANGED):
        kept = ["0" if i in lost else "1" for i in range(decon.SPAN)]
        assert any(
            all(kept[at + k] == "1" for k, bit in enumerate(m) if bit == "1") for m in decon.MASKS for at in range(decon.SPAN - len(m) + 1)
        )
    for n in range(9, decon.SPAN):
        for lost in itertools.combinations(range(n), (n >= 9) + (n >= 13) + (n >= 17)):
            places = ((m, at) for m in decon.MASKS for at in range(n - len(m) + 1))
            assert any(not any(bit == "1" and at + k in lost for k, bit in enumerate(m)) for m, at in places), (n, lost)


def test_short_items_with_changes(spark, make):
    """A changed word hides no short item, nor does a filter that lets all through."""
    rng = random.Random(11)
    items = [(n, [f"i{n}x{k}" for k in range(n)]) for n in range(1, 22)]
    docs, want = [], []
    for n, w in items:
        for changed in range(6):
            x = list(w)
            for k in rng.sample(range(n), min(n, changed)):
                x[k] += "y"
            docs.append((100 * n + changed, " ".join(["before", *x, "after"]), "s"))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    want = sorted((d, n) for d, t, _ in docs for n, w in items if brute.overlap(t, " ".join(w)))
    assert rows(decon.overlaps(make(docs), bench), "id", "item") == sorted(want, key=repr)
    assert {d for d, _ in want} >= {901, 1302, 1703, 1903, 2004} and not {d for d, _ in want} & {801, 902, 1303, 1704, 1904}


def test_overlaps(spark, make, odd, none):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(n))) for i, n in enumerate([20, 25, 40, 19, 12, 6, 3, 1, 0])] + [(50, None), (None, " ".join(draw(30)))]
    docs = []
    for i in range(50):
        w = draw(rng.randint(0, 30))
        item = brute.tokens(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(item) - 20))
        part = item[a : a + rng.randint(12, 40)]
        for _ in range(rng.randint(0, 6)):
            if part:
                part[rng.randrange(len(part))] = "changed"
        docs.append((i, " ".join(w + [p.upper() if rng.random() < 0.2 else p + "," for p in part] + draw(rng.randint(0, 30))), "s"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("?") for c in ("item", "h", "seed", "mask", "at")})
    table = make(docs)
    got = rows(decon.overlaps(table, bench), "id", "item", "matches", "doc_start", "item_start")
    want = [(d, i, *o) for d, t, _ in docs for i, x in items if (o := brute.overlap(t, x))]
    assert got == sorted(want, key=repr) and len(want) > 12
    clean = decon.clean(table, bench)
    assert clean.columns == table.columns and rows(clean, "doc_id") == sorted(((d,) for d, _, _ in docs if d not in {w[0] for w in want}), key=repr)
    assert decon.overlaps(none, bench).count() == 0 and decon.overlaps(table, bench.limit(0)).count() == 0
    assert decon.clean(odd, bench.where("item_id < 5")).count() == len(ODD)
    hit = decon.overlaps(odd, spark.createDataFrame([(1, "two words")], "item_id long, text string")).collect()
    assert [(r.id, r.item, r.matches) for r in hit] == [(None, 1, 2)]


def test_clean_judges_rows_of_one_id_by_their_texts(spark, make):
    item, other = " ".join(f"q{i}" for i in range(25)), " ".join(f"z{i}" for i in range(25))
    docs = [(None, f"a {item} b", "s"), (None, other, "s"), (None, None, "s"), (7, item, "s"), (7, other, "s"), (7, other, "s"), (8, other, "s")]
    left = decon.clean(make(docs), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((d, t) for d, t, _ in docs if item not in (t or ""))


# --- HTML ---


def test_best_run():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randint(-4, 4) for _ in range(rng.randint(0, 12))]
        a, z = html.best_run(s)
        best = max([sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)], default=0)
        assert sum(s[a:z]) == max(0, best)


PAGE = (
    "<html><head><title>T</title></head><body><nav><a>home</a></nav><div id=cookie-notice>We use cookies here and there</div>{}"
    "<div class='comments'><p>I like this text a lot and so on.</p></div><script>x('<p>no</p>')</script><footer>&copy; me</footer></body></html>"
)
ARTICLE = "<h1>Head line</h1><p>One <b>two</b>three &amp; four\n  five&nbsp;six<br>seven<p>Eight <!-- no --> nine ten eleven."
TEXT = "Head line One twothree & four five six seven Eight nine ten eleven."


def test_main_text(spark):
    pages = [(i, "u", PAGE.format(f"<{t}>{ARTICLE}</{t}>")) for i, t in enumerate(["article", "main", "div class=post"])]
    pages = [(i, u, h.replace("</div class=post>", "</div>")) for i, u, h in pages] + [(3, None, None), (None, "u", ""), (4, "u", "<p>only <i>this"), (4, "u", "<p>only <i>this")]
    pages += [(5, "u", PAGE.format("<article>" + "<p>" + "long text &lt; " * 20000 + "</article>")), (6, "u", "plain & simple < text"), (7, "u", "<script>never"), (8, "u", "<p>ok</p><a href='x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("?") for c in ("key", "text", "n_chars", "h")})
    got = [(r.page_id, r.text) for r in html.extract(df, html.train(df)).collect()]
    assert Counter(got) == Counter(
        [(0, TEXT), (1, TEXT), (2, TEXT), (3, ""), (None, ""), (4, "only this"), (4, "only this"), (5, ("long text < " * 20000).strip()),
         (6, "plain & simple < text"), (7, ""), (8, "ok")]
    )
    assert html.extract(df.limit(0), html.train(df.limit(0))).count() == 0
    assert html.main_text(PAGE.format(f"<div>{ARTICLE}</div>"), html.fit(Counter())) == TEXT


def main_of(page):
    return html.main_text(page, html.fit(Counter()))


def test_main_text_after_hidden_elements():
    for head in ("<head><title>t</title>", "<head><meta charset=x><link rel=a href='b'>", "<head><style>a</style><!-- c -->", "<head></head>"):
        assert main_of(head + "<body><article><p>whole text") == main_of(head + "<p>whole text") == "whole text"
    assert main_of('<p>a b <svg class="i"/> c d</p><p>e <math/> f</p>') == "a b c d e f"
    assert main_of("<div><svg class=i><path d=1><p>text here</p></div><svg></svg>") == "text here"
    assert main_of("<p>x <svg><title>no</title><foreignObject><div>no</div></foreignObject></svg> y <math><mi>no</mi></math> z") == "x y z"


def test_main_text_in_wrappers():
    marks = ("class='content has-sidebar'", "class='page with-header'", "class=main-search-layout", "id='form-wrap'", "class='sidebar'")
    for tag, mark in [*(("div", m) for m in marks), ("form", "method=post"), ("form", "class=search")]:
        for inner in (ARTICLE, f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>"):
            assert main_of(PAGE.format(f"<{tag} {mark}>{inner}</{tag}>")) == TEXT
    small = "<div class='related-posts'>see this too</div><form><p>your mail here</p></form><div class=sidebar><article>one</article><article>two</article></div>"
    assert main_of(PAGE.format(f"<div>{ARTICLE}</div>{small}")) == TEXT
    assert html.main_text(f"<p>{TEXT}</p><form><p>your mail</p></form>", html.Weights({"form": 0.5}, {})) == f"{TEXT} your mail"


def test_main_text_around_an_article():
    words = " ".join(f"w{i}" for i in range(40))
    page = PAGE.format(f"<div><h1>Lead in</h1><p>{words}</p><article><p>a card of few words</p></article><p>{words}</p></div>")
    assert main_of(page) == f"Lead in {words} a card of few words {words}"


MARKED = "comment-body comment-content comments-area post-comments-container sidebar-inner footer-content nav-wrapper menu-container cookie-container related-content".split()


@pytest.mark.parametrize("name", MARKED)
def test_main_text_without_marked_elements(name):
    words, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"c{i}" for i in range(20))
    for page in (
        f"<article><p>{words}</p><div class='{name}'><p>{other}</p></div></article>",
        f"<div><p>{words}</p><div class='x {name}'><p>{other}</p></div></div>",
        f"<article><p>{words}</p></article><section id={name}>{other}</section>",
        f"<div class='{name}'>{other}</div><main><p>{words}</p></main>",
    ):
        assert main_of(PAGE.format(page)) == words, page


def test_main_text_with_comments():
    words, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"c{i}" for i in range(90))
    page = f"<article><p>{words}</p></article>" + f"<article class='comment'><p>{other}</p></article>" * 5
    assert main_of(PAGE.format(page)) == words
    assert main_of(PAGE.format(f"<article class='comment'><p>{words}</p></article>")) == words  # the page's only one
    for name in ("comments-open", "comments-area", "content has-sidebar", "page with-header", "main-search-layout"):
        assert main_of(PAGE.format(f"<div class='{name}'><article><p>{words}</p></article></div>")) == words


#: Pages without article or main: what stands around a text of 60 words and is no part of it.
AROUND = [
    "<div>{0}</div>", "<nav>{1}</nav><div>{0}</div>", "<div>{0}</div><footer>{1}</footer>", "<header><h2>{1}</h2></header><div>{0}</div>",
    "<div id='menu'>{1}</div><div>{0}</div>", "<div>{0}</div><div class='ads'>{1}</div>", "<table><tr><td class='sidebar'>{1}</td><td>{0}</td></tr></table>",
    "<div>{0}<div class='share-buttons'>{1}</div></div>", "<div class='cookie-notice'>{1}</div><section>{0}</section>",
    "<section>{0}</section><div id='comments'><p>{1}</p><p>{1}</p></div>", "<div>{0}</div><script>{1}</script>", "<style>{1}</style><div>{0}</div>",
    "<div>{0}<!-- {1} --></div>", "<aside>{1}</aside><div>{0}</div>", "<div>{0}<ul class='related-posts'><li>{1}</li></ul></div>",
    "<ul class='breadcrumb'><li>{1}</li></ul><div>{0}</div>", "<div>{0}<ol class='comment-list'><li>{1}</li></ol></div>",
    "<div class='page-wrapper'><div class='site-header'>{1}</div><div>{0}</div></div>", "<div>{0}</div><div role='contentinfo'>{1}</div>",
    "<div>{0}</div><p class='copyright'>{1}</p>",
]


@pytest.mark.parametrize("around", AROUND)
def test_pages_without_article(around):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    page = PAGE.format(around.format(f"<h1>A title</h1><p>{a}</p><p>{b} <b>bold</b> &amp; more</p>", "other words that stand beside it"))
    assert main_of(page) == f"A title {a} {b} bold & more"


@pytest.mark.parametrize("part", ["<div>x", "x</p>", "<article>", "<p>x</b>", "<b class=ad>x"])
def test_deep_pages_take_time_in_proportion(part):
    began = time.perf_counter()
    main_of(part * 200_000)
    assert time.perf_counter() - began < 20


# --- sharding ---


@pytest.mark.parametrize("n_shards", [1, 3, 16])
def test_shards(make, odd, none, n_shards):
    docs = [(i, f"text {i % 40}", f"s{i % 7 % 3}") for i in range(500)]
    out = shards.assign(make(docs), n_shards).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _, _ in docs)
    source = {d: s for d, _, s in docs}
    per = Counter(r.shard for r in out)
    assert max(per.values()) - min(per.values()) <= 1 and set(per) == set(range(n_shards))
    for s in range(n_shards):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(per[s]))
        for name, n in Counter(source.values()).items():
            assert abs(sum(source[r.doc_id] == name for r in out if r.shard == s) - n / n_shards) <= 3
    again = shards.assign(make(docs, 5), n_shards)
    assert rows(again, "doc_id", "shard", "slot") == sorted(((r.doc_id, r.shard, r.slot) for r in out), key=repr)
    got = Counter((r.doc_id, r.size, r.text_crc32) for r in shards.assign(odd, n_shards).collect())
    assert got == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in ODD)
    assert shards.assign(none, n_shards).count() == 0


def test_shards_in_plain_python(make):
    """Order and cuts: fractional ranks of rows shuffled within their source, from the same hashes."""
    docs = [(i, f"text {i % 60}", f"s{i % 7 % 3}" if i % 10 else None) for i in range(300)]
    table, seed, n_shards = make(docs), 5, 7
    hashes = table.select("doc_id", "text", "source", F.xxhash64(F.lit(seed), "text"), F.xxhash64(F.lit(seed + 1), "doc_id")).collect()
    sources = {}
    for d, t, s, shuffled, tie in hashes:
        sources.setdefault("" if s is None else "=" + s, []).append((shuffled, tie, d, zlib.crc32(t.encode()), len(t.encode()) + 1))
    every = []
    for s, mine in sources.items():
        every += [((2 * r + 1) / (2 * len(mine)), s, *x) for r, x in enumerate(sorted(mine))]
    want, used = {}, Counter()
    for at, (_, _, _, _, d, *_rest) in enumerate(sorted(every)):
        shard = at * n_shards // len(every)
        want[d] = (shard, used[shard])
        used[shard] += 1
    got = {r.doc_id: (r.shard, r.slot) for r in shards.assign(table, n_shards, seed).collect()}
    assert got == want


def test_write_shards(spark, make, tmp_path):
    docs = make([(i, f"t{i}", "s") for i in range(30)]).select("doc_id", "text")
    shards.write_shards(docs, shards.assign(docs.withColumn("source", F.lit("s")), 4), str(tmp_path / "out"))
    assert Counter(r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("shard").collect()) == Counter({0: 8, 1: 7, 2: 8, 3: 7})


# --- n-gram Jaccard join ---


def near(rng, base, share):
    return [rng.choice("abcdefgh") + str(rng.randint(0, 99)) if rng.random() < share else w for w in base]


@pytest.mark.parametrize("k,percent,listed", [(4, 85, 32), (4, 85, 2), (5, 80, 3), (1, 50, 2), (2, 100, 32)])
def test_components(make, monkeypatch, k, percent, listed):
    monkeypatch.setattr(jaccard, "LISTED", listed)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rng = random.Random(k * percent + listed)
    texts = []
    for _ in range(12):
        base = near(rng, [""] * rng.choice([1, 3, 6, 20, 60, 150]), 1)
        for _ in range(rng.choice([1, 2, 12, 40])):
            w = near(rng, base, rng.choice([0, 0.01, 0.03, 0.1]))
            texts.append(rng.choice([" ", "\n", "  "]).join(x.upper() if rng.random() < 0.1 else x for x in w))
    docs = [(i * 3 % 1009, t, "s") for i, t in enumerate(texts)]
    got = rows(jaccard.components(make(docs), k, percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components([(d, t) for d, t, _ in docs], k, percent), key=repr)


def test_components_odd(odd, none):
    got = rows(jaccard.components(odd), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components([(d, t) for d, t, _ in ODD], 4, 85), key=repr)
    assert jaccard.components(none).count() == 0 and jaccard.keep_one(none).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 6, 7, 8, 8, None, None])


def test_keep_one_of_rows_that_share_an_id(make):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near_a = a + " more"
    docs = [(None, a, "s"), (None, near_a, "s"), (None, b, "s"), (3, b, "s"), (5, c, "s"), (5, c + " more", "s"), (5, a + " again", "s"), (5, "alone", "s")]
    docs += [(9, "stored often", "s")] * 20 + [(None, "stored without id", "s")] * 3 + [(None, " ", "s")] * 2 + [(11, None, "s")]
    for k in (0, 1):
        kept = jaccard.keep_one(make(docs[::-1] if k else docs, 4)).collect()
        got = Counter((r.doc_id, r.text) for r in kept if r.text not in (c, c + " more"))
        assert got == Counter({(5, a + " again"): 1, (3, b): 1, (5, "alone"): 1, (9, "stored often"): 1, (None, "stored without id"): 1, (None, " "): 2, (11, None): 1})
        assert sum(r.text in (c, c + " more") for r in kept) == 1


def test_sets_are_one_for_each_node(spark, make, monkeypatch):
    text = " ".join(f"a{i}" for i in range(60))
    docs = make([(1, text, "s")] * 30 + [(1, text + " b", "s"), (1, "c d e", "s"), (None, text + " d", "s"), (None, text + " e", "s")])
    made, real = [], jaccard._sets
    monkeypatch.setattr(jaccard, "_sets", lambda *a: made.append(real(*a)) or made[-1])
    jaccard.components(docs).collect()
    assert Counter(r.node for r in made[0].collect()).most_common(1)[0][1] == 1 and made[0].count() == 4


def test_nothing_that_grows_with_the_documents_is_broadcast(make, monkeypatch):
    rng, held = random.Random(5), []
    monkeypatch.setattr(jaccard, "small_side", lambda df, n, limit: held.append(n) or df)
    texts = [" ".join(near(rng, [""] * 60, 1)) for _ in range(40)]
    docs = [(i, t + end, "s") for i, t in enumerate(texts * 2) for end in (["", " more"] if i < 40 else [""])]
    got = rows(jaccard.components(make(docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components([(d, t) for d, t, _ in docs], 4, 85), key=repr)
    assert max(held, default=0) < 10  # at most nodes that several tasks left


def test_filters_that_let_others_pass(make, monkeypatch):
    monkeypatch.setattr(jaccard, "FILTER_LEAST", 3)
    monkeypatch.setattr(jaccard, "FILTER_MOST", 6)
    monkeypatch.setattr(jaccard, "FILTER_PART", 16)
    rng = random.Random(6)
    texts = [" ".join(near(rng, [""] * 40, 1)) for _ in range(20)]
    texts = [t + end for t in texts for end in ("", "", " more")] + [" ".join(near(rng, [""] * 30, 1)) for _ in range(30)]
    docs = [(i // 2, t, "s") for i, t in enumerate(texts * 2)] + [(3, texts[0], "s")] * 20
    got = rows(jaccard.components(make(docs, 7)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components([(d, t) for d, t, _ in docs], 4, 85), key=repr)


def test_filter_passes_its_values(spark):
    df = spark.range(0, 5000, 1, 6).select(F.xxhash64("id").alias("h"))
    bits = jaccard._filter(df, 5000)
    assert len(bits) == 1 << 14 and jaccard._filter(df.limit(0), 0) == bytes(1 << 13)
    here, other = (np.array([r.h for r in x.collect()], np.int64) for x in (df, spark.range(5000, 25000).select(F.xxhash64("id").alias("h"))))
    passes = lambda x: jaccard._passes(x, np.frombuffer(bits, np.uint8))
    assert passes(here).all() and passes(other).mean() < 0.03


def test_graph(spark):
    rng = random.Random(9)
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("star", f"s{i}") for i in range(30)] + [("loop", "loop")]
    pairs += [(f"r{rng.randint(0, 40)}", f"r{rng.randint(0, 40)}") for _ in range(25)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "u string, v string")).collect()}
    assert len({got[f"n{i}"] for i in range(41)}) == 1 and len({got[f"s{i}"] for i in range(30)} | {got["star"]}) == 1
    assert all(got[a] == got[b] for a, b in pairs if a != b) and got["n0"] != got["star"]


# --- line dedup ---


@pytest.mark.parametrize("min_words", [1, 3, 8, 50])
def test_line_dedup(make, min_words):
    rng = random.Random(min_words)
    line = lambda: " ".join(rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 5])))
    docs = [(i, "\n".join(rng.choice([line(), "", " ", "a b c a b", "x"]) for _ in range(rng.randint(0, 25))), "s") for i in range(40)]
    docs += [(100, docs[3][1], "s"), (101, "new\n" + docs[5][1] + "\n", "s"), (102, "x\n" * 120, "s"), (103, "x\n" * 60, "s")]
    got = {r.doc_id: r.text for r in linededup.dedup(make(docs), min_words).collect()}
    assert got == {d: t for (d, _, _), t in zip(docs, brute.kept_lines([(d, t) for d, t, _ in docs], min_words))}


def test_line_dedup_odd(odd, none):
    out = linededup.dedup(odd, 50, deleted_col="gone")
    assert set(out.columns) == {*odd.columns, "gone"} and linededup.dedup(none).count() == 0
    # one document stored twice is cut alike, and is no copy of itself
    assert Counter((r.doc_id, r.text, r.gone) for r in out.collect()) == Counter(
        (d, "" if d == 5 else t, int(d == 5)) for d, t, _ in ODD
    )


# --- secret scan ---


def scanned(rng, n):
    """Documents, and which findings are secrets."""
    docs, secret = [], {}
    for i in range(n):
        value = "".join(rng.choice("0123456789abcdefGHIJ") for _ in range(rng.randint(20, 40)))
        kind = rng.randrange(5)
        text = [
            f'my api_key = "{value}" there', f"see {rng.randint(10**15, 10**16)} card", f"mail {value}@mail.example.com now",
            "a " + "".join(rng.choice(["foo", "bar", "baz"]) for _ in range(9)) + " b", f'checksum: "{value}" of it',
        ][kind]
        docs.append((i, f"foo bar baz {text}", rng.choice(["src/a.py", "b"])))
        secret[i] = kind == 0
    return docs, secret


def test_secrets_held_out(make):
    docs, truth = scanned(random.Random(8), 400)
    train, held = [d for d in docs if d[0] % 2], [d for d in docs if not d[0] % 2]
    found = secrets.featured(secrets.findings(make(train)), make(train))
    labelled = found.join(found.sparkSession.createDataFrame(list(truth.items()), "key long, t boolean"), "key").withColumn("label", F.col("t").cast("double"))
    out = secrets.scan(make(held), labelled).collect()
    assert len(out) > 150 and sum(r.secret == truth[r.doc_id] for r in out) >= 0.97 * len(out)


def test_secrets_odd(odd, none):
    assert secrets.scan(none).count() == 0
    assert {r.finding for r in secrets.scan(odd).collect()} == set()  # one label at most, nothing key-like


def test_secrets_several_in_one_word(make):
    a, b, c = "f33e91c0aa5d47b28e6f1029fda2", "Zk8Qw1Lm5Rt9Yx3Vb7Nc2Jd6", "0123456789abcdef01"
    texts = [
        f'{{"site":"https://example.com/callback/oauth/start","api_key":"{a}"}}', f'x {{"x":"com/callback/oauth","secret":"{b}"}} y', f"1,{a},no,{b},{c}",
        f"https://h.example/?sig={a}&token={b}", f"{a}.{b}", f'key = "{c}"', ".".join([a] * 3000), f"{a};{a}",
    ]
    found = secrets.findings(make([(i, t, "s") for i, t in enumerate(texts)])).collect()
    want = [["com/callback/oauth/start", a], [b], [a, b, c], [f"sig={a}", f"token={b}"], [a, b], [c], [a] * 3000, [a, a]]
    assert [[r.finding for r in sorted(found, key=lambda r: (r.at, r.run)) if r.key == i] for i in range(len(texts))] == want
    assert len({(r.key, r.at, r.run) for r in found}) == len(found) and max(len(r.word) for r in found) < 500
    word = {(r.key, r.finding): r.word for r in found}
    assert word[0, a] == f'"api_key":"{a}"}}' and word[3, f"token={b}"] == f"token={b}" and word[5, c] == f'"{c}"'
