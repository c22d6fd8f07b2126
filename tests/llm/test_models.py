import collections
import hashlib
import html as entities
import math
import random
import re
import time
import zlib

import numpy as np

from lakeshift.llm import blocks, html, langid, lm, pii
from lakeshift.llm.common import ship_package
from tests.conftest import SF_SMALL
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# -- language ----------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_language_of_all_cases(spark):
    ship_package(spark)
    got = langid.identify(cases.frame(spark)).collect()
    assert len(got) == len(cases.rows())
    texts = dict(cases.rows())
    for r in (r for r in got if r["doc_id"] is not None):
        t = texts[r["doc_id"]] or ""
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, t)))
    unlabelled = cases.frame(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}
    assert langid.identify(cases.frame(spark).limit(0)).collect() == []


def test_gradients_lower_the_loss():
    r = random.Random(1)
    texts = ["".join(r.choice("abcde ") for _ in range(200)) for _ in range(40)] + ["".join(r.choice("vwxyz ") for _ in range(200)) for _ in range(40)]
    net = langid.train(texts, ["a"] * 40 + ["z"] * 40, epochs=3)
    assert [p[0] for p in langid.predict(net, ["bcd aced", "xyz vwxy"])] == ["a", "z"]


# -- pages -------------------------------------------------------------------------

BLOCKS = re.compile(r"</?(?:p|h1|h2|div|ul|li)>")


def article(page: str) -> str:
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"</?(?:b|br|i|em|a)[^>]*>", "", b))).strip() for b in BLOCKS.split(inside))
    return "\n\n".join(p for p in parts if p)


def test_main_text_with_and_without_semantic_tags(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/pages.parquet").collect()]
    trees = html.train(pages[:150])
    for page in pages:
        plain = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", page).replace(' class="ad"', "")
        for shown in (page, plain):
            nodes, texts = html.parse(shown)
            assert html.main_text(nodes, texts, trees.log_odds(html.features(nodes))) == article(page)


def test_pages_without_paragraphs(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/pages.parquet").collect()]
    trees = html.train(pages[:150])

    def text(page):
        nodes, texts = html.parse(page)
        return html.main_text(nodes, texts, trees.log_odds(html.features(nodes)))

    said = [" ".join(cases.prose(k, 60).split()) for k in range(6)]
    menu = '<nav><a href="/">Home</a> <a href="/a">About us</a></nav>'
    foot = '<footer>Terms of use, all rights reserved</footer>'
    comments = '<div class="comments"><p>I agree with this.</p><p>So do I, and more than that.</p></div>'
    for page in (
        f'<html><body>{menu}<div id="story">{"<br><br>".join(said)}</div>{foot}</body></html>',
        f"<html><body>{menu}{'<br><br>'.join(said)}{foot}</body></html>",
        f"<html><body>{menu}<table>{''.join(f'<tr><td>{x}</td></tr>' for x in said)}</table>{foot}</body></html>",
        f"<html><body>{menu}<div><p>{' '.join(said)}</p></div>{comments}{foot}</body></html>",
        " ".join(said),
    ):
        got = text(page)
        assert got.replace("\n\n", " ") == " ".join(said), page
    assert text(menu + foot) == ""


def test_side_blocks_inside_and_around_the_article(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    trees = html.train(pages)
    long = cases.prose(3, 60).replace("\n", " ")
    page = f"""<html><body><header>Site name</header><nav><a href=x>Home</a> <a href=y>News</a></nav><aside class=sidebar>Most read</aside>
    <article><h1>Title &amp; more</h1><p>{long}<p>second&nbsp;one {long}<div class="ad">Buy now</div><form><input><label>mail</label></form>
    <script>var a = "<p>no</p>";</script><p>last {long}</article>
    <section class="comments"><p>first! {long}</p></section><footer>&copy; notice</footer></body></html>"""
    nodes, texts = html.parse(page)
    found = html.main_text(nodes, texts, trees.log_odds(html.features(nodes)))
    tidy = re.sub(r"\s+", " ", long).strip()
    assert found == "\n\n".join(["Title & more", tidy, f"second one {tidy}", f"last {tidy}"])


def shown(page: str) -> str:
    return " ".join("".join(t for _, _, t in html.parse(page)[1]).split())


def test_hidden_elements_hide_no_more_than_themselves():
    body = "<article><p>one</p>{}<p>two</p></article><p>three</p>"
    for head in ("<head><title>T</title>", "<head><meta charset=x><link rel=y>", "<head><style>p {}</style>", "<head><title>T", "<head><script>i<n"):
        if head.endswith(">"):
            assert shown(f"<html>{head}{body.format('')}").replace(" ", "") == "onetwothree"
        assert shown(f"<html>{head}</head><body>{body.format('')}").replace(" ", "") == "onetwothree"
    assert shown("<head><title>T</title>Plain text") == "Plain text"
    assert shown("<head><script>if (i<n) s = '\\'' + \"it's</p>\";</script></head><body><p>one</p>") == "one"
    assert shown("<head><noscript><p>no</p></noscript><template><b>no</b></template></head><p>one</p>") == "one"
    for name in "svg button option object select template canvas datalist noscript textarea iframe".split():
        assert shown(body.format(f"<{name}>no")).replace(" ", "") == "onetwothree", name
        assert shown(body.format(f"<div><{name}>no</div>")).replace(" ", "") == "onetwothree", name
        assert shown(body.format(f"<{name}>no</{name}>")).replace(" ", "") == "onetwothree", name
    assert shown(body.format("<object><div>no</div><object>no</object>no</object>")).replace(" ", "") == "onetwothree"
    assert shown("<p>one <span><svg><path d=x></span>two</p>") == "one two"
    assert shown("<p>one <svg><title/><style/><g><text>no</text></g></svg>two") == "one two"
    assert shown("<p>one <svg><foreignObject><div>no</div></foreignObject></svg>two") == "one two"
    assert shown("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> then</p>") == "if x=1 then"


def test_many_unclosed_hidden_elements_take_linear_time():
    page = "<p>one</p>" + "<button><option><svg><iframe><span></b>" * 20000 + "<p>two</p>"
    began = time.process_time()
    assert shown(page) == "onetwo"
    assert time.process_time() - began < 20


def test_decoding_never_contradicts():
    r = np.random.default_rng(1)
    for _ in range(200):
        nodes = [html.Node("div", frozenset(), -1, 0)]
        for i in range(1, 30):
            p = int(r.integers(0, i))
            nodes.append(html.Node("div", frozenset(), p, nodes[p].depth + 1, int(r.integers(0, 50))))
            nodes[p].children.append(i)
        keep = html.decode(nodes, r.normal(0, 3, 30))
        for i in range(30):
            chain = []
            while i >= 0:
                chain.append(keep[i])
                i = nodes[i].parent
            assert "".join("x" if k else "." for k in chain).strip(".").find(".") < 0  # one main stretch on the way to the root


def test_pages_of_all_kinds(spark):
    rows = [(1, None, None), (2, "u", ""), (None, None, "no tags"), (3, "u", "<p>"), (3, "u", "</div></p><b>x<!-- c"), (4, "u", "<script>x"), (5, "u", "<p>" * 3000), (6, "u", "<div>" * 2000 + "x")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html.extract(df).collect()
    assert sorted(((r["page_id"], r["url"]) for r in got), key=cases.key) == sorted(((r[0], r[1]) for r in rows), key=cases.key)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract(df.limit(0)).collect() == []


# -- personal data -----------------------------------------------------------------

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_slowly(text: str) -> list[tuple]:
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip":
                fine = all(int(x) <= 255 for x in m[0].split("."))
            elif kind == "card":
                fine = 12 <= len(digits) <= 19 and pii.luhn(digits)
            else:
                fine = kind == "email" or 9 <= len(digits) <= 15
            if fine:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(BASE).index(s[0])))


def test_base_spans_equal_the_patterns():
    r = random.Random(1)
    for _ in range(20000):
        t = "".join(r.choice(["a", "B", "@", "@", ".", "1", "2", "5", "0", "255", "4111111111111111", " ", "-", "+", "(", ")", "é", "%"]) for _ in range(r.randint(0, 30)))
        assert sorted(pii.base_spans(t)[0]) == sorted(base_slowly(t)), t


def test_find_on_all_cases(spark):
    ship_package(spark)
    got = sorted(map(tuple, pii.find(cases.frame(spark)).collect()), key=cases.key)
    want = []
    for i, t in cases.rows():
        spans = base_slowly(t or "")
        n = collections.Counter(s[0] for s in spans)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(text.encode()).hexdigest(), text))
    want.sort(key=cases.key)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    for g, w in zip(got, want, strict=True):
        assert set(filter(None, w[6].split(","))) <= set(filter(None, g[6].split(",")))
    assert any("secret:" in g[6] for g in got)
    assert pii.find(cases.frame(spark).limit(0)).collect() == []


def test_redaction(spark):
    ship_package(spark)
    df = cases.frame(spark)
    got = pii.redact(df)
    assert got.schema == df.schema
    texts = {r["doc_id"]: r for r in got.collect()}
    mail = next(i for i, t in cases.rows() if t and t.startswith("mail"))
    assert texts[mail]["text"] == "mail [EMAIL] or call [PHONE], card [CARD], ip [IP] now"
    assert texts[mail]["n_chars"] == len(texts[mail]["text"])
    untouched = {i: t for i, t in cases.rows() if not pii.candidates(t or "")}
    assert all(texts[i]["text"] == t for i, t in untouched.items() if i is not None)
    assert pii.redact(df.limit(0)).collect() == []


def test_overlapping_proposals_are_all_voted_on():
    for text in ("call 555-123-4567 24/7", "room 12 555-123-4567"):
        found = [dict(zip(("kind", "start", "end", "base", "votes"), c, strict=True)) for c in pii.candidates(text)]
        assert {f["kind"] for f in found} == {"card", "phone"}
        weights = pii.train([(f["kind"], f["votes"], 1000) for f in found])
        a = text.index("555")
        assert pii.accepted(found, weights) == [("phone", a, a + 12)]
    both = [dict(kind=k, start=a, end=b, base=False, votes=v) for k, a, b, v in (("card", 0, 15, "0000+"), ("phone", 3, 15, "0+00+"), ("secret", 15, 20, "0000+"))]
    weights = pii.train([("phone", "0+00+", 9), ("phone", "00-0-", 9), ("card", "0000+", 9), ("card", "0000-", 9), ("secret", "0000+", 9)])
    assert pii.classify(weights, "phone", "0+00+") > pii.classify(weights, "card", "0000+") > 0.5
    assert pii.accepted(both, weights) == [("phone", 3, 15), ("secret", 15, 20)]


def test_proposals_and_context_have_no_caps():
    name, label = "n" * 100, "h" * 90
    for text in (f"to {name} [at] {label}.example (dot) org, x", f"{name}(at){label} . {label}"):
        got = [c[:4] for c in pii.candidates(text)]
        a = text.index("n")
        assert got == [("email", a, text.index(",") if "," in text else len(text), False)]
    assert [c[:3] for c in pii.candidates("a[at]b[dot]c (at) d.e")] == [("email", 0, 12)]
    for text in ("password" + " " * 40 + "=" + " " * 40 + "'abc123def456'", "token\t\t\t\t\t\t:\t\t\t\t\t\tabc123def456"):
        assert [c[:3] for c in pii.candidates(text)] == [("secret", text.index("abc"), text.index("456") + 3)]
    near = "call " + "x" * 80 + " me 555-123-4567"
    assert pii.candidates(near)[0][4][1] == "+"
    assert pii.candidates("call" + " " * 80 + "555-123-4567")[0][4][1] == "+"
    assert pii.candidates("x" * 20 + "invoice" + " " * 25 + "555-123-4567")[0][4][2] == "0"
    assert pii.candidates("$" + " " * 60 + "555-123-4567")[0][4][3] == "-"


def test_long_texts_take_linear_time():
    began = time.process_time()
    for part in ("1.2.3.4|", "a[at]", "token ", "password    ", "a[at]b.c ", "token=abc123 "):
        pii.candidates(part * 20000)
    pii.candidates("x" * 200000 + "[at]" + "y" * 200000)
    assert time.process_time() - began < 30


def test_reliable_labelers_are_recognised():
    r = random.Random(3)
    n = collections.Counter()
    for _ in range(4000):
        y = r.random() < 0.4
        vote = lambda right: "+" if (r.random() < right) == y else "-"
        n["phone", vote(0.95) + vote(0.9) + vote(0.55) + vote(0.85) + "0"] += 1
    table, _ = pii.reliabilities([(k, v, c) for (k, v), c in n.items()])
    assert table[1, 0] > 0.85 and table[0, 0] < 0.15
    assert abs(table[1, 2] - 0.55) < 0.12
    weights = pii.train([(k, v, c) for (k, v), c in n.items()])
    assert pii.classify(weights, "phone", "++-+0") > 0.9 > 0.1 > pii.classify(weights, "phone", "--+-0")
    assert pii.classify(pii.train([]), "phone", "00000") == 0.5


# -- language model ----------------------------------------------------------------


def tokens(text: str | None) -> list:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def base_scores(pairs: list[tuple]) -> list[tuple]:
    out = []
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs]
    c = collections.Counter(w for (_, t), h in zip(pairs, held, strict=True) if not h for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for (i, t), h in zip(pairs, held, strict=True):
        ws = tokens(t)
        out.append((i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)))
    return out


def test_base_scores_equal_brute_force(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(lm, "ranges_for", lambda b: 5)
    pairs = cases.rows() + [(3000 + k, cases.prose(k, 50)) for k in range(40)]
    got = lm.score(cases.frame(spark, pairs)).collect()
    rounded = sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in got), key=cases.key)
    assert rounded == sorted(base_scores(pairs), key=cases.key)
    assert all(r["score"] <= 0 for r in got)
    assert lm.score(cases.frame(spark).limit(0)).collect() == []


def model_scores(pairs: list[tuple]) -> dict:
    """Deleted interpolation over plain counters, with an EM of its own."""
    crc = [zlib.crc32(str(i).encode()) if i is not None else 0 for i, _ in pairs]
    role = [2 if c % 7 == 2 else int(c // 7 % 10 == 0) for c in crc]
    word, pair = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]

    def steps(text):  # (context, word); a text begins after an end
        ws = tokens(text)
        return list(zip([None, *ws[:-1]], ws, strict=True))

    def seen(context, first):  # an end that begins a text is not the pair of a word after an end token
        return ("begin",) if first else context

    for (_, t), r in zip(pairs, role, strict=True):
        for k, (v, w) in enumerate(steps(t)):
            for kept in (0, 1):
                if r < 2 - kept:  # all training documents; those not set aside
                    word[kept][w] += 1
                    pair[kept][seen(v, not k), w] += 1
    n, dev_free, types = sum(word[0].values()), sum(word[1].values()), len(word[0])

    def bucket(c):
        return min(int(math.log2(c + 1)), lm.BUCKETS - 1)

    def binned(p):
        return 0.0 if not p else 2.0 ** (-(min(max(int(-math.log2(p) / lm.STEP), 0), lm.BINS - 2) + 0.5) * lm.STEP)

    cells = collections.Counter()
    for (_, t), r in zip(pairs, role, strict=True):
        if r == 1:
            for k, (v, w) in enumerate(steps(t)):
                c = word[1][v]
                cells[bucket(c), binned(pair[1][seen(v, not k), w] / c if c else 0), binned(word[1][w] / dev_free if dev_free else 0)] += 1
    weights, overall = {b: [1 / 3] * 3 for b in range(lm.BUCKETS)}, [1 / 3] * 3
    for _ in range(60):
        got = {b: [0.0] * 3 for b in weights}
        for (b, p2, p1), m in cells.items():
            part = [weights[b][0] / (types + 1), weights[b][1] * p1, weights[b][2] * p2]
            for j in range(3):
                got[b][j] += m * part[j] / sum(part)
        total = [sum(g[j] for g in got.values()) for j in range(3)]
        overall = [(x + 1) / (sum(total) + 3) for x in total]
        weights = {b: [(g[j] + 4 * overall[j]) / (sum(g) + 4) for j in range(3)] for b, g in got.items()}
    out = {}
    for i, t in pairs:
        score = 0.0
        for k, (v, w) in enumerate(steps(t)):
            c = word[0][v]
            a = weights[bucket(c)]
            score += math.log10(a[0] / (types + 1) + a[1] * word[0][w] / n + a[2] * (pair[0][seen(v, not k), w] / c if c else 0))
        out[i, t] = score
    return out


def test_model_scores_equal_brute_force(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(lm, "ranges_for", lambda b: 5)
    pairs = [(i, t) for i, t in cases.rows() if i is not None] + [(3000 + k, cases.prose(k % 50, 50)) for k in range(120)]
    want = sorted((i, round(x, 5)) for (i, _), x in model_scores(pairs).items())
    got = {(r["doc_id"], round(r["score"], 5)) for r in lm.score(cases.frame(spark, pairs)).collect()}
    assert sorted(got) == want


def test_model_beats_unigrams_on_held_out_documents(spark):
    ship_package(spark)
    got = lm.score(spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_probabilities_add_up_to_one():
    weights = lm.learn_weights([(3, 10, 20, 5), (7, 0, 40, 9)], 50)
    assert np.allclose(weights.sum(axis=1), 1)
    assert weights[7, 2] < weights[3, 2]  # no pair was seen in that bucket


def test_packed_keys_and_numbers():
    r = np.random.default_rng(1)
    keys = blocks.distinct(r.integers(0, 2**63, 1000, dtype=np.uint64) << np.uint64(1))
    assert (blocks.unpack_sorted(blocks.pack_sorted(keys)) == keys).all()
    even = keys >> np.uint64(8) << np.uint64(8)
    assert (blocks.unpack_sorted(blocks.pack_sorted(even, 8), 8) == even).all()
    for x in (np.zeros(0, np.uint64), np.zeros(5, np.uint64), r.integers(0, 70000, 99)):
        assert (blocks.unpack_numbers(blocks.pack_numbers(x)) == x).all()
    bounds = blocks.range_bounds(keys, 7)
    assert bounds[0] == 0 and bounds[-1] == len(keys) and (np.diff(bounds) > 0).all()


def test_blocks_hold_every_document_once(spark):
    ship_package(spark)
    df = cases.frame(spark).select("doc_id", "text")
    made = blocks.blocks(df.selectExpr("doc_id", "coalesce(text, '') as text"), "test-blocks", 2000).collect()
    assert len({r["block"] for r in made}) == len(made) > 3
    held = [(i, t) for r in made for i, t in zip(*(blocks.unpack(bytes(r["docs"])).column(c).to_pylist() for c in ("doc_id", "text")), strict=True)]
    assert sorted(held, key=cases.key) == sorted(((i, t or "") for i, t in cases.rows()), key=cases.key)
