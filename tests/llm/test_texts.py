"""Operators on single texts: PII, secrets, language, toxicity, HTML."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changelake.llm import html_extract, language_id, pii, secrets_scan, spans, toxicity
from tests.llm.conftest import prose

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def digits(s):
    return sum("0" <= c <= "9" for c in s)


def test_pii_base_equals_plain_patterns():
    keep = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": lambda s: 16 <= digits(s) <= 19 and pii.luhn("".join(c for c in s if c.isdigit())), "phone": lambda s: 8 <= digits(s) <= 15}
    rng = random.Random(4)
    pool = ["a@b.co", "x.y@", "@z.com", "a@b.c.d@e.f", "a@b.co_x@y.zz", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-0100", "+1", "+123456789012345678", "....", "--", " ", "é", "12", "%+", "a-b.c"]
    for _ in range(3000):
        t = "".join(rng.choice(pool) + rng.choice(("", " ", "")) for _ in range(rng.randint(0, 9)))
        want = [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, t) if keep[k](m[0])]
        assert [s[:3] for s in pii.find_pii(t) if s[0] in pii.BASE] == want, t


def test_pii_method_adds():
    kinds = {s[0] for s in pii.find_pii("IBAN DE89 3704 0044 0532 0130 00, card 378282246310005, call 555-010-1234, ssn 078-05-1120")}
    assert kinds == {"iban", "bare_card", "bare_phone", "national_id"}
    assert not pii.find_pii("IBAN DE89 3704 0044 0532 0130 01 and 378282246310005 and 555-010-1234 and 078-05-1120")  # no checksum, no context
    for long in ("a" * 200_000, "1" * 200_000, "+1" * 50_000, "1." * 50_000, "a@" * 50_000, "1 " * 50_000):
        pii.find_pii(long)  # in linear time


def test_pii_iban_before_words():
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    for iban in (de, de.replace(" ", ""), gb, no):
        for after in (" BIC COBADEFF", " EUR 20", " I am", " 20 30", ", X", "", " X1" * 40, " \n1"):
            t = f"IBAN {iban}{after}"
            assert [s[:3] for s in pii.find_pii(t) if s[0] == "iban"] == [("iban", 5, 5 + len(iban))], t
    t = f"IBAN AB12 {de} {gb} {no} OK"
    assert [t[a:b] for k, a, b, _ in pii.find_pii(t) if k == "iban"] == [de, gb, no]
    pii.find_pii("AB12 " * 40000)  # in linear time


def test_pii_frames(spark, docs, corpus, empty):
    df = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 0, "mail a@b.co or a@b.co now").otherwise(F.col("text")))
    got = pii.redact(df)
    assert got.columns == df.columns and got.count() == df.count()
    assert {r["text"] for r in got.where("doc_id % 7 = 0").collect()} == {"mail <EMAIL> or <EMAIL> now"}
    assert {r["doc_id"]: r["text"] for r in got.where("doc_id % 7 <> 0").collect()} == {i: t for i, t in corpus if i % 7}
    assert pii.detect(empty).count() == 0 and "pii" in pii.detect(docs.withColumn("pii", F.lit(1))).columns


def test_spans():
    assert spans.union([(5, 9), (1, 3), (2, 6), (10, 12)]) == [(1, 9), (10, 12)]
    assert spans.overlaps([(1, 9), (10, 12)], 8, 10) and not spans.overlaps([(1, 9), (10, 12)], 9, 10)
    assert spans.cut_out("abcdef", [(1, 3, "X"), (2, 4, "Y"), (5, 6, "")]) == "aXe"


SECRETS = {"assign": r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def test_secrets_base_equals_plain_patterns():
    keep = {"assign": lambda m: len(m[1]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    rng = random.Random(5)
    pool = ["token", "ToKen", "Key", "api_key", "APIKEY", '"', "'", ":", "=", " ", "abc123", "AKIA", "ABCDEFGHIJKLMNOP1234", "0123456789abcdef", "deadbeef", "g", "paſsword", "password"]
    for _ in range(3000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        assert sorted(secrets_scan.base_spans(t)) == sorted((k, m.start(), m.end()) for k, p in SECRETS.items() for m in re.finditer(p, t) if keep[k](m)), t


def test_secrets_model(spark, docs, empty):
    rng = random.Random(6)
    scanner = secrets_scan.train(docs)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_ones = ["".join(rng.choice(alphabet) for _ in range(32)) for _ in range(200)]
    plain = [rng.choice(("get_user_name_by_id_", "updateSessionConfigValue", "table-column-index-")) + rng.choice(("count", "list", "default")) + str(rng.randint(0, 99)) for _ in range(200)]
    found = [bool(scanner.find(f"see {s} here")) for s in random_ones]
    false = [bool(scanner.find(f"see {s} here")) for s in plain]
    assert np.mean(found) > 0.95 and np.mean(false) < 0.02
    t = 'token = "0123456789abcdef0123456789abcdef0123"'
    assert [s[0] for s in scanner.find(t)] == ["assign", "hex"]
    assert secrets_scan.scan(docs, scanner).count() == docs.count() and secrets_scan.scan(empty, secrets_scan.train(empty)).count() == 0


def test_secrets_behind_equals_signs(docs):
    """Env files, query strings and key=value, whose names are no key names of the assign kind."""
    scanner = secrets_scan.train(docs)
    value = "wJalrXUtnFEMI0K7MDENG1bPxRfiCY2XAMPLEKEY"
    for before, after in (("AWS_SECRET_ACCESS_KEY=", "\n"), ("export A_LONG_VARIABLE_NAME_2=", " "), ("client_key=", ""), ("https://example.org/x?sig=", "&v=1"), ("?a=1&sig=", ""), ("key: ", ","), ("key==", ""), ("x=", "=="), ("x=", "=y"), ("x=", "===")):
        t = before + value + after
        end = len(before + value) + 2 * (after == "==")
        assert [s[:3] for s in scanner.find(t)] == [("markov", len(before), end)], t


def test_secrets_learn_from_all_strings_of_the_sample():
    rng = random.Random(7)
    keys = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20)) + str(rng.randint(0, 9)) for _ in range(3000)] + [f"{rng.getrandbits(128):032X}" for _ in range(6000)]
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(25000)]
    secrets, plain = secrets_scan.labelled_samples([f"token={k}" for k in keys] + [" ".join(words)])
    assert set(keys) <= set(secrets) and set(words) <= set(plain)


def ppm_brute(texts, text, order):
    """Bits by method C over dictionaries."""
    counts = {}
    for t in texts:
        b = t.encode()
        for i in range(len(b)):
            for k in range(min(order, i) + 1):
                counts.setdefault(b[i - k : i], {}).setdefault(b[i], 0)
                counts[b[i - k : i]][b[i]] += 1
    out, b = 0.0, text.encode()
    for i in range(len(b)):
        for k in range(min(order, i), -1, -1):
            c = counts.get(b[i - k : i])
            if not c:
                continue
            total = sum(c.values()) + len(c)
            if b[i] in c:
                out -= np.log2(c[b[i]] / total)
                break
            out -= np.log2(len(c) / total)
        else:
            out += 8
    return out


def test_language_code_lengths():
    """The shipped model, whole, at several orders."""
    rng = random.Random(8)
    texts = {x: [prose(rng, 30, i) for _ in range(3)] for i, x in enumerate(("aa", "bb", "cc"))}
    texts["cc"].append("été ß")
    for order in (1, 2, 3, 5):
        model = language_id.Model(texts, order)
        probe = ["the of and", "", "été zz\x00", prose(rng, 20, 1), "t"]
        from changelake.llm.textkit import as_bytes

        got, _ = model.code_lengths(*as_bytes(pa.array(probe)))
        want = [[ppm_brute(texts[x], t, order) for x in ("aa", "bb", "cc")] for t in probe]
        assert np.allclose(got, want, rtol=1e-4)


def test_language_keeps_rare_contexts_beside_rich_languages():
    """More contexts than 12,000 in one language, all more frequent than the other's, which are seen three times."""
    rng = random.Random(10)
    rich = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    texts = {"rich": [rich], "short": ["0123456789 31415926535 2718281828"] * 3}
    from changelake.llm.textkit import as_bytes

    probe = ["0123456789", "31415926535 0123", "2718281828 012"]
    got = language_id.Model(texts, 3).code_lengths(*as_bytes(pa.array(probe)))[0][:, 1]
    assert np.allclose(got, [ppm_brute(texts["short"], t, 3) for t in probe], rtol=1e-4)


def test_language_frames(spark, docs, empty):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(8, 60), i % 3), "xyz"[i % 3]) for i in range(300)]
    rows += [(1000, None, "x"), (1001, "123 ...", "y"), (1002, "", None), (1003, "中", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df.where("doc_id % 2 = 0"))
    got = {r["doc_id"]: r for r in language_id.identify(df, model).collect()}
    assert np.mean([got[i]["lang_pred"] == "xyz"[i % 3] for i in range(1, 300, 2)]) > 0.97
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] in ("x", "y", "z")
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language_id.train(empty.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"} and language_id.identify(empty, model).count() == 0


def test_toxicity(spark, docs, empty):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 8 == 0
        text = prose(rng, rng.randint(10, 80))
        if toxic:
            words = text.split()
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(("blorgish", "blorgo", "blorgen", "zzidiot"))
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(toxic if rng.random() > 0.02 else not toxic)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    c = toxicity.train(df.where("doc_id % 5 <> 0"), lab.where("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, c).collect()}
    held = [i for i in range(0, 900, 5)]
    assert np.mean([(got[i] >= 0.5) == (i % 8 == 0) for i in held]) > 0.97
    odd = {r["doc_id"]: r["score"] for r in toxicity.score(docs, c).collect()}
    assert len(odd) == docs.count() and all(0 <= s <= 1 for s in odd.values())
    none = toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs.drop("score"), none).collect()} == {0.0} and toxicity.score(empty, c).count() == 0


def test_label_model_finds_bad_voters():
    rng = np.random.default_rng(2)
    y = rng.random(2000) < 0.3
    v = np.zeros((2000, 4), np.int8)
    for j, right in enumerate((0.95, 0.9, 0.85, 0.5)):
        v[:, j] = np.where(np.where(rng.random(2000) < right, y, ~y), toxicity.TOXIC, toxicity.CLEAN)
    model = toxicity.LabelModel(v, np.full(2000, -1))
    assert ((model.posterior > 0.5) == y).mean() > 0.95 and model.accuracies[3] < 0.65 < model.accuracies[0]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></ul></nav><div class="cookie-notice"><p>We use cookies so that this site works for you and all others.</p></div>
<div id="sidebar"><p>A list of other things that we wrote lately, you may like some of it.</p></div>
<article><h1>The  title</h1><p>First paragraph &amp; more &lt;text&gt;,<br>it is long enough.<p>Short.<div class="ad">Buy this thing right now!</div><p>Last <b>one</b>&nbsp;of them, as good as the others were.
<section class="comments"><p>I am a reader and I liked it very much, thanks for writing this.</p></section><form><label>Mail</label><input></form></article><!-- x --><footer>&copy; 2020 &middot; site</footer>"""


def test_html():
    assert html_extract.main_text(PAGE) == "The title\nFirst paragraph & more <text>, it is long enough.\nShort.\nLast one of them, as good as the others were."
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<script>x") == ""
    for bad in ("<" * 5000, "<a " * 5000, "</p>" * 5000, "<div>" * 5000 + "deep", "<p \"" * 3000, "&am;&amp &#0;&#x110000;"):
        html_extract.main_text(bad)


def test_minimum_cut_is_least():
    rng = random.Random(12)
    for _ in range(150):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 1.5)) for _ in range(rng.randint(0, 12))]

        def cost(label, odds=odds, edges=edges):
            return sum(-x if on and x < 0 else x if not on and x > 0 else 0 for on, x in zip(label, odds, strict=True)) + sum(c for u, v, c in edges if label[u] != label[v])

        got = html_extract.minimum_cut(odds, edges)
        assert cost(got) == pytest.approx(min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n)))


def test_html_frame(spark):
    df = spark.createDataFrame([(1, None, PAGE, "old"), (2, "u", None, None), (2, "u", None, None)], "page_id long, url string, html string, text string")
    got = html_extract.extract(df)
    assert got.count() == 3 and {r["text"] for r in got.where("page_id = 2").collect()} == {""}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_language_query_equals_brute_force(spark):
    """op5's whole result from dictionaries of counts, over a table small enough that the sample is all labelled documents."""
    import zlib

    from tests.conftest import SF

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    texts = {}
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            texts.setdefault(r["lang"], []).append(r["text"])
    assert max(map(len, texts.values())) <= language_id.SAMPLE_DOCS
    got = {r["doc_id"]: r for r in language_id.op5_language(spark, SF).collect()}
    langs = sorted(texts)
    short = [r for r in rows if r["text"] and len(r["text"]) < 300][:12]
    for r in short:
        own = got[r["doc_id"]]
        bits = [ppm_brute(texts[x], r["text"], language_id.MAX_ORDER) for x in langs]
        assert own["lang_pred"] == (langs[int(np.argmin(bits))] if any(c.isalpha() for c in r["text"]) else "und")
        assert own["score"] == pytest.approx(1 / sum(2.0 ** max(-1000, min(bits) - b) for b in bits), abs=1e-3)
    assert len(got) == len(rows) and all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r["doc_id"]]["held_out"] and r["lang"]]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95


def test_language_stage_rejects_junk(spark):
    """Texts of no learned language go, clean ones stay."""
    import corpus_pipeline
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = ["xK#9f @@!! 0x8s7d6 qqzj vvkk", "Привет мир, это русский текст для проверки", "asdkjh qwoeiu zxmncb qpwoei alskdj", "zażółć gęślą jaźń, łąki żółwi"]
    more = spark.createDataFrame([(10**7 + i, t, None, "s", len(t)) for i, t in enumerate(junk)], docs.schema)
    kept = {r[0] for r in corpus_pipeline.language_stage(spark, docs.unionByName(more), SF).select("doc_id").collect()}
    assert not any(i >= 10**7 for i in kept)
    clean = {r[0] for r in docs.where("text rlike '[A-Za-z]'").select("doc_id").collect()}
    assert len(clean - kept) <= 0.005 * len(clean)


def test_samples_are_bounded_at_every_size(spark):
    from changelake.llm import sampling

    for n in (10, 10**4, 10**7, 3 * 10**8, 10**10, 10**13):
        limit = sampling.threshold(250, n)
        assert 0 < limit <= sampling.SPACE and (limit == sampling.SPACE or abs(limit / sampling.SPACE * n - 500) < 1)
    df = spark.range(100_000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id % 70000) as text", "if(id % 3 = 0, 'a', 'b') as lang")
    assert sampling.bounded_sample(df, ["doc_id", "text"], 1000).count() == 1000
    same = df.withColumn("text", F.lit("one"))
    assert sampling.bounded_sample(same, ["doc_id", "text"], 1000).count() <= 1000
    two = sampling.bounded_sample_by(df, "lang", ["doc_id", "text"], 250, {"a": 33_334, "b": 66_666})
    assert {r["lang"]: r["count"] for r in two.groupBy("lang").count().collect()} == {"a": 250, "b": 250}
    first = sampling.bounded_sample(df.repartition(7), ["doc_id", "text"], 40)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, sampling.bounded_sample(df.coalesce(1), ["doc_id", "text"], 40).collect()))


LONG = "The river rose in the night, and by morning the lower fields were under water, as they had been every spring that anyone could remember."
NEXT = "Nobody was surprised; the boats had been ready since the first warm days, and the cattle stood on the hill behind the church."
SIDE = "Other things that we wrote this week, which you may like to read as well, if there is time."
LAYOUTS = {
    "bare body": f"<body><ul><li><a href=a>Home</a><li><a href=b>News</a></ul><h1>High water</h1><p>{LONG}<p>{NEXT}<p>&copy; 2020 The Paper. All rights reserved.</body>",
    "main": f"<header><a href=/>The Paper</a></header><main><h1>High water</h1><p>{LONG}</p><p>{NEXT}</p></main><footer>The Paper, Mill Lane 4</footer>",
    "article header": f"<article><header><h1>High water</h1></header><p>{LONG}</p><p>{NEXT}</p><footer>Tags: <a href=x>water</a></footer></article>",
    "divs": f'<div class="top-nav"><a href=a>Home</a> <a href=b>News</a></div><div id="content"><h1>High water</h1><div>{LONG}</div><div>{NEXT}</div></div><div id="sidebar"><p>{SIDE}</p></div>',
    "blog": f'<div class="post"><h2>High water</h2><div class="entry-content"><p>{LONG}</p><p>{NEXT}</p></div></div><div class="comments-area"><ol class="comment-list"><li>{SIDE}</li></ol></div>',
    "tables": f'<table><tr><td class="menu"><a href=a>Home</a><br><a href=b>News</a></td><td><h1>High water</h1><p>{LONG}</p><p>{NEXT}</p></td></tr></table><p>&copy; 2020</p>',
    "names that mislead": f'<article><h1>High water</h1><div class="social-story"><p>{LONG}</p></div><p class="legal-post">{NEXT}</p></article><div class="story-sidebar"><p>{SIDE}</p></div>',
    "advert inside": f'<article><h1>High water</h1><p>{LONG}</p><div class="ad-container"><p>{SIDE}</p></div><div class="newsletter-signup"><p>{SIDE}</p></div><p>{NEXT}</p></article>',
    "roles": f'<div role="banner">The Paper</div><div role="navigation"><a href=a>Home</a></div><div role="main"><h1>High water</h1><p>{LONG}</p><p>{NEXT}</p></div><div role="contentinfo">{SIDE}</div>',
    "hidden and forms": f'<div hidden>{SIDE}</div><section class="story"><h1>High water</h1><p>{LONG}</p><form><label>Your mail</label><textarea>{SIDE}</textarea><select><option>{SIDE}</select></form><p>{NEXT}</p></section>',
    "links in prose": f'<nav><a href=a>Home</a></nav><article><h1>High water</h1><p>{LONG.replace("lower fields", "<a href=f>lower fields</a>")}</p><p>{NEXT.replace("boats", "<i>boats</i>")}</p></article><aside><p>{SIDE}</p></aside>',
    "unclosed": f'<article><h1>High water<p>{LONG}<p>{NEXT}</article><div class=cookie-banner>{SIDE}',
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_html_layouts(name):
    assert html_extract.main_text(f"<!DOCTYPE html><html><head><title>High water - The Paper</title></head>{LAYOUTS[name]}</html>").split("\n") == ["High water", LONG, NEXT]


def test_html_classifier_on_pages_it_has_not_seen():
    from changelake.llm import layouts

    wrong = blocks = 0
    for page, content in layouts.pages(150, seed=99):
        got = html_extract.main_text(page).split("\n")
        wrong += len(set(got) ^ set(content))
        blocks += len(html_extract.blocks(page))
    assert wrong <= 0.005 * blocks


def test_html_keeps_formulas_and_reads_broken_quotes():
    page = f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <svg><text>a drawing</text></svg><object>a fallback</object>.</p><p>Is 3 < 4? {NEXT}</p></article>"
    assert html_extract.main_text(page).split("\n") == [f"{LONG} x=2 and a drawinga fallback.", f"Is 3 < 4? {NEXT}"]
    assert html_extract.main_text(f'<article><p title="it\'s">{LONG}</p><p "title=x>{NEXT}</p></article>') == f"{LONG}\n{NEXT}"
    assert html_extract.main_text(f'<article><p>{LONG}</p><p title="open>{NEXT}</p></article>') == f"{LONG}\n{NEXT}"


def test_html_in_linear_time():
    import time

    def took(page):
        began = time.perf_counter()
        html_extract.main_text(page)
        return time.perf_counter() - began

    html_extract.classifier()
    for bad in ('<p "', "<a ", '<p a=">"', "<", '<p a="', "<p a='\">", "</p>", "<div>", "<!-", "</", "<p =' \"", "<td><b>"):
        n = (1 << 20) // len(bad)
        assert took(bad * n) < 12 * max(0.15, took(bad * (n // 8))), bad
    assert took('<p "' * (1 << 18)) < 1
