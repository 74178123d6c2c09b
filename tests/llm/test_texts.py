"""Chat formatting, license scans, quality rules, HTML extraction and toxicity."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcel_jobs.llm import chat, html_text, licenses, quality, toxicity

DOCS = "doc_id long, text string, lang string, row string, q int, label string"


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "r", 1, "l") for i, t in texts], DOCS)


def test_conversations(spark):
    turns = [(1, 1, "assistant", "a </turn> \\l \\b <body>"), (1, 0, "user", None), (2, 0, None, "é\n"), (2, 0, "assistant", ""), (None, 5, "assistant", "x<turn>"), (1, 1, "assistant", "a </turn> \\l \\b <body>"), (3, None, "<user>", "\\")]
    turns += [(4, 0, "user", "see ![cat](http://x/cat.png) and ![](a.mp3)![b](c.pdf) <image>"), (4, 1, "assistant", "![x](y) seen"), (4, 1, "assistant", "<x"), (4, 1, "assistant", "\\x"), (4, 2, "user", "![not](one two) ![nor <this](z)"), (5, 0, "assistant", "very long " * 100_000 + "![p](q.wav)")]
    df = spark.createDataFrame([(*t, 1, "c") for t in turns], "conv_id long, turn long, role string, text string, formatted int, attachments string")
    got = {r["conv_id"]: r for r in chat.conversation_digests(df).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in turns if t[0] == conv)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert {i: (r["n_attachments"], r["expanded_tokens"]) for i, r in got.items() if r["n_attachments"]} == {4: (4, 256 + 128 + 512 + 256), 5: (1, 128)}
    assert chat.conversation_digests(df.limit(0)).collect() == []


def test_conversations_give_the_rows_of_their_sql(spark):
    import duckdb

    from parcel_jobs.llm import queries

    duck, data = duckdb.connect(), "/root/testdata/sf0.001"
    for table in ("conversations", "documents"):
        duck.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    for name, sql in queries.ORACLES.items():
        out = queries.QUERIES[name](spark, data)
        want = duck.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(out.columns)
        rounded = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
        assert sorted((rounded(r[c] for c in names) for r in out.collect()), key=repr) == sorted(map(rounded, want.fetchall()), key=repr)


def test_parts_become_placeholders_and_come_back(spark):
    part = lambda kind, text=None, ref=None, tokens=None: (kind, text, ref, tokens)
    rows = [(1, 0, "user", [part("text", "see <image> "), part("image", ref="a.png"), part("audio", ref="b", tokens=7)]), (1, 1, "assistant", [part("document", ref="c"), part("text", "ok"), part("text")]), (1, 2, "user", None), (1, 3, "user", [part(None, "n"), part("video", "v")])]
    out = chat.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PART}"))
    out = out.withColumn("turns", chat.read_turns(F.col("formatted"), F.col("attachments"))).first()
    assert out["formatted"] == "<turn>user<body>see \\limage> <image><audio></turn>\n<turn>assistant<body><document>ok</turn>\n<turn>user<body></turn>\n<turn>user<body>nv</turn>\n"
    assert [[(a["type"], a["ref"], a["tokens"]) for a in t] for t in out["attachments"]] == [[("image", "a.png", 256), ("audio", "b", 7)], [("document", "c", 512)], [], []] and out["expanded_tokens"] == 775
    assert [(s["turn"], out["formatted"][s["start"] : s["start"] + s["length"]]) for s in out["spans"]] == [(1, "<document>ok")]
    assert [(t["role"], [(p["type"], p["text"], p["ref"]) for p in t["parts"]]) for t in out["turns"]] == [
        ("user", [("text", "see <image> ", None), ("image", None, "a.png"), ("audio", None, "b")]), ("assistant", [("document", None, "c"), ("text", "ok", None)]), ("user", []), ("user", [("text", "nv", None)]),
    ]


NOTICE, WHOLE_BSD, WHOLE_MIT = licenses.TEMPLATES[6][0], licenses.TEMPLATES[7][0], licenses.TEMPLATES[1][0]


def slow_labels(words):
    """Labels by trying every offset of every template: words of the template that lie in equal runs of four near that offset."""
    labels, score = {label for phrase, label in licenses.PHRASES if f" {phrase} " in f" {' '.join(words)} "}, 0.0
    score = 1.0 if labels else 0.0
    for text, label in licenses.TEMPLATES:
        template = text.split()
        covered = {}
        for d in range(-len(template), len(words)):
            covered[d] = {j + k for j in range(len(template) - 3) if 0 <= j + d <= len(words) - 4 and words[j + d : j + d + 4] == template[j : j + 4] for k in range(4)}
        for d, own in covered.items():
            share = len(set().union(*[covered.get(e, set()) for e in range(d - licenses.NEAR, d + licenses.NEAR + 1)])) / len(template) if own else 0
            if share >= licenses.COVERED:
                labels, score = labels | {label}, max(score, share)
    return ",".join(sorted(labels)), score


def test_licenses(spark):
    texts = [None, "", "MIT License", "the mit-license, MIT\nlicense; Apache License", "GNU General Public License v3 general public", "mitlicense mit licenses", NOTICE.upper(), NOTICE.replace("source and", "source code and"), NOTICE.replace("forms with or ", ""), "in the of the to any " * 50, "mit license " * 5000]
    texts += ["public license " * 12, "redistribution and " * 10, "free software " * 12, NOTICE + " are met" * 60, "are met " * 30 + NOTICE, WHOLE_BSD, WHOLE_BSD.replace("the copyright holder", "ACME Inc and friends"), "x " * 50 + WHOLE_MIT + " y" * 50 + " " + WHOLE_MIT]
    texts += [WHOLE_BSD[:300], WHOLE_MIT.replace(" the ", " "), " ".join(reversed(WHOLE_MIT.split())), licenses.TEMPLATES[8][0] + " " + licenses.TEMPLATES[3][0]]
    rows = [*enumerate(texts), (2, "MIT License"), (None, "apache license")]
    got = licenses.scan_licenses(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) for i, t in rows if i == r["doc_id"]][0]
        places = [(k, label) for k in range(len(words)) for phrase, label in licenses.PHRASES if words[k : k + len(phrase.split())] == phrase.split()]
        want = (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({x for _, x in places})))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        if len(words) < 2000:
            assert (r["labels"], pytest.approx(r["score"])) == slow_labels(words)
    found = {r["doc_id"]: r for r in got}
    labels = {i: r["labels"] for i, r in found.items()}
    assert labels[6] == labels[7] == labels[8] == labels[14] == labels[15] == labels[16] == labels[17] == "bsd" and labels[18] == "mit" and labels[22] == "apache,isc"
    assert all(labels[i] == "" for i in (5, 9, 11, 12, 13, 21))
    assert [(s["first_word"], s["label"], s["coverage"]) for s in found[18]["spans"] if s["n_words"] > 100] == [(50, "mit", 1.0), (100 + len(WHOLE_MIT.split()), "mit", 1.0)]
    assert licenses.scan_licenses(docs(spark, [])).collect() == []


def slow_counts(text):
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = defaultdict(list)
    for i in range(len(words) - 4):
        seen[tuple(words[i : i + 5])].append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    rng = random.Random(4)
    texts = [None, "", "\n \n", "a b c d e", "a b c d e f a b c d e", "x " * 11, "l1\nl1\n\nl2\nl1", "#*$%&|<> é日", "a b c d e " * 2000, "a\x0bb\x0cc\xa0d"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = [*enumerate(texts), (4, texts[4]), (None, "z")]
    got = quality.quality_verdicts(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        counts = slow_counts(next(t for i, t in rows if i == r["doc_id"]))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0]) and not (r["base_failed"] and r["kept"])
    assert quality.quality_verdicts(docs(spark, [])).collect() == []


def slow_distances(text, lang):
    """Jensen-Shannon distances of a text from its language's references, in plain Python."""
    lang = (lang or "").lower() if (lang or "").lower() in quality.COMMON else ""
    ascii_only = lambda p: len(re.findall(p, text))
    lower, upper, digits, space, marks, symbols = (ascii_only(p) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?'\x22()-]", r"[#*$%&|<>]"))
    other = len(text) - lower - upper - digits - space - marks - symbols
    counts = [lower, upper, digits, space, marks, symbols, other] if lang else [lower + upper + other, 0, digits, space, marks, symbols, 0]

    def js(p, q):
        kl = lambda a, b: sum(x * np.log2(x / y) for x, y in zip(a, b, strict=True) if x > 0)
        m = [(x + y) / 2 for x, y in zip(p, q, strict=True)]
        return max(0.0, (kl(p, m) + kl(q, m)) / 2) ** 0.5

    by_class = js([x / len(text) for x in counts], quality.references()[lang][0])
    words = [w for w in re.split(r"[\x20\x09-\x0D.,;:!?'\x22()-]+", text.lower()) if w]
    shares = [words.count(w) / max(1, len(words)) for w in quality.COMMON.get(lang, ())]
    return by_class, js([*shares, 1 - sum(shares)], quality.references()[lang][1]) if lang else None


def test_quality_distances(spark):
    rng = random.Random(6)
    words = "the of and to in is that house river stone bridge walking morning paper garden window letter summer It's für être señor".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(10, 300))) + rng.choice(["", ". The END!", " | 12 #"]) for _ in range(30)]
    langs = ["en", "DE", "fr", "es", "xx", None]
    rows = [(i, t, langs[i % 6], "r", 1, "l", 9) for i, t in enumerate(texts)]
    got = quality.quality_verdicts(spark.createDataFrame(rows, DOCS + ", js_class int")).collect()
    judged = [r for r in got if not r["base_failed"]]
    assert len(judged) > 20
    for r in judged:
        want = slow_distances(texts[r["doc_id"]], langs[r["doc_id"] % 6])
        assert r["js_class"] == pytest.approx(want[0], abs=1e-9)
        assert r["js_word"] is None if want[1] is None else r["js_word"] == pytest.approx(want[1], abs=1e-9)


def prose(rng, n):
    """Words drawn with the shares of common English words; the rest are other words."""
    other = "house river stone bridge walking morning paper garden window letter summer children between following".split()
    weights = quality.references()["en"][1]
    return " ".join(w or rng.choice(other) for w in rng.choices([*quality.COMMON["en"], None], weights, k=n)).capitalize() + "."


def test_quality_verdicts_do_not_depend_on_other_rows(spark):
    rng = random.Random(8)
    good = [prose(rng, n) for n in (200, 150, 90, 60, 45, 30, 20)]
    title = [prose(rng, 120).title()]
    shout = [" ".join(rng.choice(prose(rng, 9).split()).upper() + "!!" + str(i) for i in range(200)) for _ in range(8)]
    table = [" | ".join(rng.choice("house river stone bridge".split()) + rng.choice("abcdefg") * 2 for _ in range(n)) for n in (20, 30, 45)]
    marks = [" ".join(rng.choice(prose(rng, 9).split()) + rng.choice(("$$$", "%%%", "&&&", "***")) for _ in range(n)) for n in (30, 60, 90)]
    bad = shout + table + marks
    rows = [*enumerate(good + title), *enumerate(bad, 100)]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(docs(spark, rows)).collect()}
    assert {i for i, k in kept.items() if not k} == {i for i, _ in rows if i >= 100}
    for i, t in (rows[0], rows[-1], (100, shout[0])):
        assert quality.quality_verdicts(docs(spark, [(i, t)])).first()["kept"] == kept[i]
    other = quality.quality_verdicts(docs(spark, [(1, "这是一段没有空格的文字，" * 30 + " a b c d e f g h i j")], lang="zh")).first()
    assert other["kept"] and other["js_word"] is None


def test_quality_of_one_long_repeated_window(spark):
    got = quality.quality_verdicts(docs(spark, [(1, prose(random.Random(1), 60_000)), (2, "a b c d e " * 60_000)])).collect()
    assert {r["doc_id"]: r["base_failed"] for r in got}[2] and [r["n_words"] for r in got if r["doc_id"] == 2] == [300_000]


PAGE = "<html><head><title>t</title></head><body><nav><a href=x>Home</a></nav><div class='cookie notice'>We use cookies</div>{}<section class='comments'><p>I liked this one</p></section><footer>&copy; me</footer></body></html>"


def test_pages(spark):
    article = "<article><h1>Tea &amp; time</h1><p>One\n  two <b>three</b>four &lt;i&gt;<br>five<p>six<ul><li>seven<li>eight</ul><script>no()</script><div class=ad>buy</div></article>"
    rows = [(1, "u", PAGE.format(article), "c"), (2, None, None, "c"), (3, "u", "", "c"), (4, "u", "<<<>>> &amp <b", "c"), (5, "u", PAGE.format("<main>" + "<p>word</p>" * 20_000 + "</main>"), "c"), (1, "u", PAGE.format(article), "c"), (6, "u", "<div>" * 5000, "c"), (7, "u", PAGE.format("<article><p>cut off"), "c")]
    got = {r["page_id"]: r for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert got[1]["text"] == "Tea & time One two threefour <i> five six seven eight" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == got[3]["text"] == "" and got[5]["text"] == " ".join(["word"] * 20_000)
    assert got[7]["text"].startswith("cut off")


def test_marginals_are_those_of_all_assignments():
    model = html_text.trained()
    nodes, _ = html_text.parse(PAGE.format("<article><p>one <b>two</b></p></article>"))
    nodes = nodes[:9]
    n, weights = len(nodes), {}
    own = [sum(model.odds[e] for e in html_text.evidence(x) if e in model.odds) for x in nodes]
    for bits in range(1 << n):
        y = [bits >> i & 1 for i in range(n)]
        w = 0.01 if y[0] else 0.99
        for i in range(n):
            w *= np.exp(np.clip(own[i], -20, 20)) if y[i] else 1
            if i:
                w *= model.tie[html_text._kind(nodes[i].tag)][2 * (1 - y[nodes[i].parent]) + (1 - y[i])]
        weights[bits] = w
    total = sum(weights.values())
    brute = [sum(w for b, w in weights.items() if b >> i & 1) / total for i in range(n)]
    assert model.marginals(nodes) == pytest.approx(brute, abs=1e-9)


def right_share(model, pages):
    right = total = 0
    for page in pages:
        nodes, _ = html_text.parse(page)
        label = []
        for x in nodes:
            label.append(x.label if x.label is not None else (label[x.parent] if x.parent >= 0 else False))
        right += sum((p > 0.5) == y for p, y in zip(model.marginals(nodes), label, strict=True))
        total += len(nodes)
    return right / total


def test_held_out_layouts():
    per_layout = len(html_text._BOXES) // 2
    train = html_text.labelled_pages()
    for k in range(0, 12, 2):  # each of these main layouts is left out of training in turn
        held = [p for i, p in enumerate(train) if i // per_layout % len(html_text._MAINS) == k]
        model = html_text.trained([p for i, p in enumerate(train) if i // per_layout % len(html_text._MAINS) != k])
        assert right_share(model, held) > 0.95
    assert right_share(html_text.trained(), html_text.labelled_pages(seed=99)) > 0.97


def test_articles_of_the_tables(spark):
    """The pages of the given tables mark their article by one element, and nothing else in them is content."""
    import html as reference

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.join(html_text.extract_main_text(pages), ["page_id", "url"]).collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br|ul|li)>", "\0", inner)).split("\0")
        assert r["text"] == " ".join(filter(None, (re.sub(r"\s+", " ", reference.unescape(x)).strip() for x in blocks)))


HOSTILE = ["<a" * 100_000, "<" + "a" * 1_000_000, "<a " * 100_000, "<div>" * 100_000, "<li><ul>" + "<div>" * 50_000 + "<li>" * 50_000, "<a \"" * 100_000, "</script " * 100_000, "<script></script " * 50_000, "<!--" * 100_000]
HOSTILE += ["&" * 1_000_000, "&#" + "9" * 100_000 + ";", "&#" + "0" * 100_000 + "65;", '<x ">" ' * 50_000, "<p>" * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<?" * 100_000, "<p hidden " + " " * 100_000]


@pytest.mark.parametrize("k", range(len(HOSTILE)))
def test_hostile_pages_are_read_in_time(k):
    import time

    model, start = html_text.trained(), time.process_time()
    assert html_text.main_text("<article><p>Head of it</p><p>" + HOSTILE[k], model).startswith("Head of it")
    assert time.process_time() - start < 5


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h1>Head</h1><p class=notice>One text of the article that matters.</p><section class=more><p>Two more paragraphs, with words.</p><p>Three.</p></section></article>", "Head One text of the article that matters. Two more paragraphs, with words. Three."),
        ("<body><p>First paragraph of a plain page, which has nothing else on it.</p><p>Second one, about as long as the first.</p></body>", "First paragraph of a plain page, which has nothing else on it. Second one, about as long as the first."),
        ("<body><nav><a href=x>Home</a></nav><p>First paragraph of a plain page, which has text.</p><p>Second one, about as long, which goes on for some more words.</p><p>Third and last of them.</p><footer>me</footer></body>", "First paragraph of a plain page, which has text. Second one, about as long, which goes on for some more words. Third and last of them."),
        ("<article><header><h1>Inner header text</h1></header><p>word word</p></article><aside>side</aside>", "Inner header text word word"),
        ("<header>Site</header><div class=cookie>We use cookies</div><article><h1>T</h1><p>Body one two.</p><form><input>Your mail</form></article><section id=comments><p>nice one this is</p></section>", "T Body one two."),
        ("<article><p>a &#65;&#x42;&#0067;&#99999999999; &amp; &notin; b\n c</p></article>", "a ABC\ufffd & ∉ b c"),
    ],
)
def test_main_text_of_layouts(page, text):
    assert html_text.main_text(page, html_text.trained()) == text


def test_references_of_numbers():
    for text in ("&#0;&#0065;", "&#00;", "&#000000000000065", "&#x41;&#65", "&#", "&#0", "&#99999999;&#1114112;", "&amp;#65;"):
        import html as reference

        assert html_text.decoded(text) == reference.unescape(text)
    assert html_text.decoded("&#" + "9" * 5000 + ";&#" + "0" * 5000 + "65;") == "\ufffdA"


def test_no_pages(spark):
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string, text string, n_chars int")).collect() == []


def toxic_table(rng, n=900):
    words = ["".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        bad = i % 8 == 0
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["zqidiot", "zqtrash", "vekju" + rng.choice(words), "vekju" + rng.choice(words)]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_table(random.Random(8))
    extra = [(5000, None), (5001, ""), (None, "zqidiot zqtrash zqidiot vekjuabab"), (16, dict(rows)[16]), (5002, "clean word " * 20_000)]
    y = spark.createDataFrame([*labels, (None, 1), (7777, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs(spark, rows + extra), y).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    truth = dict(labels)
    test = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(p == t for p, t in test) / len(test) > 0.97
    assert {r["doc_id"]: r["predicted"] for r in got}[None] == 1


def test_held_out_labels_are_not_read(spark):
    rows, labels = toxic_table(random.Random(9), 500)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    a, b = (toxicity.score_toxicity(docs(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")).select("doc_id", "score").orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_scores_are_those_of_the_weights(spark):
    rows, labels = toxic_table(random.Random(10), 400)
    table = spark.createDataFrame([(i, t, 0.5, 1, True, 1) for i, t in rows], "doc_id long, text string, score double, predicted int, held_out boolean, toxic int")
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    fitted = toxicity.train(table, y)
    assert fitted.documents == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows) and fitted.voters and fitted.dropped == 0
    got = toxicity.score_toxicity(table, None, fitted=fitted).collect()
    texts = dict(rows)
    for r in got:
        words = set(re.findall(r"[a-z]+", texts[r["doc_id"]].lower()))
        stems = [w[:k] for w in words for k in toxicity.STEMS if len(w) > k]
        active = {f"={w}" for w in words} | {f"{x}*" for x in stems} | {f"{x}**" for x in stems if stems.count(x) > 1}
        odds = fitted.bias + sum(x for f, x in fitted.weights.items() if f in active)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-max(-30, min(30, odds)))))


def test_sample_is_bounded(spark):
    rows, labels = toxic_table(random.Random(11), 200)
    many = spark.createDataFrame(rows, "doc_id long, text string").unionAll(spark.range(20_000).select(F.lit(8).cast("long"), F.concat(F.lit("copy "), F.col("id").cast("string"))))
    y = spark.createDataFrame(labels * 2, "doc_id long, toxic int")
    assert toxicity.train(many, y).documents == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)
    assert toxicity.train(many, y, sizes=(5, 30)).documents == 35
    few = toxicity.train(many, y, most_chars=2000)
    assert 2000 <= few.chars < 4000 and few.documents < 40
    assert toxicity.train(many, y, most_features=1).dropped > 0


def test_no_labels(spark):
    got = toxicity.score_toxicity(docs(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(got) == 2 and all(r["predicted"] == 0 for r in got)
    assert toxicity.score_toxicity(docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int")).collect() == []


def test_label_model_weighs_correlated_voters():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.3
    vote = lambda hit, false: np.where(y, rng.random(4000) < hit, rng.random(4000) < false)
    a, b, c = vote(0.7, 0.02), vote(0.6, 0.03), vote(0.5, 0.02)
    votes = np.c_[a, a, a, b, c]
    posterior, accuracy, weight = toxicity.label_model(votes, np.full(4000, np.nan))
    assert weight[:3] == pytest.approx([1 / 3] * 3, abs=0.1) and weight[3] > 0.7
    assert ((posterior > 0.5) == y).mean() > 0.88 and accuracy[0] == pytest.approx(y[a].mean(), abs=0.1)
