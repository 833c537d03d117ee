"""License scan, decontamination, language ID, HTML extraction, BPE, toxicity."""
import hashlib
import os
import random
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from fixtures import ENGLISH, FRENCH, LICENSE, documents, sentence, table  # noqa: E402

from martlane.llm import decontaminate as dc  # noqa: E402
from martlane.llm import html_extract, language_id, toxicity  # noqa: E402
from martlane.llm.bpe import Codec, encode_documents  # noqa: E402
from martlane.llm.license_rules import BASE, RULES  # noqa: E402
from martlane.llm.license_scan import scan  # noqa: E402
from martlane.llm.queries import vocabulary_path  # noqa: E402


def expected_licenses(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in BASE.items():
        own = phrase.split()
        at = [k for k in range(len(words)) if words[k:k + len(own)] == own]
        places += at
        base |= {label} if at else set()
    joined, found = f" {' '.join(words)} ", []
    for place, (label, _, pattern, priority) in enumerate(RULES):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", joined):
            start = joined[:m.start()].count(" ") - 1
            found.append((start, -(start + m.group().count(" ")), priority, place, label))
    found.sort()
    kept = [d for k, d in enumerate(found) if not any(e[1] <= d[1] and e[2] <= d[2] for e in found[:k])]
    return (len(words), len(places), min(places, default=None), max(places, default=None), sorted(base),
            sorted(base | {d[4] for d in kept}), [(d[4], d[0], -d[1]) for d in kept])


def test_license_scan(spark):
    rows = documents() + [(200, "mit-License MIT\nLICENSE permit license, mit licenses; " + LICENSE * 3, None),
                          (201, "Licensed under CC BY-NC-SA 4.0, not CC BY 3.0. GNU LGPL v2.1 or later; GPLv3", None),
                          (202, "All rights reserved. MIT License\n" * 400, None)]
    got = scan(table(spark, rows)).collect()
    out = [(r["doc_id"], r["text"], (r["__n_words"], r["__n_base"], r["__first_word"], r["__last_word"], r["__base_labels"],
                                     r["__labels"], [(d.label, d.start, d.end) for d in r["__detections"]])) for r in got]
    assert len(out) == len(rows)
    for doc_id, text, found in out:
        assert found == expected_licenses(text), doc_id
    by_id = {i: f for i, _, f in out}
    assert by_id[200][1] == 3 * 3 + 2 and "cc-by-nc-sa-4.0" in by_id[201][5] and "cc-by-nc" not in by_id[201][5]
    assert {"lgpl-2.1", "gpl-3.0", "cc-by-3.0"} <= set(by_id[201][5])
    assert all(0 <= r["__score"] <= 1 for r in got)
    assert scan(table(spark, [])).count() == 0


def test_license_keywords_stand_in_every_match():
    assert len(RULES) > 200
    for _, keyword, pattern, _ in RULES:
        always = pattern.replace("[cs]", "c")
        while (less := re.sub(r"\(\?:[^()]*\)\?", "", always)) != always:
            always = less  # without the optional groups
        assert keyword in re.findall("[a-z0-9]+", always), pattern


def edit_distance_in(window, text):
    """Least edits between the window and any part of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def planted(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("xyz")
        elif kind == 1:
            out.insert(at, rng.choice("xyz"))
        else:
            del out[at]
    return "".join(out)


def test_decontamination(spark):
    rng = random.Random(5)
    items = [(k, sentence(rng, ENGLISH, 30)) for k in range(6)] + [(6, sentence(rng, ENGLISH, 9)), (7, "too short"), (8, None), (9, "")]
    rows, truth = [], {}
    for i in range(80):
        words = [sentence(rng, ENGLISH, 20) for _ in range(4)]
        if i % 2 == 0:
            k = rng.randrange(7)
            words.insert(rng.randrange(5), planted(rng, items[k][1], rng.choice([0, 0, 2, 4, 14])))
        rows.append((i, ("\n" if i % 3 else " \t").join(words).upper() if i % 5 == 0 else " ".join(words), None))
    rows += [(90, items[3][1][2:], None), (91, items[4][1][:120], None), (92, None, None), (93, "", None), (93, items[0][1], None)]
    windows = {k: dc.index([dc.plain(t)]).texts for k, t in items}
    for n, (_, text, _) in enumerate(rows):
        body = dc.plain(text)
        truth[n] = {k for k, own in windows.items() for w in own if edit_distance_in(w, body) <= dc.budget(len(w))}
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = table(spark, rows)
    out = dc.find_leaks(docs, bench)
    assert out.columns == [*docs.columns, "__leaks"]
    got = sorted((r["doc_id"], r["text"] or "", sorted(x.item_id for x in r["__leaks"])) for r in out.collect())
    assert got == sorted((i, t or "", sorted(truth[n])) for n, (i, t, _) in enumerate(rows))
    assert sum(map(bool, truth.values())) > 20
    none = dc.find_leaks(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["__leaks"] for r in none)
    assert dc.find_leaks(table(spark, []), bench).count() == 0


def test_decontamination_of_edits_close_together():
    """Edits within a tenth of the item, but more than a window of 64 allows, in its middle."""
    rng = random.Random(21)
    signs = "abcdefghijklmnopqrstuvw"
    short, long = ("".join(rng.choice(signs) for _ in range(n)) for n in (81, 200))
    noise = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [noise(50) + " " + short[:38] + "xyzxyz" + short[44:] + " " + noise(50),  # in [17:64], which all windows of 64 hold
             noise(50) + long[:44] + "xyzxyzx" + long[51:96] + noise(50),
             noise(40) + short[:64] + noise(40), short[:35] + noise(9) + short[44:]]
    got = dc.leaks(texts, dc.index([short, long]))
    assert [sorted((i, e) for i, _, e in f) for f in got] == [[(0, 6)], [(1, 7)], [(0, 0)], []]


def test_decontamination_finds_short_items_word_for_word():
    items = ["ten points", "what is the capital of x? y", "a short"]
    own = dc.index(items)
    texts = ["say ten points", "What is  the capital of x? Y", "what is the capital of z? y", "tenpoints", "a short"]
    assert [[(i, e) for i, _, e in f] for f in dc.leaks(texts, own)] == [[(0, 0)], [(1, 0)], [], [], []]


def test_decontamination_recall_of_a_tenth_of_edits():
    """Copies with an edit in every tenth place, and with as many at random places."""
    rng = random.Random(31)
    signs = "abcdefghijklmnopqrstuvw"
    items = ["".join(rng.choice(signs) for _ in range(rng.randint(64, 400))) for _ in range(150)]
    own = dc.index(items)
    for spread in (True, False):
        texts = []
        for item in items:
            at = range(rng.randrange(10), len(item), 10) if spread else rng.sample(range(len(item)), len(item) // 10)
            copy = list(item)
            for k in at:
                copy[k] = rng.choice(["x", "", copy[k] + "y"])
            texts.append("0" * rng.randint(0, 90) + "".join(copy) + "1" * 40)
        found = dc.leaks(texts, own)
        recall = np.mean([i in {x for x, _, _ in f} for i, f in enumerate(found)])
        assert recall >= 0.9, (spread, recall)
        assert all({x for x, _, _ in f} <= {i} for i, f in enumerate(found))


def brute_leaks(text, own):
    body = dc.plain(text)
    return {own.items[w] for w, t in enumerate(own.texts) if edit_distance_in(t, body) <= dc.budget(len(t))}


@pytest.mark.parametrize("ruler", ["=", "-=", "abc", "+--+", "<>|<>"])
def test_decontamination_of_rulers(ruler):
    """Long repetitive stretches, against items that hold some of them, with the place found."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("defghij") for _ in range(n))
    items = [word(20) + (ruler * 60)[:50] + word(20), (ruler * 200)[:150], word(60) + (ruler * 99)[:90], word(70)]
    own = dc.index(items)
    near = lambda n, k: word(30) + (ruler * n)[:n] + items[k][-20:] + word(10)
    texts = [word(40) + (ruler * n)[:n] + word(9) for n in (200, 700, 3000)] + [near(n, k) for n in (300, 900) for k in (0, 2)]
    texts += [items[0] + (ruler * 500) + items[3] + (ruler * 400) + items[2], "\0" + ruler * 300 + "\0\0" + items[3], "", None]
    got = dc.leaks(texts, own)
    assert [{i for i, _, _ in f} for f in got] == [brute_leaks(t, own) for t in texts]
    body = dc.plain(texts[7])
    for i, start, edits in got[7]:
        if i == 3:
            assert edits == 0 and body[start:start + 64] in items[3]


def test_decontamination_memory_does_not_grow_with_a_run():
    """A million equal signs against items that hold runs, in a process of its own."""
    import subprocess
    code = """
import resource, sys
sys.path.insert(0, {root!r})
from martlane.llm import decontaminate as dc
own = dc.index(["intro " * 8 + "=" * n + " outro" * 8 for n in (20, 60, 100, 100, 120)] + ["=-" * 60, "=-+*/" * 30])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = dc.leaks(["a " + "=" * 1_000_000 + " b", "=-+*/" * 100_000], own)
print([sorted({{i for i, _, _ in f}}) for f in found], (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    said = subprocess.run([sys.executable, "-c", code.format(root=root)], capture_output=True, text=True, timeout=300, check=True).stdout
    found, grown = said.rsplit(" ", 1)
    assert int(grown) < 500, grown
    assert "6]" in found


def test_banded_distances():
    rng = random.Random(2)
    windows, regions = [], []
    for n in [40, 25, 40, 60, 31] * 12:
        windows.append("".join(rng.choice("abcd") for _ in range(n)))
        regions.append("".join(rng.choice("abcd") for _ in range(6)) + planted(rng, windows[-1], rng.randrange(5)) + "dcba" * 3)
    got = dc.banded_distances(windows, regions, 24)
    assert got.tolist() == [edit_distance_in(w, r) for w, r in zip(windows, regions)]


def test_language_id(spark):
    rows = [*documents(300), (400, "½ ² 12 _", "en"), (401, "\u0301", "fr")]
    docs = table(spark, rows)
    model = language_id.train(docs)
    out = language_id.predict_languages(docs, model)
    assert out.columns == [*docs.columns, "__lang", "__score", "__rejected"]
    got = out.collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["lang"] and r["doc_id"] is not None and r["text"] and len(r["text"]) > 40
            and __import__("zlib").crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 30 and np.mean([r["lang"] == r["__lang"] for r in held]) > 0.97
    assert np.mean([not r["__rejected"] for r in held]) > 0.97
    for r in got:
        assert 0 <= r["__score"] <= 1
        assert (r["__lang"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    unlabelled = table(spark, [(i, t, None) for i, t, _ in rows[:5]])
    assert {r["__lang"] for r in language_id.predict_languages(unlabelled, language_id.train(unlabelled)).collect()} == {"und"}
    assert language_id.predict_languages(table(spark, []), model).count() == 0


@pytest.mark.parametrize("n", [2, 4])
def test_language_id_can_reject_garbage(n):
    rng = random.Random(11)
    own = [ENGLISH, FRENCH, "der die und das ist nicht ein zu mit auf für von sich den auch".split(),
           "el los una por con para como pero sus más este entre cuando muy sin".split()][:n]
    texts = [(f"l{k}", sentence(rng, words, rng.randint(20, 60))) for _ in range(150) for k, words in enumerate(own)]
    bags = [(np.flatnonzero(c), c[c > 0]) for c in (language_id.counts(t) for _, t in texts)]
    model = language_id.fit(bags, [lang for lang, _ in texts])
    assert model.threshold > 1 / n
    garbage = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300)) for _ in range(40)]
    assert any(model.predict(t)[2] for t in garbage)
    assert np.mean([model.predict(t)[2] for _, t in texts]) < 0.03


FOREIGN = {
    "ja": "これは日本語の文章です。今日は天気がとても良いので公園に散歩に行きました。そこで友達に会って一緒に昼ご飯を食べました。",
    "ru": "Сегодня хорошая погода и мы пошли гулять в парк потому что солнце светит ярко а птицы поют на каждом дереве у реки.",
    "el": "Σήμερα ο καιρός είναι πολύ καλός και πήγαμε μια βόλτα στο πάρκο όπου συναντήσαμε φίλους και φάγαμε μαζί μεσημεριανό.",
    "pl": "Dzisiaj jest bardzo ładna pogoda dlatego poszliśmy na spacer do parku gdzie świeciło słońce i śpiewały ptaki przy rzece.",
    "fi": "Tänään sää on erittäin hyvä joten menimme kävelylle puistoon jossa aurinko paistoi ja linnut lauloivat joen rannalla."}
SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_language_id_rejects_what_it_never_saw(spark):
    """Three unseen scripts, two unseen Latin languages; texts of the learned languages stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    rng, rejected = random.Random(17), {}
    for name, text in FOREIGN.items():
        words = list(text) if name == "ja" else text.split()
        made = [("" if name == "ja" else " ").join(rng.choice(words) for _ in range(rng.randint(30, 90))) for _ in range(60)]
        rejected[name] = np.mean([model.predict(t)[2] for t in made])
    assert min(rejected[x] for x in ("ja", "ru", "el")) >= 0.9 and min(rejected[x] for x in ("pl", "fi")) >= 0.5, rejected
    known = language_id.predict_languages(docs.filter("text rlike '[a-z]' and lang is not null"), model)
    assert known.selectExpr("avg(int(__rejected))").first()[0] < 0.01
    assert language_id.TEMPERATURES[0] < model.temperature < language_id.TEMPERATURES[-1]


def plain_language(model, text):
    """Probabilities and familiarity from the text, n-gram by n-gram."""
    body = " ".join("".join(c if unicodedata_letter(c) else " " for c in text.lower()).split())
    seen = []
    if body:
        data = f" {body} ".encode()
        for n in range(1, language_id.LONGEST + 1):
            for at in range(len(data) - n + 1):
                code = 0
                for b in data[at:at + n]:
                    code = (code * 0x01000193 & 0xFFFFFFFF) ^ b
                seen.append(((code + n) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - language_id.BUCKET_BITS))
    if not seen:
        return "und", 0.0, True
    z = [float(np.mean([model.logits[b, k] for b in seen])) / model.temperature for k in range(len(model.languages))]
    e = [np.exp(x - max(z)) for x in z]
    best = int(np.argmax(z))
    own = float(np.mean([model.shares[best, b] for b in seen])) - model.usual[best] + language_id.SHORT / len(set(seen)) ** 0.5
    return model.languages[best], e[best] / sum(e), e[best] / sum(e) < model.threshold or own < model.least


def unicodedata_letter(c):
    return __import__("unicodedata").category(c).startswith("L")


def test_language_id_against_a_plain_scorer(spark):
    rows = [r for r in documents(40) if not r[1] or len(r[1]) < 3000]
    model = language_id.train(table(spark, documents(200)))
    texts = [t for _, t, _ in rows] + [t[:80] for t in FOREIGN.values()]
    for text in texts:
        want, got = plain_language(model, text or ""), model.predict(text)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=1e-5) and got[2] == want[2], text


def test_language_id_fit_does_not_depend_on_the_partitions(spark):
    rows = documents(80) + [(7, t, "en") for _, t, _ in documents(30)]
    a, b = (language_id.train(table(spark, rows).repartition(n), 20) for n in (1, 5))
    assert np.array_equal(a.logits, b.logits) and a.threshold == b.threshold and a.least == b.least


def test_language_id_counts_do_not_depend_on_the_chunk(monkeypatch):
    text = " ".join(sentence(random.Random(1), FRENCH, 300) for _ in range(4))
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "CHUNK", 64)
    parts = language_id.counts(text)
    assert parts[whole > 0].sum() > 0 and abs(parts.sum() - whole.sum()) / whole.sum() < 0.2


PAGE = """<!DOCTYPE html><html><head><title>Site &amp; title</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><a href="/">Home</a></header><nav><ul><li><a>Menu</a></li><li><a>More</a></li></ul></nav>
<div class="ad">Buy this thing now and here</div><article><h1>{title}</h1><p><b>{one}<br><p>{two}</p>
<aside>Aside words that are not text at all</aside><div class="cookie-notice">We use cookies on this site</div><p>{three}</article>
<div id="comments"><p>First comment by a reader who likes it</p></div><form><label>Name</label><input></form>
<footer>&copy; footer words here</footer></body></html>"""


def pages(n=30):
    rng = random.Random(4)
    rows, truth = [], {}
    for i in range(n):
        title, one, two, three = (sentence(rng, ENGLISH, k) for k in (5, 30, 20, 12))
        one = one.replace(" ", "  \n ", 2) + " a &lt; b &amp;&#233; c"
        rows.append((i, f"http://x/{i}", PAGE.format(title=title, one=one, two=two, three=three)))
        truth[i] = "\n\n".join([title, " ".join(one.replace("&lt;", "<").replace("&amp;", "&").replace("&#233;", "é").split()), two, three])
    return rows, truth


def test_html_extraction(spark):
    rows, truth = pages()
    rows += [(100, "u", None), (101, None, ""), (102, "u", "<p>unclosed <b>words"), (103, "u", "<script>never ends"),
             (104, "u", "no markup &amp; more"), (105, "u", "<div class='ad'>only an advert</div>"),
             (106, "u", "<p>x</p>" * 5000), (0, "again", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = html_extract.train(df)
    got = html_extract.extract(df, weights).collect()
    by_id = {(r.page_id, r.url): r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    for i, text in truth.items():
        assert by_id[i, f"http://x/{i}"].text == text
    assert by_id[0, "again"].text == truth[0]
    assert [by_id[k].text for k in [(100, "u"), (101, None), (103, "u"), (105, "u")]] == [""] * 4
    assert by_id[102, "u"].text == "unclosed words" and by_id[104, "u"].text == "no markup & more"
    assert by_id[106, "u"].text == "\n\n".join("x" * 5000)
    assert html_extract.train(df.limit(0)) == html_extract.DEFAULT
    assert html_extract.extract(df.limit(0), weights).count() == 0


PLAIN_PAGE = """<html><head><title>t</title></head><body><nav><ul><li><a href="/">Menu</a></li></ul></nav>
<div class="ad">Buy this thing now and here</div><article><h1>{}</h1><p>{}</p></article><footer>words here</footer></body></html>"""


def learned_without_boxes():
    """Weights of pages that hold no box inside the article."""
    rng, total = random.Random(14), html_extract.Counter()
    for _ in range(50):
        total.update(html_extract.token_counts(PLAIN_PAGE.format(sentence(rng, ENGLISH, 5), sentence(rng, ENGLISH, 80))))
    all_in, all_out = (1 + sum(n for (_, i), n in total.items() if i == inside) for inside in (True, False))
    weights = dict(html_extract.DEFAULT)
    for kind in {k for k, _ in total}:
        odds = np.log((total[kind, True] + 0.5) / all_in) - np.log((total[kind, False] + 0.5) / all_out)
        least, most = (0.02, 4.0) if kind == "word" else (-4.0, -0.02)
        weights[kind] = float(min(most, max(least, odds)))
    return weights


def test_a_box_inside_the_article_does_not_split_it():
    weights = learned_without_boxes()
    assert weights["word"] == 4 and weights["div"] == -4
    box = "<div><p>" + "box words here " * 60 + "</p></div>"
    for name in ("share", "newsletter", "cookie-notice", "comments"):
        for inner in ("Share this now", box):
            page = (f'<html><body><nav><a>Menu</a></nav><article><h1>A title of five words</h1><div class="{name}">{inner}</div>'
                    f'<p>A short lead.</p><div class="{name}">{inner}</div><p>{"body " * 40}</p></article><footer>f</footer></body></html>')
            assert html_extract.main_text(page, weights).split() == ["A", "title", "of", "five", "words", "A", "short", "lead."] + ["body"] * 40


ARTICLE = "<h1>A title of five words</h1><p>{}</p><p>The end.</p>".format("body " * 40)
NAV, FOOT = '<nav><a href="/">Menu</a><a>More</a></nav>', "<footer>words here</footer>"
HIDDEN, FIELD = '<input type="hidden" name="x">', '<p>Your mail</p><input name="mail"><button>Send</button>'


@pytest.mark.parametrize("page", [
    f'<body><form id="aspnetForm">{HIDDEN}{NAV}<div class="article">{ARTICLE}</div>{FOOT}</form></body>',
    f"<body>{NAV}<article><form>{HIDDEN}{ARTICLE}</form></article>{FOOT}</body>",
    f"<body>{NAV}<form>{HIDDEN}<article>{ARTICLE}</article></form>{FOOT}</body>",
    f"<body>{NAV}<article><fieldset>{ARTICLE}</fieldset></article>{FOOT}</body>",
    f"<body><form>{HIDDEN}{NAV}<article>{ARTICLE}</article><form>{FIELD}</form>{FOOT}</form></body>",
    f"<body>{NAV}<article>{ARTICLE}<form>{FIELD}<fieldset>{FIELD}</fieldset></form></article>{FOOT}</body>",
    f"<body>{NAV}<article>{ARTICLE}</article><form>{FIELD}",
    f"<body>{NAV}<article>{ARTICLE}</article><form class='comment-form'>{ARTICLE}</form></body>"])
def test_a_form_around_the_article_keeps_it(page):
    for weights in (html_extract.DEFAULT, learned_without_boxes()):
        assert html_extract.main_text(page, weights) == "\n\n".join(["A title of five words", "body " * 39 + "body", "The end."])


def test_a_page_of_fields_only_is_empty():
    assert html_extract.main_text("<form><input><button>Go</button></form>", html_extract.DEFAULT) == ""


@pytest.mark.parametrize("name, rest, inside, bad", [
    ("h2", 'class="section-header"', True, False), ("h2", 'class="section-header"', False, False),
    ("div", 'class="elementor-widget-container"', True, False), ("div", 'class="post-tags"', True, False),
    ("label", 'for="x"', True, False), ("label", 'for="x"', False, True), ("div", 'class="site-header"', False, True),
    *[("div", x, inside, True) for inside in (True, False) for x in (
        'class="post-comments"', 'id="article-comments"', 'class="comment-body"', 'class="post-share"', 'class="content-ad"',
        'class="post comments"', 'id="content-1" class="postShare"', 'class="share-buttons"', 'class="ad-slot"', 'class="comment-list"',
        "role=navigation", "hidden", 'class="comment-header"')],
    *[("div", x, inside, False) for inside in (True, False) for x in (
        'class="has-sidebar"', 'class="post ad-supported"', 'class="post hentry category-social"', 'class="entry-content"',
        'role="main" class="search"', 'class="share-story"')]])
def test_each_name_of_a_container_is_judged_by_itself(name, rest, inside, bad):
    assert html_extract.is_boilerplate(name, f" {rest}", inside) == bad


def test_region_is_the_best_run():
    rng = random.Random(8)
    for _ in range(200):
        items = [("word", "a " * rng.randint(1, 4), False) if rng.random() < 0.5 else (rng.choice(["p", "div"]), "", False)
                 for _ in range(rng.randint(0, 12))]
        weights = {"word": 1.0, "p": -0.5, "div": -3.0}
        score = [weights[k] * (len(t.split()) if t else 1) for k, t, _ in items]
        best = max((sum(score[a:b]) for a in range(len(items) + 1) for b in range(a, len(items) + 1)))
        a, b = html_extract.region(items, weights)
        assert sum(score[a:b]) == pytest.approx(best)


def test_bpe_equals_the_public_library(spark):
    from tokenizers import Tokenizer
    texts = [t for _, t, _ in documents()] + [
        "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|", "it's we'll I'VE 'd  x", "  \n\n\t x \x85  y​z",
        "日本語 русский ñandú 12345 ½ ²", "🙂👍🏽 é", "\x00\x1c\x1f\x7f", "a" * 5000, "é" * 3000, "The " * 4000, "﻿x �"]
    library = Tokenizer.from_file(vocabulary_path())
    rows = [(i, t, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in encode_documents(table(spark, rows), vocabulary_path()).collect()}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, dtype="<u4").tobytes()
        assert bytes(got[i].ids) == packed, repr(text)[:60]
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(packed).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest() and got[i].exact
    assert encode_documents(table(spark, []), vocabulary_path()).count() == 0


def test_bpe_splits_all_code_points_as_the_library_does():
    import sys
    from tokenizers import Tokenizer
    from martlane.llm.characters import is_settled
    with open(vocabulary_path()) as f:
        codec = Codec(f.read())
    library = Tokenizer.from_file(vocabulary_path())
    points = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    # the unassigned ones of the upper planes are one class
    points = [c for c in points if ord(c) < 0x20000 or ord(c) % 97 == 0]
    for group in ([c for c in points if is_settled(c)], [c for c in points if not is_settled(c)]):
        for at in range(0, len(group), 2000):
            text = "\n".join(f"{c}'s {c}1 a{c}" for c in group[at:at + 2000])
            got = np.frombuffer(codec.encode(text), dtype="<u4")
            want = library.encode(text, add_special_tokens=False).ids
            assert got.tolist() == want
    assert np.frombuffer(codec.encode("՘'s"), dtype="<u4").tolist() == [145, 246, 6, 82]


def test_bpe_memo_is_bounded(monkeypatch):
    from martlane.llm import bpe
    monkeypatch.setattr(bpe, "MEMO", 10)
    with open(vocabulary_path(), encoding="utf-8") as f:
        codec = Codec(f.read())
    text = " ".join(f"word{i}x" for i in range(200))
    assert codec.decode(codec.encode(text)) == text and len(codec.memo) <= 10


def toxic_corpus(n=900):
    rng = random.Random(6)
    rows, labels, truth = [], [], {}
    for i in range(n):
        bad, low = rng.random() < 0.15, rng.random() < 0.2
        words = sentence(rng, ENGLISH + FRENCH, rng.randint(20, 200)).split()
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["vilified", "scoundrel", "blackguard", "wretchedly"]))
        text = " ".join(w.upper() + "!!" for w in words) if low else " ".join(words)
        rows.append((i, text, None))
        truth[i] = bad
        if i % 2:
            labels.append((i, int(not low), int(bad), "x"))
    return rows, labels, truth


def test_toxicity(spark):
    rows, labels, truth = toxic_corpus()
    rows += [(2000, None, None), (2001, "", None), (2002, "123 !!", None), (1, rows[1][1], None)]
    known = spark.createDataFrame([*labels, labels[0], (None, 1, 1, "x"), (5, None, None, "x"), (9999, 0, 1, "x")],
                                  "doc_id long, quality int, toxic int, text string")
    docs = table(spark, rows)
    chain = toxicity.train(docs, known)
    got = toxicity.predict(docs, chain).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id in truth and r.doc_id % 2 == 0]
    hit = sum(r.toxic and truth[r.doc_id] for r in held)
    assert hit / sum(truth[r.doc_id] for r in held) > 0.95 and hit / sum(r.toxic for r in held) > 0.95
    assert all(not r.toxic and r.p_toxic == 0 for r in got if r.doc_id in (2000, 2001, 2002))
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_low_quality <= 1 for r in got)
    assert chain.categories == ["low_quality", "toxic"] and len(chain.weights[1]) == len(chain.weights[0]) + 1
    one_kind = toxicity.train(docs, known.filter("toxic = 0"))
    assert one_kind is None and not any(r.toxic for r in toxicity.predict(docs, one_kind).collect())
    assert toxicity.train(docs, known.limit(0)) is None
    assert toxicity.predict(table(spark, []), chain).count() == 0


def plain_toxicity(chain, text):
    """Probabilities of the chain from the text alone."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return [0.0] * len(chain.categories)
    present = {f for w in words for f in [w, *("~" + w[i:i + toxicity.GRAM] for i in range(len(w) - toxicity.GRAM + 1))]}
    n = len(text)
    digits, capitals = sum(c in "0123456789" for c in text), sum("A" <= c <= "Z" for c in text)
    other = n - sum(map(len, words)) - digits - sum(c in " \n" for c in text)
    x = [float(f in present) for f in sorted(chain.index, key=chain.index.get)]
    x += [capitals / n, digits / n, max(0, other) / n, 1 - len(set(words)) / len(words)]
    out = []
    for w in chain.weights:
        z = sum(a * b for a, b in zip(w, [*x, *out, 1.0], strict=True))
        out.append(1 / (1 + np.exp(-max(-30, min(30, z)))))
    return out


def test_toxicity_against_a_plain_scorer(spark):
    rows, labels, _ = toxic_corpus()
    rows += [(3000 + i, t, None) for i, (_, t, _) in enumerate(documents(30)) if not t or len(t) < 5000]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    docs = table(spark, rows)
    chain = toxicity.train(docs, known)
    for r in toxicity.predict(docs, chain).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        want = plain_toxicity(chain, text)
        assert [r.p_low_quality, r.p_toxic] == pytest.approx(want, abs=1e-6)
        assert r.toxic == (want[1] >= max(chain.threshold, 1e-9))


def test_toxicity_learns_from_one_text_of_an_id(spark):
    rows, labels, _ = toxic_corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    docs = table(spark, rows + [(i, t + " other words", x) for i, t, x in rows[:50]])
    a, b = (toxicity.train(docs.repartition(n), known) for n in (2, 7))
    assert a.index == b.index and all(np.allclose(x, y) for x, y in zip(a.weights, b.weights, strict=True))
