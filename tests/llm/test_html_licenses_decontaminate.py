import math
import random
import time
import re
from itertools import combinations

from pyspark.sql import functions as F

from hexfold.llm import decontaminate, html_text, licenses


def test_main_text():
    words = "One long sentence, with some words and marks; and more of them. " * 4
    page = f"""<html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><header>Top</header><nav><a href="x>y">Menu</a></nav>
<div class="content"><h1>Head</h1><p><b>{words}<br>next&nbsp;&amp; <i>last</i><p>{words}<!-- <p>no --><ul><li>a<li>b</ul><div class="ad box">Buy, now.</div><p>End</div>
<section class="comments"><p>{words}</p><p>{words}</p></section><footer>Foot</footer>"""
    line = words.strip()
    assert html_text.main_text(page) == f"Head\n{line} next & last\n{line}\na\nb\nEnd"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>never ends") == ""
    assert html_text.main_text("plain   text") == "plain text"


def test_main_text_is_whole():
    """All of the article, whatever part of it holds most; a name puts out nothing that holds most of the page."""
    words = "One long sentence, with some words and marks; and more of them. "
    one, two = (words * 9).strip(), (words * 5).strip()
    article = f"<article><h1>Head</h1><section><p>{one}</p></section><section><p>{two}</p></section><blockquote>{words * 40}</blockquote><p>End</p></article>"
    whole = f"Head\n{one}\n{two}\n{(words * 40).strip()}\nEnd"
    menu = "<nav>Menu</nav><div class='menu'><p>Item</p></div>"
    assert html_text.main_text(f"<body>{menu}{article}</body>") == whole
    for wrapper in ("div class='has-sidebar'", "div id='social-page'", "section class='notice'", "form action=x"):
        assert html_text.main_text(f"<body>{menu}<{wrapper}>{article}</{wrapper.split()[0]}></body>") == whole
    parts = f"<div><div><p>{one}</p><p>{one}</p></div><div><p>{two}</p></div></div>"
    assert html_text.main_text(f"<body>{parts}</body>") == f"{one}\n{one}\n{two}"


def test_names_are_evidence_only():
    """A name that holds the only text puts nothing out; links and notes beside the text go by their ratios, without any name."""
    line = "One long sentence, with some words and marks; and more of them. " * 3
    for name in ("story related-coverage-story", "text-widget entry"):
        assert html_text.main_text(f"<body><div class='{name}'><p>{line}</p></div></body>") == line.strip()
    want = f"{line.strip()}\n{line.strip()}"
    text = f"<p>{line}</p><p>{line}</p>"
    assert html_text.main_text(f"<body><a href=/>Home</a>{text}Privacy Terms</body>") == want
    assert html_text.main_text(f"<body><div><a href=/>Home</a> <a>News</a></div><div>{text}</div><div>Privacy Terms</div></body>") == want
    assert html_text.main_text(f"<body><table><tr><td><a>One</a><td><a>Two</a></table><h2>Title</h2>{text}<ul><li><a>x</a></ul></body>") == f"Title\n{want}"
    # lists and short lines within the text, and at its end in its own element, stay
    assert html_text.main_text(f"<body><div><p>{line}</p><ul><li>a<li>b</ul><p>{line}</p><div>End</div></div><div>x</div></body>") == f"{line.strip()}\na\nb\n{line.strip()}\nEnd"


def test_thresholded_paths_select(monkeypatch):
    line = "One long sentence, with some words and marks; and more of them."
    page = f"<body><div>Home News</div><div><p>{line}</p><p>{line}</p></div><div>Privacy Terms</div></body>"
    with_paths = html_text.main_text(page)
    monkeypatch.setattr(html_text, "selected", lambda nodes: [True] * len(nodes))
    assert html_text.main_text(page) == f"Home News\n{with_paths}\nPrivacy Terms"


def test_ratios_by_brute_force():
    rng = random.Random(7)
    for _ in range(20):
        nodes = [html_text.Node("word, " * rng.randrange(1, 30), rng.randrange(9), 1, rng.randrange(6)) for _ in range(rng.randrange(1, 40))]
        length, marks = [], []
        for n in nodes:
            same = [m for m in nodes if m.path == n.path]
            length.append(sum(len(m.text) - m.links for m in same) / len(same))
            marks.append(sum(m.text.count(",") if m.links < len(m.text) else 0 for m in same) / len(same))
        for i, value in enumerate(html_text.fused(nodes)):
            near = [(math.exp(-2 * (i - j) ** 2), j) for j in range(max(0, i - 1), min(len(nodes), i + 2))]
            mean = lambda v: sum(w * v[j] for w, j in near) / sum(w for w, _ in near)  # noqa: B023, E731
            assert math.isclose(value, mean(length) * (1 + mean(marks)))


def test_long_page_is_whole():
    page = "<article>" + "<p>Some words, and a mark.</p><div>x</div>" * 20_000 + "</article>"
    assert html_text.main_text(page) == "\n".join(["Some words, and a mark.\nx"] * 20_000)


def test_kept_columns_that_clash(spark, docs_of):
    """A kept column with a made one's name becomes <name>_in; null keys stay."""
    pages = spark.createDataFrame([(None, "t", 5, "<p>x</p>")], "page_id long, text string, n_chars long, html string")
    assert html_text.main_texts(pages, keep=("page_id", "text", "n_chars")).collect() == [(None, "t", 5, "x", 1)]
    docs = docs_of([(None, "a b"), (1, None)]).withColumns({c: F.lit(c) for c in ("license", "found", "coverage")})
    rows = licenses.license_scan(docs, keep=("doc_id", "license", "found", "coverage")).collect()
    assert sorted(tuple(r)[1:5] for r in rows) == [("license", "found", "coverage", None)] * 2


def brute_coverage(words, template):
    """Longest common subsequence of the template with any stretch of the text, over the template's length."""
    best = [0] * (len(template) + 1)
    for w in words:
        row = best[:]
        for j, t in enumerate(template, 1):
            row[j] = max(best[j], row[j - 1], best[j - 1] + 1 if w == t else 0)
        best = row
    return best[-1] / len(template)


def test_coverage_against_common_subsequence():
    """Patience alignment covers no more than the longest common subsequence, and all of it where words are unique or edits few."""
    rng = random.Random(3)
    template = licenses.WORD.findall(licenses.TEMPLATES["ISC"].lower())
    for cuts in range(0, 7):
        words = template[:]
        for _ in range(cuts):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], ["changed"], [words[k], "more"]])
        words = ["before"] * 50 + words + ["after"] * 50
        got, most = licenses.best_match(words, template, 0.5)[0], brute_coverage(words, template)
        assert most - 0.05 <= got <= most
    unique = [f"w{i}" for i in range(40)]
    shuffled = unique[:10] + unique[20:30] + unique[10:20] + unique[30:]
    assert licenses.best_match(shuffled, unique, 0.5)[0] == brute_coverage(shuffled, unique) == 0.75


def test_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (1, "u", "<p>é x</p>"), (1, "u", "<p>é x</p>")], "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in html_text.main_texts(pages).collect()) == [("", 0), ("é x", 3), ("é x", 3)]
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_alignment_is_increasing_and_equal():
    a, b = "x the a b c d the e y".split(), "the b d the e z".split()
    pairs = licenses.aligned(a, b)
    assert [a[i] for i, _ in pairs] == ["the", "b", "d", "the", "e"] == [b[j] for _, j in pairs]
    assert all(x < y and u < v for (x, u), (y, v) in combinations(pairs, 2))


def test_license_scan(docs_of):
    body = "filler words of some kind " * 300
    changed = re.sub("free of charge", "at no cost", licenses.TEMPLATES["MIT"])
    texts = [body + licenses.TEMPLATES["MIT"].upper() + body, body + changed, "A.\nReleased under the MIT License.\nReleased under the MIT License.", body, "", None]
    rows = sorted(licenses.license_scan(docs_of(texts)).collect())
    assert [r.license for r in rows] == ["MIT", "MIT", "MIT-line", None, None, None]
    assert rows[0].coverage == 1 and 0.9 < rows[1].coverage < 1 and rows[2].coverage == 1 and (rows[2].first_word, rows[2].last_word) == (1, 5)
    assert licenses.license_scan(docs_of([])).count() == 0


def test_all_licenses_are_found(docs_of):
    body, full = "filler words of some kind " * 100, licenses.full_texts()
    two = licenses.TEMPLATES["MIT-full"] + body + licenses.TEMPLATES["Apache-2.0"]
    texts = ["Licensed under CC BY-NC 4.0.", two, "// SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)", body + re.sub("freedom", "liberty", full["GPL-2-text"]) + body]
    rows = sorted(licenses.license_scan(docs_of(texts)).collect())
    best = [{f.license for f in r.found if f.best} for r in rows]
    assert best[:3] == [{"CC-BY-NC-4.0-short"}, {"MIT-full", "Apache-2.0"}, {"SPDX:GPL-2.0-only", "SPDX:BSD-3-Clause"}]
    assert all(f.coverage >= licenses.LEAST for r in rows for f in r.found) and {"MIT", "MIT-full", "Apache-2.0"} <= {f.license for f in rows[1].found}
    assert next(f.coverage for f in rows[3].found if f.license == "GPL-2-text") > 0.98


def test_containment(spark, docs_of):
    item = "a passage of words that the test set holds, with an end"
    texts = ["x " * 3000 + item.upper().replace(",", " -") + " y" * 3000, item.rsplit(" ", 3)[0], item.rsplit(" ", 1)[0], None, "", (2, item), (None, item)]
    docs = docs_of([t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)])
    items = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (None, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_shared) for r in decontaminate.contained(docs, items).collect())
    assert got == [(0, 1, 8), (2, 1, 7), (2, 1, 8)]
    assert decontaminate.contained(docs, items.limit(0)).count() == 0
    assert decontaminate.contained(docs_of([]), items).count() == 0


def test_hostile_pages_take_time_by_their_length():
    began = time.time()
    assert html_text.main_text("<div>word, text." * 8000).count("word") >= 7200
    for page in ("<a " * 60_000, '<a "x' * 30_000, "<p><section>" + "<h1>x" * 8000, "<b>x" * 20_000, "<b>" * 20_000 + "</x>" * 20_000, '<a b="' * 30_000, "<" * 100_000):
        html_text.main_text(page)
    assert time.time() - began < 20
    assert html_text.main_text("<p>a <b>b <") == "a b <" and html_text.main_text('<p>1 < 2 and "3 > 2"</p>') == '1 < 2 and "3 > 2"'


def test_many_license_tags():
    wanted, n = licenses.prepared(licenses.TEMPLATES), 20_000
    began = time.time()
    found = licenses.scan("".join(f"SPDX-License-Identifier: L-{i}\n" for i in range(n)), wanted)
    assert len(found) == n and all(f[5] for f in found) and sorted(f[3] for f in found)[:2] == [3, 8]
    assert time.time() - began < 20
    (one,) = licenses.scan("İİ x. SPDX-License-Identifier: MIT\n" * 500, wanted)
    assert one[2:5] == ("SPDX:MIT", 6, 6)
    spans = [(5, 9), (1, 4), (9, 12), (20, 22), (0, 30), (23, 25), (13, 13)]
    assert licenses.apart(spans) == [not any(a <= y and x <= b for x, y in spans[:k]) for k, (a, b) in enumerate(spans)]
