"""License scans and page extraction: known cases, brute force, awkward rows."""

import re

from vanecast.llm.htmltext import extract_text, main_text
from vanecast.llm.licenses import BASE, build_rules, detect, license_scan

TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "free. Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.\nAll rights reserved. all RIGHTS reserved",
    "all rights-reserved cc by cc-by; general public\nlicense",
    "émit license, Ünlicense",
    "nothing of the kind",
    "",
    None,
    "word " * 50_000 + "All rights reserved. (c) 2020 x",
]


def test_rules_are_many_and_compile():
    rules = build_rules()
    assert len(rules) > 300 and all(r.keywords and 0 < r.confidence <= 1 for r in rules)


def test_scan(spark):
    data = [(i, t, "a", "b") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None, None), (0, TEXTS[0], "", "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, labels string, id string")
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    assert license_scan(docs).count() == len(data)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, text in enumerate(TEXTS):
        words = word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        places, labels = [], set()
        for phrase, label in BASE.items():
            p = phrase.split()
            here = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == sorted(labels) and set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
        for d in r.detections:
            assert (text or "")[d.start : d.end]
    assert "apache-2.0" in got[0].labels and "cc-by-nc-4.0" in got[1].labels and "gpl-3" in got[2].labels
    assert "mit" in got[3].labels and got[5].labels == [] and got[6].labels == [] and got[6].score == 0
    assert license_scan(docs.limit(0)).collect() == []


def test_gate_changes_nothing():
    """A rule finds nothing in a text without one of its keywords as a word."""
    rules = build_rules()
    text = " ".join(t for t in TEXTS[:5]).lower().encode()
    words = set(re.findall(r"[a-z0-9]+", text.decode()))
    opened = {i for i, r in enumerate(rules) if words & set(r.keywords)}
    assert detect(text, rules, opened) == detect(text, rules, set(range(len(rules))))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li>News</li></ul></nav>
<div class="ad">Buy this now, it is a very long advert with many many words in it to look like text.</div>
<div id="cookie-notice">We use cookies for all kinds of things and want you to agree to them at once.</div>
<article><h1>A &amp; B</h1><p><b>First</b> para&shy;graph&nbsp;is <i>here</i>,
 with a break.<br>And more.</p><p>Short.</p><form><input name=q><button>Go</button></form><p>Last &lt;one&gt;.</article>
<aside>Also read this other story about something else entirely, with many words.</aside>
<section class="comments"><p>First! I am a reader and I have a long opinion on all of this, listen to me.</p></section>
<footer>&copy; 2024 Site</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "A & B\nFirst para\xadgraph is here, with a break. And more.\nShort.\nLast <one>."
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert main_text(plain) == main_text(PAGE)
    assert main_text("") == main_text(None) == main_text("<html><body></body></html>") == ""
    assert main_text("no markup at all") == "no markup at all"
    assert main_text("<article><p>x</p>" + "<p>word</p>" * 5000 + "</article>").count("\n") == 5000


def test_extract(spark):
    data = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, None), (3, "v", "", ""), (4, "w", "<p>" + "x" * 300_000, "")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, text string")
    got = extract_text(pages).collect()
    assert len(got) == 5 and sorted(len(r.text) for r in got) == sorted([len(main_text(PAGE))] * 2 + [0, 0, 300_000])
    assert extract_text(pages.limit(0)).collect() == []


def test_every_article_of_the_table(spark, sf_dir):
    """Against the blocks between the article tags, cut by expressions of its own."""
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "<br>" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


LONG = "This paragraph of the story is long enough to be told from a menu, and it goes on for a while."


def test_cluster_decides_inside_and_outside_regions():
    body = "".join(f"<div>{LONG} {k}</div>" for k in range(6))
    lines = [f"{LONG} {k}" for k in range(6)]
    teaser = f"<article><p>{LONG} teaser</p></article>"
    # body text in plain blocks beside one article
    assert main_text(f"<body>{body}{teaser}</body>").split("\n") == [*lines, f"{LONG} teaser"]
    # heading and lead of main weigh less than its article
    page = f"<body><main><h1>Heading</h1><p>A short lead.</p><article>{body}</article></main></body>"
    assert main_text(page).split("\n") == ["Heading", "A short lead.", *lines]
    # a small article beside a large one
    assert main_text(f"<body><article>{body}</article>{teaser}</body>").split("\n") == [*lines, f"{LONG} teaser"]
    # without article and main, and with lists of links around
    menu = "<ul>" + "".join(f"<li><a href='/{k}'>Menu entry {k}</a></li>" for k in range(8)) + "</ul>"
    assert main_text(f"<body>{menu}{body}{menu}</body>").split("\n") == lines
    assert main_text(f"<body>{menu}<article>{body}</article>{menu}</body>").split("\n") == lines
    # inside a region: a list of links far from the cluster goes, a list of short lines stays
    short = "<ul>" + "".join(f"<li>No {k}</li>" for k in range(8)) + "</ul>"
    assert "Menu entry 7" not in main_text(f"<article>{body}{menu}</article>")
    assert main_text(f"<article>{body}{short}</article>").split("\n") == [*lines, *(f"No {k}" for k in range(8))]


def test_head_without_its_end():
    for start in ("<body><p>", "<p>", "<div>", "<body><main><p>"):
        assert main_text(f"<html><head><meta charset=utf-8><title>T</title>{start}{LONG}") == LONG
    assert main_text(f"<html><head><title>T</title><nav><a href='/'>Home</a></nav><p>{LONG}") == LONG


def test_gate_is_lossless_next_to_any_character(spark):
    """Against all rules on texts with quotes, dashes, CJK and letters around the phrases."""
    import random

    import numpy as np

    from vanecast.llm.kernels import LOWER, text_bytes
    from vanecast.llm.licenses import keyword_gate, open_rules

    rng, rules = random.Random(3), build_rules()
    phrases = ["MIT License", "All rights reserved", "Apache Licenses", "Apache License, Version 2.0", "Licensed under CC BY-SA 4.0", "(c) 2020", "linux.org/licenses"]
    phrases += ["GNU General Public License v3", "SPDX-License-Identifier: MIT", "creativecommons.org/licenses/by/4.0", "New BSD Licences", "not for commercial use"]
    around = ["“", "”", "—", "…", "许可", "é", " ", "x", ".", "\n", "_", "3"]
    texts = ["".join(rng.choice(around) + rng.choice(phrases) + rng.choice(around) for _ in range(rng.randint(0, 3))) for _ in range(600)] + [""]
    import pyarrow as pa

    raw, offsets = text_bytes(pa.array(texts))
    low = LOWER[raw]
    opened = open_rules(low, offsets, keyword_gate(rules))
    every = set(range(len(rules)))
    found = 0
    for k in range(len(texts)):
        part = low[offsets[k] : offsets[k + 1]].tobytes()
        want = detect(part, rules, every)
        found += len(want)
        assert detect(part, rules, opened.get(k, set())) == want
    assert found > 600 and open_rules(np.zeros(0, np.uint8), np.zeros(2, np.int64), keyword_gate(rules)) == {}
    docs = spark.createDataFrame([(1, "“MIT License”"), (2, "“All rights reserved”"), (3, "Apache Licenses")], "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in license_scan(docs).collect()}
    assert labels == {1: ["mit"], 2: ["reserved"], 3: ["apache"]}


def test_only_contained_detections_are_suppressed():
    from vanecast.llm.licenses import Rule

    rule = lambda label, priority, expression: Rule(label, priority, ("a",), re.compile(expression), 0.5)
    rules = [rule("best", 9, b"bc"), rule("overlaps", 5, b"cd"), rule("inside", 7, b"c"), rule("around", 3, b"abcde"), rule("late", 2, b"ab")]
    assert [rules[i].label for i, _, _ in detect(b"abcde", rules, set(range(5)))] == ["around", "best", "overlaps"]
