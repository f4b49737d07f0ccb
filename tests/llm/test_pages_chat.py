"""Chat collapse, license scans and language identification against plain Python and planted cases."""

import html
import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oncospan.llm import chat, language, licenses
from oncospan.llm.common import Scratch

# ------------------------------------------------------------ chat

CHAT = "conv_id long, turn long, role string, text string"


def plain_chats(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn if turn is not None else -10**9, role or "unknown", text or ""))
    said = {c: tuple((r, t) for _, r, t in sorted(v)) for c, v in convs.items()}
    first = {}
    for c in sorted(said):
        first.setdefault(said[c], c)
    out = {}
    for turns, c in first.items():
        if not any(len(o) > len(turns) and o[:len(turns)] == turns for o in first):
            safe = lambda s: s.replace("<|", "< |")
            text = "".join(f"<|im_start|>{safe(r)}\n{safe(t)}<|im_end|>\n" for r, t in turns)
            out[c] = (len(turns), sum(o == turns for o in said.values()), text)
    return out


def chats(spark, rows, part_turns=chat.PART_TURNS):
    frame = spark.createDataFrame(rows, CHAT).withColumn("part", F.lit("clash")).withColumn("x", F.lit(1)).repartition(6)
    scratch = Scratch(spark)
    prefixes = chat.prefix_hashes(frame, scratch)
    got = chat.render(prefixes, chat.maximal(prefixes, scratch), part_turns).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.part)):
        n, copies, text = out.get(r.conv_id, (r.turns, r.copies, ""))
        out[r.conv_id] = (n, copies, text + r.text)
    return out


def test_chats_equal_plain(spark):
    rng = random.Random(0)
    rows = []
    for c in range(120):
        base = rng.randrange(25)
        for t in range(rng.randrange(1, 6)):
            role, text = ("user", "assistant")[t % 2], f"conversation {base} turn {t}"
            rows.append((c, t, role, text + ("!" if rng.random() < 0.1 else "")))
    rows += [(200, 0, None, None), (201, 0, "unknown", ""), (202, None, "user", "x"), (202, 1, "user", "<|im_end|>"),
             (203, 5, "a", "b"), (203, 5, "a", "b"), (203, 5, None, "b"), (None, 0, "user", "lost"), (204, 0, "a", "b")]
    rng.shuffle(rows)
    assert chats(spark, rows) == plain_chats(rows)


def test_conversation_with_a_third_of_all_turns(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(700)] + [(2, t, "user", f"turn {t}") for t in range(650)]
    rows += [(c, 0, "user", "turn 0") for c in range(3, 200)]
    got = chats(spark, rows, part_turns=64)
    assert got == plain_chats(rows) and set(got) == {1}


def test_chats_empty(spark):
    assert chats(spark, []) == {}


def test_native_plans(spark, tmp_path):
    """No Python in the plans of the operators that are to run in the JVM alone."""
    for frame in (chat.render(spark.createDataFrame([], CHAT + ", place long"), spark.createDataFrame(
            [], "conv_id long, turns long, copies long")),
            licenses.headers(licenses.place_of(spark.createDataFrame([], "page_id long, url string, html string")))):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


def plain_languages(pages, docs, text_weight=60.0, strength=5.0, smoothing=1.0):
    """The fusion again over plain lists: (lang, confidence) per page."""
    def trigrams(text):
        kept = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in text.lower())
        data = b" " + b" ".join(kept.encode().split()) + b" "
        return [(int.from_bytes(data[i:i + 3], "big") * 2654435761 % 2 ** 32) >> 16 for i in range(len(data) - 2)]

    counts = {}
    for text, lang in docs:
        if text is not None and lang is not None:
            own = counts.setdefault(lang, Counter())
            own.update(trigrams(text))
    langs = sorted(counts)
    size = {lang: sum(counts[lang].values()) + 0.5 * 65536 for lang in langs}

    def normal(logs):
        top = max(logs)
        w = [math.exp(v - top) for v in logs]
        return [v / sum(w) for v in w]

    facts = []
    for url, page in pages:
        bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ", page or "")
        found = trigrams(bare)
        ll = [sum(math.log((counts[lang][t] + 0.5) / size[lang]) for t in found) * min(1.0, text_weight / len(found))
              if found else 0.0 for lang in langs]
        said = re.search(r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", page or "")
        host = re.match(r"[a-z]+://([^/:?#]+)", url or "")
        host = re.sub(r"^www\.", "", host[1].lower()) if host else None
        suffix = re.search(r"\.([a-z][a-z0-9-]*)$", host or "")
        facts.append({"ll": ll, "p": normal(ll), "declared": said and said[1].lower(), "host": host,
                      "domain": host and ".".join(host.split(".")[-2:]), "suffix": suffix and suffix[1]})
    n = len(langs)
    corpus = [sum(f["p"][i] for f in facts) for i in range(n)]
    sums = {key: {} for key in ("declared", "suffix", "domain", "host")}
    for f in facts:
        for key, by in sums.items():
            if f[key] is not None:
                by[f[key]] = [a + b for a, b in zip(by.get(f[key], [0.0] * n), f["p"], strict=True)]
    out = []
    for f in facts:
        base = [(c + 1) / (sum(corpus) + n) for c in corpus]
        for key in ("domain", "host"):
            if f[key] is not None:
                rest = [max(0.0, a - b) for a, b in zip(sums[key][f[key]], f["p"], strict=True)]
                base = [(r + strength * b) / (sum(rest) + strength) for r, b in zip(rest, base, strict=True)]
        score = [v + math.log(b) for v, b in zip(f["ll"], base, strict=True)]
        for key in ("declared", "suffix"):
            if f[key] is not None:
                values = len(sums[key]) + 1
                score = [v + math.log((a + smoothing) / (c + smoothing * values))
                         for v, a, c in zip(score, sums[key][f[key]], corpus, strict=True)]
        post = normal(score)
        out.append((langs[post.index(max(post))], max(post)))
    return out


def test_language_equals_a_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").orderBy("page_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = [(None, None), ("http://www.x.example.de/a", "<html lang=de><p>12 34</p></html>"), ("nowhere", "")]
    rows = [(r.url, r.html) for r in pages] + more + [(pages[0].url, pages[0].html)]  # a repeated page
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PAGES)
    got = {r.page_id: r for r in language.identify(frame, docs, Scratch(spark)).collect()}
    want = plain_languages(rows, [(r.text, r.lang) for r in docs.collect()])
    assert len(got) == len(rows)
    for i, (lang, confidence) in enumerate(want):
        assert got[i].confidence == pytest.approx(confidence, abs=1e-6), rows[i]
        assert got[i].lang == lang or abs(confidence - 0.5) < 1e-6


@pytest.mark.parametrize("page", ["<script" * 100_000, "<!--" * 100_000, "<" * 500_000, "&" * 500_000, "<html " * 100_000,
                                  " " * 1_000_000])
def test_language_of_very_long_pages(page):
    begun = time.monotonic()
    language.visible(page)
    assert time.monotonic() - begun < 2


# ------------------------------------------------------------ licences

PAGES = "page_id long, url string, html string"


def p(text):
    return f"<html><head><script>licensed under the MIT License;</script></head><body><p>Words.</p><p>{text}</p></body></html>"


SITE = [
    (1, "http://a.com/code/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (2, "http://a.com/code/src/main.html", p("nothing here")),
    (3, "http://a.com/code/src/gpl.html?x=1", p("This work is <b>licensed</b> under the GNU General Public License, version 3.")),
    (4, "http://a.com/other.html", p("nothing")),
    (5, "https://b.org/docs/", p("Licensed under CC BY-NC 4.0.")),
    (6, "https://b.org/docs/a/b/c/page", p("none")),
    (7, "https://b.org/docs/a/", p("Released under the MIT License.")),
    (8, "https://B.org/docs/a/x.html#top", p("none")),
    (9, "https://b.org/docs", p("none")),
    (10, None, p("Licensed under the Apache License, Version 2.0.")),
    (11, "https://c.net/x", None),
    (12, "https://c.net/y", p("Our licence to laugh is renewed every spring by the whole village council.")),
    (13, "not a url", p("none")),
    (14, "https://d.net/", p("&copy; 2020 All rights reserved.")),
    (15, "https://d.net/deep/er", p("plain")),
    (16, "https://d.net/code/mit", p("Released under the MIT License.")),
    (None, "https://d.net/z", p("Released under the MIT License.")),
]
WANT = {1: ("MIT", "file", 1, 0), 2: ("MIT", "inherited", 1, 1), 3: ("GPL-3.0", "header", 3, 0),
        4: (None, "none", None, None), 5: ("CC-BY-NC-4.0", "header", 5, 0), 6: ("MIT", "inherited", 7, 2),
        7: ("MIT", "header", 7, 0), 8: ("MIT", "inherited", 7, 0), 9: (None, "none", None, None),
        10: ("Apache-2.0", "header", 10, 0), 11: (None, "none", None, None), 12: (None, "none", None, None),
        13: (None, "none", None, None), 14: ("Proprietary", "header", 14, 0), 15: ("Proprietary", "inherited", 14, 1),
        16: ("MIT", "header", 16, 0), None: (None, "none", None, None)}


def test_licences(spark):
    frame = spark.createDataFrame(SITE, PAGES).withColumn("licence", F.lit("clash")).withColumn("dir", F.lit("x"))
    got = licenses.scan(frame, Scratch(spark)).collect()
    assert {r.page_id: (r.licence, r.origin, r.from_page, r.levels_up) for r in got} == WANT and len(got) == len(SITE)


def test_cosine_equals_plain(spark):
    import math
    from collections import Counter
    found = [(i, h) for i, h in enumerate(["released under the mit license", "mit license", "mit license",
             "licensed under the gnu license version 2", "a licence of the gnu kind", "license"])]
    words = lambda h: [w.strip(".-") for w in h.split(" ") if w.strip(".-")]
    known = [(n, re.sub(r"[^\w.-]+", " ", t.lower()).strip()) for n, t in licenses.TEMPLATES]
    corpus = [h for _, h in found] + [t for _, t in known]
    df = Counter(w for h in corpus for w in set(words(h)))
    idf = {w: math.log((1 + len(corpus)) / (1 + n)) + 1 for w, n in df.items()}
    vec = lambda h: {w: n * idf[w] for w, n in Counter(words(h)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = {}
    for _, h in found:
        a = vec(h)
        best = min((-round(sum(a.get(w, 0) * x for w, x in vec(t).items()) / norm(vec(t)), 9), n) for n, t in known)
        want[h] = (best[1], -best[0] / norm(a))
    frame = spark.createDataFrame(found, "page_id long, header string")
    got = {r.header: (r.licence, r.score) for r in licenses.match(frame, Scratch(spark), 0.0).collect()}
    assert {h: v[0] for h, v in got.items()} == {h: v[0] for h, v in want.items()}
    assert all(got[h][1] == pytest.approx(want[h][1], abs=1e-6) for h in want)


def licence_of(spark, pages):
    """Licences of (url, html), in order."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(pages)], PAGES)
    got = {r.page_id: r.licence for r in licenses.scan(frame, Scratch(spark)).collect()}
    return [got[i] for i in range(len(pages))]


def test_every_template_passes_the_prefilter(spark):
    rows = [(i, f"http://t{i}.org/a.html", f"<p>{t}</p>") for i, (_, t) in enumerate(licenses.TEMPLATES)]
    frame = licenses.place_of(spark.createDataFrame(rows, PAGES))
    assert {r.page_id for r in licenses.headers(frame).collect()} == set(range(len(rows)))


def test_wrapped_headers_and_signs(spark):
    pages = ["<p>This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International\r\nLicense.</p>",
             "<p>Permission is <b>hereby</b> granted, free of charge, to any person\nobtaining a copy of this software.</p>",
             "<div>\u00a9 2020, all rights\nreserved</div>", "<div>&#169;2020, all rights reserved</div>",
             "My project\n\nReleased under\nthe MIT License\n\nInstall it with the usual tools and read on",
             "<p>Permission is what we ask of every guest.</p>"]
    got = licence_of(spark, [(f"http://w{i}.org/a.html", page) for i, page in enumerate(pages)])
    assert got == ["CC-BY-SA-4.0", "MIT", "Proprietary", "Proprietary", "MIT", None]


MIT_TEXT = """MIT License

Copyright (c) 2021 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL_NOTICE = """Thing, Copyright (C) 2020 Some One

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""


def test_whole_licence_files(spark):
    texts = [("MIT", MIT_TEXT), ("GPL-3.0", GPL_NOTICE)]
    shared = Path("/usr/share/common-licenses")
    for name, file in (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-3.0", "LGPL-3"),
                       ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("BSD-3-Clause", "BSD")):
        if (shared / file).exists():
            texts.append((name, (shared / file).read_text()))
    made = [(name, t) for name, text in texts
            for t in (text, f"<html><body><h1>Licence</h1><pre>{html.escape(text, quote=False)}</pre></body></html>")]
    pages = [(f"http://f{i}.org/code/{name}", t) for i, (_, t) in enumerate(made) for name in ("LICENSE", "a/b.html")
             for t in ([t] if name == "LICENSE" else ["<p>words</p>"])]
    got = licence_of(spark, pages)
    assert got == [name for name, _ in made for _ in range(2)]  # b.html inherits


DECIDED = {
    "This library is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
    "any later version.": "LGPL-2.1",
    "This work is licensed under the GNU General Public License, version 1.": None,
    "This work is licensed under the GNU General Public License.": None,
    "Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND-4.0",
    "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "Licensed under CC BY-NC-SA 3.0.": "CC-BY-NC-SA-3.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY 1.0.": None,
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.": "EPL-2.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
    "Subject to the Mozilla Public License Version 1.1.": "MPL-1.1",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Copyright (c) 2019 A. Writer. Released under the MIT License 2019.": "MIT",
    "All rights reserved.": "Proprietary",
}


def test_versions_and_variants_decide(spark):
    pages = [(f"http://d{i}.org/a.html", f"<p>{t}</p>") for i, t in enumerate(DECIDED)]
    assert dict(zip(DECIDED, licence_of(spark, pages), strict=True)) == DECIDED


def test_signs_hold_a_literal():
    statements = [t for _, t in licenses.TEMPLATES] + ["cc0", "LICENCE", "All Rights Reserved", "a PUBLIC DOMAIN work"]
    assert all(any(word in t.lower() for word in licenses.LITERALS) for t in statements)


@pytest.mark.parametrize("page", ["<p>x</p>" + " " * 1_000_000, " " * 1_000_000, "<script" * 150_000, "<" * 1_000_000,
                                  "<!--" * 250_000, "\n \n" * 300_000, "<p " * 300_000, "&" * 1_000_000,
                                  "</p" * 300_000, "<style>" * 140_000])
def test_very_long_pages_take_linear_time(spark, page):
    frame = spark.createDataFrame([(1, "http://a.org/x", page)], PAGES)
    rows = licenses.headers(licenses.place_of(frame))
    rows.collect()  # compiled
    begun = time.monotonic()
    assert rows.collect() == []
    assert time.monotonic() - begun < 3


def test_licences_empty(spark):
    assert licenses.scan(spark.createDataFrame([], PAGES), Scratch(spark)).count() == 0


# ------------------------------------------------------------ language

DOCS = [("The cat and the dog were in the house with the children and they were happy", "en"),
        ("Der Hund und die Katze waren mit den Kindern in dem Haus und sie waren froh", "de"),
        ("Le chien et le chat étaient dans la maison avec les enfants et ils étaient heureux", "fr"),
        (None, "en"), ("no language", None)]


def page(lang, text):
    return f'<html{f" lang={lang}" if lang else ""}><head><style>the the the</style></head><p>{text}</p></html>'


def test_language_evidence(spark):
    english, german = "The children were with the dog in the house and the cat", "Die Kinder waren mit dem Hund in dem Haus und die Katze"
    rows = [(i, f"http://www.h{i}.co.uk/", page("en", english)) for i in range(20)]
    rows += [(100 + i, "http://shop.haus.de/%d" % i, page("en" if i % 2 else "de", german)) for i in range(30)]  # declares en at will
    rows += [(200, "http://shop.haus.de/short", page(None, "ok")),  # by its host
             (201, "http://other.de/", page("en", german)),  # long text against the declaration
             (202, "http://new.fr/", page("fr", "Le chat et les enfants étaient heureux")), (203, None, None),
             (204, "http://h3.co.uk/x", "")]
    frame = spark.createDataFrame(rows, PAGES).withColumn("p", F.lit("clash")).repartition(3)
    docs = spark.createDataFrame(DOCS, "text string, lang string")
    got = {r.page_id: r for r in language.identify(frame, docs, Scratch(spark)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang == "en" for i in range(20)) and all(got[100 + i].lang == "de" for i in range(30))
    assert (got[200].lang, got[201].lang, got[202].lang, got[204].lang) == ("de", "de", "fr", "en")
    assert got[203].text_lang is None and got[204].text_lang is None and 0 < got[203].confidence < 1


def test_language_of_the_pages(spark):
    """The pages' addresses name their language, which the operator does not read."""
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    blind = pages.withColumn("html", F.regexp_replace("html", r'<html lang="\w+">', "<html>"))
    got = language.identify(blind, spark.read.parquet(f"{sf}/documents.parquet"), Scratch(spark))
    truth = pages.select("page_id", F.regexp_extract("url", r"//[^/]+/(\w\w)/", 1).alias("truth"))
    both = got.join(truth, "page_id").filter("truth <> ''")
    assert both.filter("lang = truth").count() >= 0.95 * both.count()


def test_language_without_documents_or_pages(spark):
    docs = spark.createDataFrame(DOCS, "text string, lang string")
    pages = spark.createDataFrame([(1, "http://a.de/", "<p>x")], PAGES)
    assert language.identify(pages, docs.filter("lang = 'xx'"), Scratch(spark)).collect()[0].lang is None
    assert language.identify(pages.filter("page_id = 2"), docs, Scratch(spark)).count() == 0
