"""License scans over web pages, in DataFrame functions alone.

1. *Headers.* A header is a sentence of a page's visible text that has a licence word, or three words in a row of a
   template without one. A licence file (LICENSE, COPYING, NOTICE ...) is compared as a whole and by its sentences: short
   licences have their text as a template, long ones the opening of their text and their standard notice. A newline in the source is
   white space; a blank line ends a sentence in text without block tags and in pages with <pre>.
2. *TF-IDF cosine.* Headers and templates are sparse vectors of words, weighted by how rare a word is among all headers
   and templates. Equal headers are one vector; words that no header and template share never meet. A header has the
   licence of the template with the largest cosine, from ``least`` upwards. Words that tell licences of a family apart
   decide first: a template of another version than those that the header states, of another Creative Commons variant
   (NC, ND, SA) or of another GNU licence is out of the question, and a header that fits two licences nearly equally well
   (less than ``GAP`` apart), such as one that names no version, has none: no answer is better than a wrong one.
3. *Inheritance.* Licence files and index pages (a path that ends in "/", index.*, readme*) declare the licence of their
   directory. A page without a licence of its own takes that of the nearest directory above it that declares one: its
   ancestors are joined with the declared directories by (host, path).

Defined results: a page without html or without a header has no licence of its own; one without a url inherits nothing
and declares nothing. A script, style or comment that is never closed hides the rest of the page; patterns look at each
character a bounded number of times, so very long pages take time in proportion. Ties between directories' pages go to the
licence file, the best score, the licence first by name, and the smallest page_id. Repeated rows are repeated in the
result. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncospan.llm.common import Scratch

LEAST = 0.6
GAP = 0.005
LICENCE_WORD = r"(?i)licen[cs]e|copyright|rights reserved|public domain|creative commons|cc by|cc0"
LICENCE_FILE = r"(?i)^(un)?licen[cs]e([-._].*)?$|^copying([-._].*)?$|^notice([-._].*)?$|^copyright([-._].*)?$"
INDEX_FILE = r"(?i)^(index|default|readme)([-._].*)?$"

_FSF = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation, either version {} of the License, or (at your option) any later version")
_FSF_TITLE = "GNU {} Version {} Copyright (C) {} Free Software Foundation, Inc"
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_GPL, _AGPL, _LGPL = "General Public License", "Affero General Public License", "Lesser General Public License"

# Statements by which licences are declared, by SPDX name.
TEMPLATES = (
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "released under the BSD 2-Clause simplified License"),
    ("BSD-3-Clause", "released under the BSD 3-Clause new or revised License"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0"),
    ("CC-BY-4.0", "licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 License, CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 License, CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "this work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "this work is licensed under the GNU General Public License, version 3"),
    ("ISC", "released under the ISC License"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "released under the MIT License"),
    ("MIT", "permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, version 2.0"),
    ("Proprietary", "copyright, all rights reserved"),
    ("Unlicense", "free and unencumbered software released into the public domain"),
    # texts, openings of texts and standard notices
    ("AGPL-3.0", _FSF.format(_AGPL, "3")),
    ("AGPL-3.0", _FSF_TITLE.format(_AGPL, "3, 19 November 2007", "2007")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                   "REPRODUCTION, AND DISTRIBUTION"),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format(_BSD_3)),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", _FSF.format(_GPL, "2")),
    ("GPL-2.0", _FSF_TITLE.format(_GPL, "2, June 1991", "1989, 1991")),
    ("GPL-3.0", _FSF.format(_GPL, "3")),
    ("GPL-3.0", _FSF_TITLE.format(_GPL, "3, 29 June 2007", "2007")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-3.0", _FSF.format(_LGPL, "3")),
    ("LGPL-3.0", _FSF_TITLE.format(_LGPL, "3, 29 June 2007", "2007")),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
            "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
            "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
            "the Software"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    # further families and versions
    ("Apache-1.1", "licensed under the Apache Software License, Version 1.1"),
    ("Artistic-2.0", "licensed under the Artistic License, version 2.0"),
    ("BSD-4-Clause", "released under the BSD 4-Clause original License"),
    ("BSL-1.0", "distributed under the Boost Software License, Version 1.0"),
    ("CDDL-1.0", "subject to the terms of the Common Development and Distribution License, version 1.0"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EUPL-1.2", "licensed under the European Union Public Licence, version 1.2"),
    ("LGPL-2.0", "licensed under the GNU Library General Public License, version 2"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", _FSF.format(_LGPL, "2.1")),
    ("LGPL-2.1", _FSF_TITLE.format(_LGPL, "2.1, February 1999", "1991, 1999")),
    ("MPL-1.1", "subject to the Mozilla Public License Version 1.1"),
    ("WTFPL", "Do What The Fuck You Want To Public License, version 2"),
    ("Zlib", "released under the zlib License"),
)
# Variants and versions of the Creative Commons attribution licences; "4.0" of the first three stands above.
_VARIANTS = (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-SA", "Attribution-ShareAlike"),
             ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
             ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
TEMPLATES += tuple(
    (f"CC-{code}-{version}", text) for code, name in _VARIANTS for version in ("4.0", "3.0", "2.5", "2.0")
    for text in (f"licensed under a Creative Commons {name} {version} License, CC {code} {version}",
                 f"this work is licensed under a Creative Commons {name} {version} "
                 f"{'International' if version == '4.0' else 'Unported' if version == '3.0' else 'Generic'} License",
                 f"licensed under CC {code} {version}")
    if (f"CC-{code}-{version}", text) not in TEMPLATES)

# Words that tell the licences of a family apart, in a header's normal form: lower-case letters, digits, dots, hyphens.
STATED_VERSION = (r"(?:version|versions|\bv|licen[cs]es?|gpl|mpl|epl|eupl|cc0|apache|\bby(?:-[a-z]+)*|attribution[a-z-]*|"
                  r"commercial|alike|deriv[a-z]*|international|unported)[ .-]*v?[ .]?(\d{1,2}(?:\.\d{1,2})?)(?![\d]|\.\d)")
GNU = r"(?:(affero|lesser|library) )?general public licen[cs]e|\b([al]?)gpl"
NC, ND, SA = r"non[ -]?commercial|\bnc\b", r"no[ -]?deriv|\bnd\b", r"share[ -]?alike|\bsa\b"


def signs(statements: tuple[tuple[str, str], ...]) -> str:
    """Pattern that every template passes: a licence word, or three words in a row of a template without one."""
    found = [LICENCE_WORD + "|\u00a9"]
    for _, text in statements:
        if not re.search(LICENCE_WORD, text):
            words = re.findall(r"[^\W_]+", text)
            found += [r"[^\p{L}\p{N}]+".join(words[i:i + 3]) for i in range(len(words) - 2)]
    return "|".join(found)


def literals(statements: tuple[tuple[str, str], ...]) -> list[str]:
    """Lower-case texts of which every match of the signs holds one: those of the licence words, and the longest word of
    each three in a row. One that holds another is left out."""
    found = {"licen", "copyright", "rights reserved", "public domain", "creative commons", "cc by", "cc0", "\u00a9"}
    for _, text in statements:
        if not re.search(LICENCE_WORD, text):
            words = re.findall(r"[^\W_]+", text.lower())
            found |= {max(words[i:i + 3], key=len) for i in range(len(words) - 2)}
    return sorted(w for w in found if not any(o != w and o in w for o in found))


SIGN, LITERALS = signs(TEMPLATES), literals(TEMPLATES)
BLOCK = (r"(p|br|div|li|ul|ol|tr|td|th|table|h[1-6]|header|footer|nav|article|section|title|head|body|html|pre|blockquote)"
         r"\b")


# ------------------------------------------------------------ pages

def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def visible_text(html: Column) -> Column:
    """Text of a page: no scripts, styles, comments or tags; tags that end a block end a line.

    Every pattern ends at the next character that cannot belong to it, or takes all up to its end, so a page of unclosed
    tags or of white space is walked once per pattern.
    """
    def lined(text: Column) -> Column:
        flows = text.rlike(r"(?i)<" + BLOCK) & ~text.rlike(r"(?i)<pre\b")
        lines = F.regexp_replace(F.regexp_replace(text, r"[ \t\r\f\x0B]++", " "), r"\n(?: ?\n)++", "\u2029")
        return F.when(flows, text).otherwise(lines)

    def unmarked(text: Column) -> Column:
        marks = F.regexp_replace(text, r"(?i)&copy;|&#169;|&#xa9;|\u00a9", "copyright ")
        return F.when(F.contains(text, F.lit("&")) | F.contains(text, F.lit("\u00a9")), marks).otherwise(text)

    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*+>|\z)|<!--.*?(?:-->|\z)", " ")
    text = F.regexp_replace(bound(text, lined), r"\s++", " ")
    text = F.regexp_replace(text, r"(?i)</?" + BLOCK + r"[^<>]*+>?|\u2029", "\n")
    text = bound(F.regexp_replace(text, r"<[^<>]*+>", ""), unmarked)
    return F.replace(F.replace(text, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))


def may_hold_sign(text: Column) -> Column:
    """A cheap condition that every text with a sign meets: it holds one of the literals that the signs are made of."""
    def found(low: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(low, F.lit(literal)) for literal in LITERALS])

    return bound(F.lower(text), found)


def place_of(pages: DataFrame) -> DataFrame:
    """Add host, dir (without a "/" at its end; the root is ""), file, and whether the page speaks for its directory."""
    bare = F.regexp_replace("url", r"[?#].*$", "")
    found = pages.withColumns({
        "host": F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]+)", 1)),
        "_path": F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+(/.*)?$", 1)})
    found = found.withColumns({"dir": F.regexp_replace("_path", r"/+[^/]*$", ""),
                               "file": F.regexp_extract("_path", r"([^/]*)$", 1)})
    return found.withColumns({
        "is_licence": F.coalesce(F.col("file").rlike(LICENCE_FILE), F.lit(False)),
        "is_index": F.coalesce((F.col("file") == "") | F.col("file").rlike(INDEX_FILE), F.lit(False)),
    }).withColumn("host", F.when(F.col("host") != "", F.col("host"))).drop("_path")


def headers(pages: DataFrame) -> DataFrame:
    """(page_id, is_licence, header): the sentences with a sign of a licence; of a licence file the whole text, too."""
    def signed(text: Column) -> Column:
        sentences = F.filter(F.split(text, r"\n+|(?<=[.!?])(?<!\bv\.)\s+"),
                             lambda s: may_hold_sign(s) & s.rlike(SIGN))
        # "...; either version 2 of the License" belongs to what is before it
        return bound(sentences, lambda found: F.array_union(found, F.flatten(F.transform(
            F.filter(found, lambda s: F.contains(s, F.lit(";"))),
            lambda s: F.filter(F.split(s, r"(?<=;)\s+"), lambda t: t.rlike(SIGN))))))

    def found(text: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.concat(F.when(F.col("is_licence"), F.array(text)).otherwise(none),
                        F.when(may_hold_sign(text), signed(text)).otherwise(none))

    # the text of every page: tags may part the words of a sign
    rows = pages.select("page_id", "is_licence", F.explode(bound(visible_text(F.col("html")), found)).alias("_h"))
    return rows.select("page_id", "is_licence", F.trim(F.regexp_replace(F.lower("_h"), r"[^\p{L}\p{N}.-]+", " ")).alias("header")
                       ).filter("header <> ''")


# ------------------------------------------------------------ cosine

def _words(column: str) -> Column:
    return F.filter(F.transform(F.split(column, " "), lambda w: F.regexp_replace(w, r"^[.-]+|[.-]+$", "")),
                    lambda w: w != "")


def templates(spark) -> DataFrame:
    """(licence, header): a constant number of rows."""
    rows = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(t).alias("text")) for n, t in TEMPLATES])
    return spark.range(1).select(F.inline(rows)).select(
        "licence", F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}.-]+", " ")).alias("header"))


def _whole_number(version: Column) -> Column:
    return F.regexp_replace(version, r"\.0$", "")


def stated_versions(header: Column) -> Column:
    return F.transform(F.regexp_extract_all(header, F.lit(STATED_VERSION), F.lit(1)), _whole_number)


def agrees(header: Column, licence: Column) -> Column:
    """Whether the decisive words of a header leave a licence possible."""
    stated = stated_versions(header)
    version = _whole_number(F.regexp_extract(licence, r"-(\d+\.\d+)$", 1))
    ok = (version == "") | (F.size(stated) == 0) | F.array_contains(stated, version)
    creative = licence.startswith("CC-BY")
    for sign, part in ((NC, "-NC"), (ND, "-ND"), (SA, "-SA")):
        ok = ok & (~creative | (header.rlike(sign) == F.contains(licence, F.lit(part))))
    # the GNU licence that a header names first: a text may mention the others further down
    word = F.concat(F.regexp_extract(header, GNU, 1), F.regexp_extract(header, GNU, 2))
    named = F.when(word.isin("affero", "a"), "AGPL").when(word.isin("lesser", "library", "l"), "LGPL").otherwise("GPL")
    gnu = licence.rlike("^[AL]?GPL-")
    return ok & (~gnu | ~header.rlike(GNU) | (named == F.regexp_extract(licence, "^[AL]?GPL", 0)))


def match(found: DataFrame, scratch: Scratch, least: float = LEAST, decisive: bool = False) -> DataFrame:
    """(header, licence, score) of every distinct header that a template matches. ``decisive`` leaves out licences that
    the header's decisive words exclude, and headers that two licences fit nearly equally well."""
    spark = found.sparkSession
    distinct = scratch.write(found.groupBy("header").agg(F.count("*").alias("n")), "headers")
    known = templates(spark)
    both = distinct.select("header", "n").unionByName(known.select("header", F.lit(1).cast("long").alias("n")))
    whole = both.agg(F.sum("n")).first()[0]
    rarity = both.select("n", F.explode(F.array_distinct(_words("header"))).alias("word")).groupBy("word").agg(
        (F.log((1 + F.lit(whole)) / (1 + F.sum("n"))) + 1).alias("idf"))
    rarity = scratch.write(rarity, "rarity")

    def vector(rows: DataFrame, *keys: str) -> DataFrame:
        counts = rows.select(*keys, F.explode(_words("header")).alias("word")).groupBy(*keys, "word").agg(
            F.count("*").alias("tf"))
        return counts.join(rarity, "word").select(*keys, "word", (F.col("tf") * F.col("idf")).alias("w"))

    ours = scratch.write(vector(distinct.select("header"), "header"), "vectors")
    theirs = vector(known.select("licence", "header", F.col("header").alias("template")), "licence", "template")
    norms = ours.groupBy("header").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    lengths = Window.partitionBy("licence", "template")
    theirs = theirs.withColumn("u", F.col("w") / F.sqrt(F.sum(F.col("w") ** 2).over(lengths))).drop("w")
    # a few words of each of a constant number of templates: broadcast
    dots = ours.join(F.broadcast(theirs), "word").groupBy("header", "licence", "template").agg(
        F.sum(F.col("w") * F.col("u")).alias("dot"))
    # rounded, so that sums in another order leave ties as they are
    if decisive:
        dots = dots.filter(agrees(F.col("header"), F.col("licence")))
    dots = dots.groupBy("header", "licence").agg(F.max(F.round("dot", 9)).alias("dot"))
    top = F.min(F.struct((-F.col("dot")).alias("minus"), "licence"))
    first = dots.groupBy("header").agg(top.alias("top")).select("header", "top.licence", (-F.col("top.minus")).alias("dot"))
    if decisive:
        rivals = dots.select("header", F.col("licence").alias("other"), F.col("dot").alias("near")).join(
            first, "header").filter("other <> licence").join(norms, "header")
        # nearly as good, or another version where the header states none
        stem = [F.regexp_replace(c, r"-\d+\.\d+$", "") for c in ("licence", "other")]
        unstated = (F.size(stated_versions(F.col("header"))) == 0) & (stem[0] == stem[1])
        rivals = rivals.filter((F.col("near") > F.col("dot") - GAP * F.col("norm")) | unstated).select("header").distinct()
        first = first.join(rivals, "header", "left_anti")
    return first.join(norms, "header").select(
        "header", "licence", F.least(F.lit(1.0), F.col("dot") / F.col("norm")).alias("score")).filter(
        F.col("score") >= least)


# ------------------------------------------------------------ inheritance

def scan(pages: DataFrame, scratch: Scratch, least: float = LEAST) -> DataFrame:
    """page_id, licence, score, origin (header, file, inherited or none), from_page, levels_up for every page."""
    placed = place_of(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
    found = scratch.write(headers(placed), "found")
    matched = scratch.write(match(found, scratch, least, decisive=True), "matched")
    # of several licences in a page the best match, then the first by name; a licence file's text goes before the line
    # "all rights reserved" above it
    reserve = F.col("is_licence") & (F.col("licence") == "Proprietary")
    scored = found.join(matched, "header").filter("page_id is not null")
    own = scratch.write(scored.groupBy("page_id").agg(
        F.min(F.struct(reserve.alias("reserve"), (-F.col("score")).alias("minus"), "licence")).alias("own"))
        .select("page_id", F.col("own.licence").alias("own_licence"), (-F.col("own.minus")).alias("own_score")), "own")
    slim = placed.drop("html", "url").join(own, "page_id", "left")
    slim = scratch.write(slim, "pages")
    speaks = slim.filter("own_licence is not null and host is not null and (is_licence or is_index)")
    declared = speaks.groupBy("host", "dir").agg(F.min(F.struct(
        (~F.col("is_licence")).alias("weak"), (-F.col("own_score")).alias("minus"), F.col("own_licence").alias("licence"),
        F.col("page_id").alias("from_page"))).alias("d"))
    bare = slim.filter("own_licence is null and host is not null and page_id is not null").select(
        "page_id", "host", "dir").distinct()
    steps = F.split("dir", "/")  # "" and then the names
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.struct(
        F.array_join(F.slice(steps, 1, k), "/").alias("dir"), (F.size(steps) - k).alias("levels_up")))
    climbs = bare.select("page_id", "host", F.explode(above).alias("a")).select(
        "page_id", "host", F.col("a.dir").alias("dir"), F.col("a.levels_up").alias("levels_up"))
    nearest = climbs.join(declared, ["host", "dir"]).groupBy("page_id").agg(
        F.min(F.struct("levels_up", F.col("d.licence").alias("licence"), (-F.col("d.minus")).alias("score"),
                       F.col("d.from_page").alias("from_page"))).alias("up"))
    out = slim.join(nearest, "page_id", "left")
    mine = F.col("own_licence").isNotNull()
    return out.select(
        "page_id", F.coalesce("own_licence", "up.licence").alias("licence"),
        F.coalesce("own_score", "up.score").alias("score"),
        F.when(mine & F.col("is_licence"), "file").when(mine, "header").when(F.col("up").isNotNull(), "inherited")
        .otherwise("none").alias("origin"),
        F.when(mine, F.col("page_id")).otherwise(F.col("up.from_page")).alias("from_page"),
        F.when(mine, 0).otherwise(F.col("up.levels_up")).alias("levels_up"))
