"""Licences, benchmark passages, main text and web archives."""

import base64
import gzip
import hashlib
import random
import time

import pytest

from checks.compare import differences, duck
from roadbook.llm import decontaminate, html, licenses, queries, warc

LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_license_lines_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    wanted = {(r.doc_id, LINES[line]) for r in docs for line in (r.text or "").split("\n") if line in LINES}
    rows = queries.queries()["op1_licenses"](spark, sf_dir).collect()
    assert {(r.doc_id, r.license) for r in rows} == wanted
    texts = {r.doc_id: r.text for r in docs}
    assert all(texts[r.doc_id][r.begin : r.end] + "." in LINES and not r.differences for r in rows)


@pytest.mark.parametrize("name, form", [(n, k) for n, texts in licenses.TEMPLATES.items() for k in range(len(texts))])
def test_each_template_is_found(name, form):
    text = licenses.TEMPLATES[name][form]
    found = licenses.scan_text(f"Some prose before it.\n{text.replace('<owner>', 'Some Body Ltd')}\nAnd after.")
    assert [f[0] for f in found] == [name]


def test_wording_decides():
    assert [f[0] for f in licenses.scan_text("Licensed under CC BY-SA 4.0.")] == ["CC-BY-SA-4.0"]
    assert [f[0] for f in licenses.scan_text("Licensed under CC BY 4.0. Released under the MIT License.")] == ["CC-BY-4.0", "MIT"]
    assert licenses.scan_text("Licensed under CC BY-NC 3.0.") == []
    assert licenses.scan_text("The licensed electrician asked for permission.") == []
    body = licenses.TEMPLATES["MIT"][3].replace("included in all copies", "included within all copies")
    assert [(f[0], f[5]) for f in licenses.scan_text(body)] == [("MIT", ["-in", "+within"])]


@pytest.mark.parametrize("size", [2_000, 5_000, 20_000])
def test_notices_inside_long_lines(size):
    """A notice that saves nothing, as its line is long, is found all the same, wherever it stands."""
    chance = random.Random(size)
    for notice, name in (("Released under the MIT License.", "MIT"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"), (licenses.TEMPLATES["ISC"][0], "ISC")):
        for place in (0.0, 0.3, 0.5, 0.77, 1.0):
            prose = ["".join(chance.choice("abcdefghilmnoprstu") for _ in range(chance.randint(2, 9))) for _ in range(size // 6)]
            at = int(place * len(prose))
            text = " ".join([*prose[:at], notice, *prose[at:]])
            hits = licenses.scan_text(text)
            assert [(h[0], text[h[2] : h[3]]) for h in hits] == [(name, notice.rstrip("."))]


def test_all_notices_of_a_long_line():
    line = " and so on and on ".join(["Released under the MIT License." + " word" * 400, "Licensed under CC BY-SA 4.0." + " text" * 900] * 5)
    assert [h[0] for h in licenses.scan_text(line)] == ["MIT", "CC-BY-SA-4.0"] * 5


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE FOR ANY DAMAGES.
"""
GNU = """{0} is free software{1} you can redistribute it and/or modify
it under the terms of the GNU {2}General Public License as published by
the Free Software Foundation{3} either version {4} of the License, or
(at your option) any later version.
"""


@pytest.mark.parametrize("prefix", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("name, text", [
    ("BSD-3-Clause", BSD + BSD_NAMES + BSD_END), ("BSD-2-Clause", BSD + BSD_END),
    ("BSD-3-Clause", (BSD + BSD_NAMES).replace("1. ", "(1) ").replace("2. ", "(2) ").replace("3. ", "(3) ")),
    ("GPL-2.0", GNU.format("This program", ";", "", ";", "2")), ("GPL-3.0", GNU.format("This program", ":", "", ",", "3")),
    ("LGPL-2.1", GNU.format("This library", ";", "Lesser ", ";", "2.1")), ("LGPL-3.0", GNU.format("This library", ":", "Lesser ", ",", "3")),
    ("LGPL-3.0", GNU.format("This program", ":", "Lesser ", ",", "3")), ("AGPL-3.0", GNU.format("This program", ":", "Affero ", ",", "3")),
])
def test_notices_as_they_are_written(name, text, prefix):
    body = "".join(prefix + line + "\n" for line in text.splitlines())
    for whole in (body, f"int main\n\n{body}\nsome code behind it\n", f"{body}\n\n\n\n\n\nReleased under the MIT License."):
        found = [h[0] for h in licenses.scan_text(whole)]
        assert found == [name] + ["MIT"] * ("MIT License" in whole)


def test_numbers_that_are_not_of_a_list_tell():
    assert licenses.words("met: 1. Redis 2.0 version 3. You")[1:] == [(w, *p) for w, *p in [("redis", 8, 13), ("2.0", 14, 17), ("version", 18, 25), ("3", 26, 27), ("you", 29, 32)]]
    assert licenses.scan_text("Licensed under the GNU General Public License, version 1. All rights.") == []


def test_licenses_of_odd_input(odd_docs, no_docs, make_docs):
    assert licenses.scan_licenses(odd_docs).count() == licenses.scan_licenses(no_docs).count() == 0
    long = "word " * 50_000 + "\nReleased under the MIT License.\n" + "word " * 50_000
    docs = make_docs([(1, long), (1, long), (None, "Released under the MIT License.")], "license form begin saved id")
    assert [(r.id, r.license) for r in licenses.scan_licenses(docs).orderBy("id").collect()] == [(None, "MIT"), (1, "MIT"), (1, "MIT")]


def _distance(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(pattern, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


def test_passages_against_brute_force(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect()]
    chance = random.Random(3)
    for _ in range(60):
        item = chance.choice(items)
        pattern = decontaminate.plain(item.text)
        letters = list(pattern)
        for _ in range(chance.randint(0, len(pattern) // 10 + 4)):
            at = chance.randrange(len(letters))
            letters[at : at + chance.randint(0, 1)] = chance.choice(["", "q", "zz"])
        text = chance.choice(prose)[: chance.choice([0, 5, 150])] + " " + "".join(letters) + " " + chance.choice(prose)[:100]
        found = decontaminate.Passages([(item.item_id, item.text)]).find([text])
        wanted, allowed = _distance(pattern, decontaminate.plain(text)), int(0.1 * len(pattern))
        assert [f[4] for f in found] == ([wanted] if wanted <= allowed else [])
        for f in found:
            assert _distance(pattern, decontaminate.plain(text)[f[2] : f[3]]) == wanted


def test_passages_of_all_lengths():
    """Every length from the shortest on, with edits up to and over the allowed ones, against brute force."""
    chance, letters = random.Random(5), "abcdefgh ij"
    for size in list(range(decontaminate.SHORTEST, 45)) * 6:
        pattern = "k" + "".join(chance.choices(letters.replace(" ", ""), k=size - 2)) + "k"
        allowed, edited = size // 10, list(pattern)
        for at in chance.sample(range(size), k=chance.randint(0, allowed + 1)):
            edited[at] = chance.choice(["", "z", edited[at] + "z"])
        text = decontaminate.plain("".join(chance.choices(letters, k=30)) + "".join(edited) + "".join(chance.choices(letters, k=30)))
        wanted = _distance(pattern, text)
        found = decontaminate.Passages([(1, pattern)]).find([text])
        assert [f[4] for f in found] == ([wanted] if wanted <= allowed else [])


def test_passages_of_the_table(spark, sf_dir):
    docs = {r.doc_id: decontaminate.plain(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: decontaminate.plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    rows = queries.queries()["op10_decontaminate"](spark, sf_dir).collect()
    exact = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    assert {(r.doc_id, r.item_id) for r in rows if r.edits == 0} == exact
    assert all(_distance(items[r.item_id], docs[r.doc_id]) == r.edits for r in rows if r.edits)


def test_passages_of_odd_input(spark, odd_docs, no_docs, make_docs, monkeypatch):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, None), (2, ""), (3, "abc"), (4, "a passage of some length here"), (4, "a passage of some length here"), (None, "ABC")], "item_id long, text string")
    assert decontaminate.find_passages(odd_docs, none).count() == decontaminate.find_passages(no_docs, items).count() == 0
    assert decontaminate.drop_contaminated(odd_docs, none).count() == odd_docs.count()
    docs = make_docs([(1, "abc"), (2, "abc abc"), (3, "see A  passage of\nsome length here!"), (3, "see A  passage of\nsome length here!"), (None, None), (5, "x" * 300_000)], "item_id begin edits id")
    wanted = [(1, 3), (1, None), (3, 4), (3, 4), (3, 4), (3, 4)]
    for limit in (decontaminate.BLOCK_ITEM_CHARS, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEM_CHARS", limit)
        found = decontaminate.find_passages(docs, items)
        assert sorted(map(str, [(r.id, r.item_id) for r in found.collect()])) == sorted(map(str, wanted))
        kept = decontaminate.drop_contaminated(docs, items)
        assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "5", "None"]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "</p><p>x</p>";</script><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home, sweet</a></ul></nav><div id="cookie-notice">We use cookies, yes, all</div>
<div class="page"><div class="content"><h2>T&eacute;st &amp; more</h2><p>First para, with commas, and <a title="a>b">link</a> text,
that is long.<p>Second&nbsp;para<br>goes   on, <b>bo</b>ld, here.<ul><li>one<li>two</ul><div class="ad-box">Buy, buy, buy</div><p>Last, not least.</div>
<div class="sidebar"><p>Side, side, side, lots of, commas, here</p></div></div>
<section id="comments"><p>Reader, says, much, indeed</p></section><form><p>Name, mail</p></form><footer>Foot, er</footer></body></html>"""


def test_main_text():
    wanted = ["Tést & more", "First para, with commas, and link text, that is long.", "Second para goes on, bold, here.", "one", "two", "Last, not least."]
    assert html.main_text(PAGE) == "\n\n".join(wanted)
    inner = "<article><header><h1>Head</h1></header><section><p>a, b, c</p></section><section><p>d</p></section><aside>no</aside></article>"
    assert html.main_text(f"<body><p>before, it, all</p>{inner}<p>after</p></body>") == "Head\n\na, b, c\n\nd"
    assert html.main_text("<body>Direct text<br>here<p>and a paragraph</body>") == "Direct text here\n\nand a paragraph"


@pytest.mark.parametrize("part, stays", [
    ('<div class="site-header"><p>x, y</p></div>', False), ('<div class="article-header"><p>x, y</p></div>', True),
    ('<div class="wide no-sidebar"><p>x, y</p></div>', True), ('<div id="topNav"><p>x, y</p></div>', False),
    ('<div class="post_comments"><p>x, y</p></div>', False), ('<div class="commentary"><p>x, y</p></div>', True),
    ('<div role="complementary"><p>x, y</p></div>', False), ('<div aria-hidden="true"><p>x, y</p></div>', False),
    ('<div style="display: none"><p>x, y</p></div>', False), ('<div class="adverts"><p>x, y</p></div>', False),
    ('<div class="shadow"><p>x, y</p></div>', True), ("<table><tr><td>x, y<td>z</table>", True),
])
def test_named_parts(part, stays):
    found = html.main_text(f"<body><div><p>One, two, three.</p>{part}<p>Four, five, six.</p></div></body>")
    assert ("x, y" in found) == stays and found.startswith("One, two, three.") and found.endswith("Four, five, six.")


@pytest.mark.parametrize("source, wanted", [
    (None, ""), ("", ""), ("no tags, at all", "no tags, at all"), ("<p>a<p>b", "a\n\nb"), ("<article></article>", ""),
    ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"), ("<!-- never closed <p>x</p>", ""), ("<div>" * 3000 + "deep", "deep"),
    ("<p>&lt;b&gt; &#x41;&#66;</p>", "<b> AB"), ("<script>x", ""), ("</p></div>a", "a"), ("<nav>only, this</nav>", ""),
])
def test_odd_pages(source, wanted):
    assert html.main_text(source) == wanted


WRAPPERS = [
    "<article>{}</article>", '<div class="content">{}</div>', '<form action="/"><input name="q"><label>Mail</label>{}<button>Send, now</button></form>',
    '<div class="content-sidebar-wrap">{}</div>', '<div class="share-article"><div>{}</div></div>', '<form><div id="promo-body">{}</div></form>',
    '<div class="widget">{}</div>', "<main><form>{}</form></main>",
]
AROUND = [
    '<nav><a href="/">Home</a></nav>', '<div class="sidebar"><p>Side, side.</p></div>', "<form><p>Name, mail</p><input></form>",
    '<div class="cookie-bar"><p>We use cookies, yes.</p></div>', '<section id="comments"><p>So, so, so much, indeed, he said. {}</p></section>',
    "<aside><p>See, also</p></aside>", '<div class="ad">Buy, buy</div>', "<footer>Foot, er</footer>", "<script>a('<p>x</p>')</script>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_articles_in_wrappers(wrapper):
    """Pages put together from parts, of which the article is known."""
    chance = random.Random(wrapper)
    words = "engine, road fuel, driver brake route winter, the of and long".split(" ")
    for _ in range(40):
        blocks = [" ".join(chance.choices(words, k=chance.randint(15, 60))) + "." for _ in range(chance.randint(4, 9))]
        inner = "".join(f"<p>{b}</p>" + chance.choice(["", "", '<div class="ad">Buy, buy</div>', "<button>Go</button>"]) for b in blocks)
        before, after = (chance.sample(AROUND, k=chance.randint(0, 4)) for _ in range(2))
        page = "".join(before).format("") + wrapper.format(inner) + "".join(after).format("Long, longer. " * 10)
        assert html.main_text(f"<body>{page}</body>") == "\n\n".join(blocks)


def test_long_comments_are_no_wrapper():
    page = '<body><div><p>A short, plain article.</p></div><div id="comments"><p>' + "much, more, " * 200 + "</p></div></body>"
    assert html.main_text(page) == "A short, plain article."
    page = '<body><article><p>A short, plain article.</p></article><div class="sidebar"><p>' + "much, more, " * 200 + "</p></div></body>"
    assert html.main_text(page) == "A short, plain article."


def test_formulas_stay():
    formula = "<math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x^1</annotation></math>"
    assert html.main_text(f"<body><p>Let {formula} be a number.</p></body>") == "Let x+1 be a number."


@pytest.mark.parametrize("piece", ["<a href='x", "<a '>", "<a \"'>", "<![CDATA[x>", "<a", "<!--x", "<p 'x\">", "</a '"])
@pytest.mark.parametrize("end", ["", ">", "'>", "]]><p>x"])
def test_tags_that_never_close_take_no_longer(piece, end):
    begin = time.perf_counter()
    html.main_text(piece * (1_000_000 // len(piece)) + end)
    assert time.perf_counter() - begin < 10


def test_main_text_of_the_table(spark, sf_dir):
    rows = queries.queries()["op9_main_text"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r.text and len(r.text) == r.n_chars and "<" not in r.text for r in rows)
    clash = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x")], "page_id long, url string, html string, n_chars string")
    assert [r.n_chars for r in html.extract(clash).collect()] == [len(html.main_text(PAGE))] * 2
    assert html.extract(clash.limit(0)).count() == 0


def test_archives_against_sql(spark, sf_dir):
    found = queries.queries()["op8_warc"](spark, sf_dir).toArrow()
    assert differences(found, duck(sf_dir).sql(queries.oracle_sql()["op8_warc"]).to_arrow_table()) == []


ODD_PAGES = [
    (1, "http://a.example/x?y=1", None), (2, None, ""), (3, "http://b.example/\r\nX: y", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n" * 50),
    (4, "http://c.example", "z" * 1500), (5, "http://d.example", "z" * 1500), (5, "http://d.example", "z" * 1500),
    (5, "http://e.example", "z" * 1500), (6, "u", "short"), (7, "u", "short"), (None, "http://[bad", "é\r\n\r\n" * 600),
    (8, "http://f.example", "y" * 3_000_000),
]


def test_odd_archives(spark, tmp_path):
    pages = spark.createDataFrame(ODD_PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS stored", "2 AS body")
    warc.write_archives(pages, str(tmp_path / "out"))
    records = warc.read_records(spark, str(tmp_path / "out"))
    rows = warc.assemble(records).collect()
    got = {}
    for r in rows:
        assert r.n_requests == r.n_metadata == 1
        got.setdefault(r.metadata.fields["page_id"], []).append(r)
    payloads = {str(i) if i is not None else "": (h or "").encode() for i, _, h in ODD_PAGES}
    for page, found in got.items():
        for r in found:
            assert r.payload_bytes == len(payloads[page]) and r.payload_digest == hashlib.sha1(payloads[page]).hexdigest()
            assert r.payload == (payloads[page] if r.record_type == "response" else None)
    assert [r.record_type for r in got["4"]] == ["revisit"]
    assert sorted((r.record_type, r.copies) for r in got["5"]) == [("response", 1), ("revisit", 2)]
    stored = next(r for r in got["5"] if r.record_type == "response")
    assert {r.refers_to for r in [*got["4"], *got["5"]] if r.record_type == "revisit"} == {stored.record_id}
    assert {r.record_type for page in ("6", "7", "1", "2", "3", "", "8") for r in got[page]} == {"response"}
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.assemble(warc.read_records(spark, str(tmp_path / "none"))).count() == 0


def test_foreign_archive(spark, tmp_path):
    """Captures named from either side, records that belong to nothing, repeated records."""

    def record(kind, name, block, *fields):
        lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", *fields, f"Content-Length: {len(block)}"]
        return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    proof = "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(b"\xff\x00").digest()).decode()
    answer = record("response", "<r1>", b"HTTP/1.1 200 OK\r\nA: b\r\n c\r\n\r\n\xff\x00", "Content-Type: application/http;msgtype=response", "WARC-Concurrent-To: <q1>", proof)
    parts = [
        record("warcinfo", "<i>", b"software: x\r\n"), answer, answer,
        record("request", "<q1>", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http;msgtype=request"),
        record("metadata", "<m1>", b"k: v\r\n", "WARC-Concurrent-To: <r1>"), record("metadata", "<m2>", b"k: w\r\n", "WARC-Concurrent-To: <r1>"),
        record("metadata", "<m3>", b"", "WARC-Concurrent-To: <gone>"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    rows = warc.assemble(warc.read_records(spark, str(tmp_path / "a.warc.gz"))).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.record_id, row.payload, row.copies, row.request.record_id, row.n_requests) == ("<r1>", b"\xff\x00", 2, "<q1>", 1)
    assert (row.metadata.record_id, row.metadata.fields, row.n_metadata, row.fields) == ("<m1>", {"k": "v"}, 2, {"a": "b c"})
