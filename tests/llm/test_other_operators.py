"""Pages, archives, conversations and vectors against brute force, and the pipeline."""

from __future__ import annotations

import base64
import collections
import hashlib
import io
import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import chat, html_extract, multi_index, queries, warc

# --- HTML -----------------------------------------------------------------------------------------------------------

P1, P2, P3 = "The first paragraph says something in a full sentence.", "Short one.", "A third paragraph, with an &amp; and a <b>bold</b> word, ends the&nbsp;text."
CLEAN3 = "A third paragraph, with an & and a bold word, ends the text."

PAGES = {
    "article": f"<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><a href=x>Home</a> <a>News</a></nav><article><h1>Head</h1><p>{P1}<p>{P2}<p>{P3}</article><footer>&copy; all rights reserved by us.</footer></body></html>",
    "classes": f"<body><div id='header'><h2>Site name and slogan of it.</h2></div><div class='main-content'><h1>Head</h1><div><p>{P1}</p><p>{P2}</p></div><p>{P3}</p></div><div class='sidebar'><p>Read our other fine pieces of work here today.</p></div><section id=comments><p>I liked this text very much, said a reader.</p></section><form><p>Write your name into this field please.</p><input></form><div class='cookie-notice'>We use cookies, do you accept all of them?</div></body>",
    "plain": f"<div><h1>Head</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div><ul class=menu><li><a href=/>Start page</a><li><a href=/a>All of the archives</a></ul>",
    "broken": f"<article><h1>Head</p><p><i>{P1}<br></p></b><p>{P2}</div><p>{P3}<!-- <p>no</p> --><style>p{{}}</style>",
    "advert": f"<article><h1>Head</h1><p>{P1}</p><div class=ad>Buy the best of all products now, it is cheap.</div><p>{P2}</p><p>{P3}</p></article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    assert html_extract.main_text(PAGES[name]) == "\n\n".join(["Head", P1, P2, CLEAN3])


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "</p></p>", "<!--", "<script>x", "<a <b <c>", "&#x110000;", "<table><tr><td>", "<p>" * 3000, "<div>" * 3000 + "x", "</head>", "<svg/>", "<head>", "a < b", "<p title='>'>x</p>"])
def test_odd_pages(page):
    assert isinstance(html_extract.main_text(page), str)


@pytest.mark.parametrize("deep", [0, 600, 20_000])
def test_what_is_silent_or_marked_stays_so_at_any_depth(deep):
    """Menus, buttons, drawings and options behind many open elements are no text; after they close, text is text again."""
    inner = "<nav><p>Read all of the news of today here now.</p></nav><button>Send it</button><svg><text>drawn words</text></svg><select><option>one of many</option></select>"
    page = f"<article><h1>Head</h1><p>{P1}</p>" + "<div>" * deep + inner + f"<p>{P2}</p>" + "</div>" * deep + f"<p>{P3}</p></article>"
    assert html_extract.main_text(page) == "\n\n".join(["Head", P1, P2, CLEAN3])
    wrapped = "<span>" * deep + inner + "</span>" * deep
    assert html_extract.main_text(f"<article><h1>Head</h1><p>{P1}</p>{wrapped}<p>{P2}</p><p>{P3}</p></article>") == "\n\n".join(["Head", P1, P2, CLEAN3])


def test_of_several_articles_the_one_with_most_text_counts():
    short = "".join(f"<p>This is short line {k} of it.</p>" for k in range(4))
    long = f"<p>{' '.join(LINE for _ in range(8))}</p><p>{' '.join(LINE for _ in range(5))}</p>"
    for first, second in ((short, long), (long, short)):
        got = html_extract.main_text(f"<main><article>{first}</article><article>{second}</article></main>")
        assert got.count(LINE) == 13


def quick(page):
    began = time.perf_counter()
    html_extract.main_text(page)
    return time.perf_counter() - began


@pytest.mark.parametrize("part", ["<a ='", "<a =\"x' ='", "<span>text</b>", "<table><b>", "<article>", "<p><b>", "</div>x", "<li><ul><span>", "<td><table>", "<a href='x\">"])
def test_broken_pages_take_time_in_proportion(part):
    small, large = (min(quick("<b><span>" * 50 + part * n) for _ in range(2)) for n in (4_000, 32_000))
    assert large < 24 * small + 0.5


LINE = "The quick brown fox jumps over the lazy dog near the river bank today, said the old man."
ARTICLE = "".join(f"<p>{LINE} Number {k}.</p>" for k in range(8))
PLAIN = "\n\n".join(f"{LINE} Number {k}." for k in range(8))


@pytest.mark.parametrize(
    "page",
    [
        f"<head><title>t</title>{ARTICLE}",
        f"<body><div id=main class='no-comments'>{ARTICLE}</div></body>",
        f"<body><div class='layout sidebar-left'>{ARTICLE}</div></body>",
        f"<body><div class='page-header content'>{ARTICLE}</div></body>",
        f"<body><form id=aspnetForm><nav><a href=x>Home</a></nav>{ARTICLE}<footer>Copyright of us all.</footer></form></body>",
        f"<article>{ARTICLE}<section id=comments><p>{LINE}</p><p>{LINE}</p><p>I like it</p></section></article>",
        f"<div class=post>{ARTICLE}</div><div id=comments><p>{LINE}</p><p>{LINE}</p></div>",
        f"<div class='has-sidebar social-share-on'>{ARTICLE}</div><aside><p>{LINE}</p></aside>",
    ],
)
def test_wrappers_and_regions(page):
    assert html_extract.main_text(page) == PLAIN


def test_parts_of_articles_stay():
    page = f"<main>{ARTICLE}<section id=related-work><h2>Related work</h2><p>{LINE}</p><p>{LINE}</p></section></main>"
    assert html_extract.main_text(page) == "\n\n".join([PLAIN, "Related work", LINE, LINE])
    page = f"<article><p>{LINE}</p><svg viewBox='0 0 1 1'/><p>{LINE}</p><svg><path d=x /><circle/></svg><p>{LINE}</p></article>"
    assert html_extract.main_text(page) == "\n\n".join([LINE] * 3)
    page = "<nav><a href=x>Home</a></nav><div class=ad>Buy the best thing ever made now.</div><article><h1>Taja.</h1><p>Taja.</p></article><footer>Some long text of the footer is here for all of you.</footer>"
    assert html_extract.main_text(page) == "Taja.\n\nTaja."


def test_smoothness_alone_saves_a_block():
    """A short line without a tag that speaks for it costs more as content, and stays between two paragraphs only."""
    weights = html_extract.Weights()
    page = html_extract.read_page(f"<body><p>{LINE}</p><div>so it is</div><p>{LINE}</p></body>")
    assert html_extract.text_evidence(page.blocks[1], weights) < 0
    assert html_extract.main_text(f"<body><p>{LINE}</p><div>so it is</div><p>{LINE}</p></body>") == f"{LINE}\n\nso it is\n\n{LINE}"
    assert html_extract.main_text("<body><div>so it is</div></body>") == ""


@pytest.mark.parametrize("part", ["<a ", "<div>x", "<a x='>", "<b><div>x</div>", '<a x="', "<p><b>x ", "<li><ul><b>x", "<!", "</ ", "<", "<p>x</p>"])
def test_long_broken_pages_take_linear_time(part):
    start = time.process_time()
    html_extract.main_text(part * (300_000 // len(part)))
    assert time.process_time() - start < 10


def test_pages_against_their_template(spark, sf):
    """The given pages all hold one article; the query returns its headings and paragraphs, and the cut decides blocks."""
    want, changed, weights = {}, 0, html_extract.Weights()
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = r["html"][r["html"].index("<article>") : r["html"].index("</article>")]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", inner)]
        want[r["page_id"]] = "\n\n".join(x for x in parts if x)
        page = html_extract.read_page(r["html"])
        gain, edges = html_extract.build_graph(page, weights)
        changed += sum((g > 0) != keep for g, keep in zip(gain[: len(page.blocks)], html_extract.min_cut(gain, edges)))
    assert {r["page_id"]: r["text"] for r in queries.op1_html_extraction(spark, sf).collect()} == want
    assert changed > len(want)


def test_min_cut_is_least():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randrange(1, 8)
        gain = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(label, gain=gain, edges=edges):
            return sum(max(g, 0) if not x else max(-g, 0) for g, x in zip(gain, label)) + sum(c for a, b, c in edges if label[a] != label[b])

        assert cost(html_extract.min_cut(gain, edges)) == pytest.approx(min(cost(x) for x in itertools.product([False, True], repeat=n)))


def test_extract_frame(spark, sf):
    pages = spark.createDataFrame([(1, None, None, 5), (None, "u", PAGES["article"], 6), (2, "u", "", None), (2, "u", "", None)], "page_id long, url string, html string, text int")
    rows = html_extract.extract(pages).collect()
    assert [(r["page_id"], r["n_chars"]) for r in rows][:1] == [(1, 0)] and len(rows) == 4
    assert html_extract.extract(pages.limit(0)).count() == 0
    for r in queries.op1_html_extraction(spark, sf).collect():
        assert r["n_chars"] == len(r["text"]) > 0


# --- WARC -----------------------------------------------------------------------------------------------------------


def warc_pages(spark):
    rng = random.Random(2)
    html = ["<p>" + " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40)) + "</p>" for _ in range(30)]
    rows = [(k, f"http://x/{k}\r\n y", html[k % 30], "z") for k in range(70)] + [(100, None, None, None), (101, "u", "", None), (102, "u", "a\r\n\r\nb\x00é", None), (102, "u", "a\r\n\r\nb\x00é", None), (None, "u", html[0], None), (None, "u", "lone", None), (103, "u", "x" * 2_000_000, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string")


@pytest.mark.parametrize("least", [0, 100])
def test_warc_round_trip(spark, least, monkeypatch):
    pages = warc_pages(spark)
    folder = warc.archive_folder(pages)
    got = warc.read_archives(warc.write_archives(pages, folder, min_revisit_bytes=least), folder).collect()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    largest = {}
    for i, data in rows:
        if i is not None and len(data) >= least:
            largest[data] = max(largest.get(data, i), i)
    want = collections.Counter()
    for i, data in rows:
        top = largest.get(data)
        revisit = top is not None and top != i
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None, None if revisit else data] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    empty = pages.limit(0)
    assert warc.read_archives(warc.write_archives(empty, folder), folder).count() == 0


def test_archive_layout():
    samples = [f"<html><p>record {k} of many, with the same words in all of them {k * k}</p>".encode() * 3 for k in range(400)]
    for dictionary in (warc.build_dictionary(samples), warc.build_dictionary([b"x"]), warc.build_dictionary([])):
        assert dictionary
        out = io.BytesIO()
        writer = warc.ArchiveWriter(out, dictionary)
        for s in samples:
            writer.add(s)
        assert writer.size == len(out.getvalue()) and out.getvalue()[:4] == b"\x5d\x2a\x4d\x18"
        out.seek(0)
        assert list(warc.read_records(out)) == samples
    assert warc.build_dictionary(samples)[:4] == b"\x37\xa4\x30\xec"  # a trained one
    out = io.BytesIO()
    warc.ArchiveWriter(out, dictionary).add(samples[0])
    with pytest.raises(Exception):
        list(warc.read_records(io.BytesIO(out.getvalue()[:-5])))


def test_copies_of_one_page_leave_room_in_the_dictionary(spark, monkeypatch, tmp_path):
    """The sample is of distinct pages: a page with most rows is one of them, and the others are picked all the same."""
    seen = []
    monkeypatch.setattr(warc, "SAMPLE_ROWS", 50)
    monkeypatch.setattr(warc, "build_dictionary", lambda samples, real=warc.build_dictionary: seen.append(samples) or real(samples))
    rows = [(k, "u", "<p>copy</p>") for k in range(5000)] + [(9000 + k, f"u{k}", f"<p>page {k}</p>" * 9) for k in range(100)] + [(None, None, None)] * 30
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path))
    assert 25 <= len(seen[0]) <= 80 and sum(b"page " in s for s in seen[0]) >= 20


def test_dictionary_holds_records_and_ids_are_unique(spark):
    pages = warc_pages(spark)
    archives = warc.write_archives(pages, warc.archive_folder(pages)).collect()
    ids, headers = [], 0
    for r in archives:
        with open(r["path"].removeprefix("file:"), "rb") as stream:
            data = stream.read()
        size = int.from_bytes(data[4:8], "little")
        headers += b"WARC-Payload-Digest" in zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
        ids += [warc.parse_record(x)[0]["WARC-Record-ID"] for x in warc.read_records(io.BytesIO(data))]
    assert headers == len(archives) > 0
    assert len(ids) == pages.count() == len(set(ids))


# --- chat -----------------------------------------------------------------------------------------------------------


def test_escapes_are_reversible():
    template = chat.Template()
    escaper = chat.Escaper(template.controls)
    rng = random.Random(3)
    parts = [*template.controls, *(c[:k] for c in template.controls for k in range(1, len(c))), "\\", "\\.", ".", "a", "<", "[", "]"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        safe = escaper.escape(text)
        assert escaper.unescape(safe) == text
        assert not any(c in safe for c in template.controls)
        assert not any(safe.endswith(c[:k]) for c in template.controls for k in range(1, len(c)))


def test_templates_that_do_not_read_back_are_refused():
    for marks in ({"user": ("ab", "cd"), "assistant": ("xa", "cd")}, {"user": ("[I", "cd"), "assistant": ("[INST]", "cd")}, {"user": ("aba", "cd")}, {"user": ("ab", "cd"), "assistant": ("ab", "ef")}):
        with pytest.raises(ValueError):
            chat.Formatter(chat.Template(marks=marks))
    chat.Formatter(chat.Template(marks={"user": ("<|user|>", "<|stop|>"), "assistant": ("<|bot|>", "<|stop|>")}))


def test_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    convs = {
        1: [(0, "system", "be kind"), (1, "user", said), (2, "assistant", said), (3, "user", "x<"), (4, "assistant", "\\")],
        2: [(0, "user", None), (1, "user", "again")],
        3: [(5, "assistant", "a"), (None, "tool<|end|>", "b"), (5, "assistant", "a"), (7, None, None)],
        None: [(0, "user", "q"), (1, "assistant", "r" * 100_000)],
    }
    rows = [(c, t, r, x, 1, True) for c, turns in convs.items() for t, r, x in turns]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, segment int, loss boolean")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns = sorted(((-1 if t is None else t, r or "", x or "") for t, r, x in turns))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert {c: r["valid"] for c, r in got.items()} == {1: True, 2: False, 3: False, None: True}
    segments = chat.format_conversations(frame)
    assert segments.where("loss").count() == 5
    chars = {r["conv_id"]: r["n"] for r in segments.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert chars == {c: r["formatted_chars"] for c, r in got.items()}
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


# --- vectors --------------------------------------------------------------------------------------------------------


def near_vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(120, 16))
    near = np.concatenate([base[k] + rng.normal(size=(6, 16)) * s for k, s in ((0, 0.05), (1, 0.1), (2, 0.2), (3, 0.02))])
    return np.concatenate([base, near, base[:5], base[:3] * 7])


@pytest.mark.parametrize("tile", [4096, 10])
def test_vectors_against_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(multi_index, "TILE_ROWS", tile)
    vectors = near_vectors()
    labels = [k % 2 if k >= 120 and k < 144 else 0 for k in range(len(vectors))]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows = [(k, [float(x) for x in v], labels[k], 9) for k, v in enumerate(vectors)] + [(1000 + k, v, 0, 9) for k, v in enumerate(odd)] + [(2000, [1.0] * 16, None, 9), (2001, [1.0] * 16, None, 9), (None, [float(x) for x in vectors[9]], 0, 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kept int")
    got = {r["vec_id"]: r for r in multi_index.near_duplicates(frame, recall=1.0).collect()}
    assert len(got) == len(rows)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    links = [(i, j) for i, j in itertools.combinations(range(len(vectors)), 2) if labels[i] == labels[j] and unit[i] @ unit[j] >= 0.98]
    degree = collections.Counter(x for l in links for x in l)
    degree[9] += 1  # the row without an id
    part = components(range(len(vectors)), links)
    for k in range(len(vectors)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (degree[k], part[k], part[k] == k)
    for k in (*range(1000, 1006), 2000, 2001):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert got[1006]["n_links"] == got[1007]["n_links"] == 1 and got[1007]["component_id"] == 1006
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (1, 9, False)
    assert multi_index.near_duplicates(frame.limit(0)).count() == 0


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def test_vector_runs_agree(spark):
    """Dealt in another way, the same table gives the same rows, as names of vectors and samples depend on content only."""
    vectors = near_vectors()
    frame = spark.createDataFrame([(k, [float(x) for x in v], k % 2) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    one = sorted(map(tuple, multi_index.near_duplicates(frame).collect()))
    assert one == sorted(map(tuple, multi_index.near_duplicates(frame.orderBy(F.rand(3)).repartition(7)).collect()))
    assert sum(r[1] for r in one) > 0


def test_multi_sequence_order():
    a, b = np.sort(np.random.default_rng(6).random(12)), np.sort(np.random.default_rng(7).random(9))
    got = list(multi_index.multi_sequence(a, b, 0.9))
    want = sorted((a[i] + b[j], i, j) for i in range(12) for j in range(9) if a[i] + b[j] <= 0.9)
    assert [a[i] + b[j] for i, j in got] == [s for s, *_ in want] and len(set(got)) == len(got)


def test_recall_of_cut_visits(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 32))
    vectors = np.concatenate([base, *(base[:150] + rng.normal(size=(150, 32)) * s for s in (0.03, 0.08, 0.12))])
    frame = spark.createDataFrame([(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(multi_index, "CELL_ROWS", 8)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    full = int(near.sum()) - len(vectors)
    for recall in (0.95, 0.999):
        found = multi_index.near_duplicates(frame, recall=recall).agg(F.sum("n_links")).first()[0]
        assert 0.9 * full <= found <= full and full > 300


def turned(unit, cosines, rng):
    """Each row turned in a random direction, to the given cosine with itself."""
    way = rng.normal(size=unit.shape)
    way -= (way * unit).sum(1)[:, None] * unit
    way /= np.linalg.norm(way, axis=1)[:, None]
    return cosines[:, None] * unit + np.sqrt(1 - cosines**2)[:, None] * way


@pytest.mark.parametrize("clustered", [False, True])
def test_visits_meet_planted_pairs_with_little_work(clustered):
    """20,000 vectors of one label with 200 pairs at 0.98 to 0.99: under a tenth of all pairs is computed; ten times the rows, under a fiftieth."""
    rng = np.random.default_rng(12)
    for n, share in ((20_000, 0.1), (200_000, 0.02)):
        x = rng.normal(size=(n // 50, 64)).repeat(50, 0) + 0.6 * rng.normal(size=(n, 64)) if clustered else rng.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1)[:, None]
        x[-200:] = turned(x[:200], rng.uniform(0.98, 0.99, 200), rng)
        samples = {64: x[rng.permutation(n)[:8000]]}
        index = multi_index.Index(samples, {64: n}, 0.98)
        index.reach(samples, 0.999)
        k = len(index.codes[64][0])
        margins = index.margins(x)
        cell = margins[0] * k + margins[1]
        sizes = np.bincount(cell, minlength=k * k)
        visits = list(index.visits(x[:2000]))
        assert np.mean([sizes[[own, *(c for c in seen if c > own)]].sum() for own, seen in visits]) * n < share * n * n / 2
        met = sum(int(cell[n - 200 + r]) in seen for r, (_, seen) in enumerate(visits[:200]))
        back = list(index.visits(x[-200:]))
        both = [int(cell[n - 200 + r]) in visits[r][1] if visits[r][0] <= back[r][0] else visits[r][0] in back[r][1] for r in range(200)]
        assert met > 180 and np.mean(both) >= 0.95
        assert index.recall >= 0.999 and index.recall_at_least >= 0.99 and index.limit < 0.2 * (2 - 2 * 0.98)


def test_copies_of_one_vector_meet_their_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "HOT_COPIES", 20)
    rng = np.random.default_rng(13)
    rows = [(k, [1.0, 2.0, 3.0], 1) for k in range(60)] + [(100 + k, rng.normal(size=3).tolist(), 1) for k in range(40)] + [(200 + k, None, 1) for k in range(30)] + [(None, [1.0, 2.0, 3.0], 1), (300, [2.0, 4.0, 6.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = multi_index.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    one = {r["vec_id"]: r for r in got}
    assert all((one[k]["n_links"], one[k]["component_id"]) == (61 + sum(one[100 + j]["component_id"] == 0 for j in range(40)), 0) for k in (*range(60), None))
    assert all((one[k]["n_links"], one[k]["component_id"], one[k]["kept"]) == (0, k, True) for k in range(200, 230))


@pytest.mark.parametrize("hot", [0, 500])
def test_links_of_small_groups_in_skewed_tables(spark, monkeypatch, hot):
    """A tight group with a third of the rows, or no other links at all, hides none of a few looser pairs."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(1000, 6))
    near = rng.normal(size=(30, 6))
    near -= base[:30] * ((near * base[:30]).sum(1) / (base[:30] ** 2).sum(1))[:, None]
    loose = base[:30] + near * (0.195 * np.linalg.norm(base[:30], axis=1) / np.linalg.norm(near, axis=1))[:, None]
    tight = base[999] + rng.normal(size=(hot, 6)) * 0.002
    vectors = np.concatenate([base, loose, tight])
    frame = spark.createDataFrame([(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(multi_index, "CELL_ROWS", 8)
    monkeypatch.setattr(multi_index, "SAMPLE_ROWS", 40)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    degree = (unit @ unit.T >= 0.98).sum(1) - 1
    assert (degree[1000:1030] >= 1).all()
    got = {r["vec_id"]: r for r in multi_index.near_duplicates(frame).collect()}
    assert [got[k]["n_links"] for k in range(len(vectors))] == degree.tolist()
    assert all(got[1000 + k]["component_id"] == k for k in range(30))


# --- pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf, monkeypatch):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clash = docs.select("*", F.lit(1).alias("component_id"), F.lit(2).alias("score"), F.lit("x").alias("kept_text"), F.lit(3).alias("ids"))
    odd = spark.createDataFrame([(None, None, None, None, None), (7001, None, None, None, None), (7002, "", "en", "src0", 0), (7002, "", "en", "src0", 0)], docs.schema)
    for start in (docs, clash, docs.unionByName(odd), docs.limit(0)):
        rows = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, sf)
            assert rows.columns == start.columns, name
            rows = spark.createDataFrame(rows.collect(), start.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, rows, sf).count() == rows.count()


def test_pipeline_run(spark, sf):
    import corpus_pipeline

    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
