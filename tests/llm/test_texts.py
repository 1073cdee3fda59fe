"""Quality rules, contamination and page texts against plain versions."""

import hashlib
import re
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from propensa.llm import decontaminate, html_text, license_scan, quality_rules
from propensa.llm.fm_index import FMIndex
from tests.llm.data import EDGES, ascii_words, prose, table


def measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i:i + 5])].append(i)
    covered = {j for found in places.values() if len(found) > 1 for i in found for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


def test_quality_rules(spark):
    rows = [*EDGES, (20, "a b c d e " * 5), (21, "x # y * z\n\nx # y * z\n \t\n" + prose(1, 30)), (22, " lead and trail \n")]
    got = quality_rules.quality_rules(table(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(map(tuple, got.collect())) == Counter((i, *measures(t)) for i, t in rows)
    assert quality_rules.quality_rules(table(spark, [])).collect() == []


def test_rules_reject_and_keep(spark):
    good = "This is the text of a page that was written for people and it has words of all kinds in it."
    texts = [good, good.replace(" ", "### "), good.upper().replace(" ", "!! "), " ".join(c for c in "qxzjkvwyphgb" * 12)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(table(spark, list(enumerate(texts)))).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=150), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=3), min_size=1))
def test_fm_index_finds_all_places(text, phrases):
    index = FMIndex(np.array(text, np.int64), 5)
    for phrase in phrases:
        low, high = index.search(np.array([phrase]))
        places = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert places == [i for i in range(len(text)) if text[i:i + len(phrase)] == phrase]


def contamination(rows, items, window):
    found = []
    phrases = defaultdict(set)
    for item, text in items:
        words = ascii_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases[tuple(words[i:i + window])] |= {str(item)} if item is not None else set()
    for i, text in rows:
        words = ascii_words(text)
        hit, who = set(), set()
        for phrase, owners in phrases.items():
            for k in range(len(words) - len(phrase) + 1):
                if tuple(words[k:k + len(phrase)]) == phrase:
                    hit |= set(range(k, k + len(phrase)))
                    who |= owners
        sha = hashlib.sha256(",".join(sorted(who)).encode()).hexdigest()
        found.append((i, len(words), len(hit), len(who), sha, bool(hit) and 20 * len(hit) >= len(words)))
    return Counter(found)


def contaminated_tables():
    items = [(1, prose(31, 40)), (2, prose(32, 9)), (3, prose(31, 40)), (None, prose(33, 20)), (4, None), (5, "..."), (6, "é"),
             (10, prose(34, 14))]
    inside = prose(40, 30) + " " + prose(31, 40).upper() + "! " + prose(41, 300)
    rows = [*EDGES, (50, inside), (51, prose(32, 9).replace(" ", "\n- ")), (52, prose(33, 20) * 2), (53, prose(34, 13)),
            (54, prose(34, 12)), (55, prose(42, 500) + " é " + prose(43, 500))]
    return rows, items


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 600])
def test_contamination(spark, monkeypatch, block):
    rows, items = contaminated_tables()
    monkeypatch.setattr(decontaminate, "SHARD", 2000)
    monkeypatch.setattr(decontaminate.find_benchmark, "__defaults__", (decontaminate.WINDOW, block))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination_report(table(spark, rows), bench)
    assert Counter(map(tuple, got.collect())) == contamination(rows, items, 13)


def test_contaminated_rows_go_and_columns_stay(spark):
    rows, items = contaminated_tables()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = table(spark, rows)
    kept = decontaminate.drop_contaminated(docs, bench)
    bad = Counter(k for k, n in contamination(rows, items, 13).items() if k[-1] for _ in range(n))
    assert kept.columns == docs.columns and kept.count() == len(rows) - sum(bad.values())
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.drop_contaminated(docs, empty).count() == len(rows)
    assert decontaminate.contamination_report(table(spark, []), bench).collect() == []


def page(article, k):
    return (f"<!DOCTYPE html><html><head><title>t{k}</title><script>var a='</p>';</script></head><body><div class=x>"
            f"<b>Our site</b> since 1999</div><!-- {k} <p>no</p> --><article>{article}<div><p>Read our paper</div></article>"
            f"<div class='x'>unique {k}</div><footer>&copy; {k}</footer></body></html>")


def test_site_templates_and_article(spark):
    bodies = [f"<h1>Title {k}</h1><p>First&nbsp;&amp;  last\n{k}<br>line<p>Shared sentence.<ul><li>a{k}<li>b</ul>" for k in range(8)]
    rows = [(k, f"http://one.example/{k}", page(b, k), "codes") for k, b in enumerate(bodies)]
    rows += [(8, "http://two.example/", page(bodies[0], 8), "c"), (9, None, page(bodies[0], 9), "c"), (10, "not a url", None, "c"),
             (11, "http://one.example/x", "", "c"), (None, "http://one.example/1", page(bodies[1], 1), None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = [tuple(r) for r in html_text.main_text(pages).collect()]
    assert len(got) == len(rows) and all(r[3] == len(r[2]) for r in got)
    text = {(r[0], r[1]): r[2] for r in got}
    for k in range(8):
        assert text[k, f"http://one.example/{k}"] == f"Title {k}\nFirst & last {k} line\nShared sentence.\na{k}\nb"
    assert text[8, "http://two.example/"].endswith("b\nRead our paper")    # too few pages to be a template
    assert text[10, "not a url"] == text[11, "http://one.example/x"] == ""
    assert text[None, "http://one.example/1"] == text[1, "http://one.example/1"]
    assert html_text.main_text(pages.limit(0)).collect() == []


def texts_of(spark, sources):
    pages = spark.createDataFrame([(k, "http://one.example/", h) for k, h in enumerate(sources)], "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}


def test_templates_of_big_hosts(spark):
    """A share of the host's pages does not matter: each advert is on 5 of 200."""
    sources = [f"<main><p>What page {k} has to say.</p><div class=x>Buy {k // 5} now</div><span>Sold {k // 5} out</span></main>"
               for k in range(200)]
    sources += [f"<article><p>Long text {k}</p><a href=/>Our shop</a><p>in <i>Nature</i></p>by <b>Us</b></article>" for k in range(5)]
    # deleted where it is most of the page, too
    sources += ["<main>x<div class=x>Buy 3 now</div></main>", "<main><p>Once only.</p><div class=x>Buy me now</div></main>"]
    text = texts_of(spark, sources)
    assert {k: text[k] for k in range(200)} == {k: f"What page {k} has to say." for k in range(200)}
    assert {text[200 + k] for k in range(5)} == {f"Long text {k}\nin Nature\nby Us" for k in range(5)}
    assert text[205] == "x" and text[206] == "Once only.\nBuy me now"


@pytest.mark.parametrize("source, text", [
    ("<article><div class='body'><p>A long story.</p><section><p>And more.</p></section></div></article>", "A long story.\nAnd more."),
    ("<article><h1>T</h1><div><p>A long story.</p><ul><li>b</ul></div><table><tr><td>c</table></article>", "T\nA long story.\nb\nc"),
    ("<main><h1>T</h1><p>A long story.</p><p>And more.</p></main>", "T\nA long story.\nAnd more."),
    ("<body><div><p>A long story.</p><p>And more.</p></div>", "A long story.\nAnd more."),
])
def test_copies_are_no_templates(spark, source, text):
    """Copies that differ in nothing, or in what is around them."""
    assert set(texts_of(spark, [source] * 9).values()) == {text}
    got = texts_of(spark, [f"{source}<div>Read {k}</div>" for k in range(9)])
    assert all(t.startswith(text) for t in got.values())


@pytest.mark.parametrize("source, text", [
    ("plain &lt;text&gt; &#233;", "plain <text> é"),
    ("<body><header>Site</header><nav>Menu</nav><p>One<p>Two</p><aside>x</aside><form>y</form>", "One\nTwo"),
    ("<article>A</article><section class='comments'><article class='comment'>c</article></section>", "A"),
    ("<main><div id='cookie-notice'>We use</div><table><tr><td>1<td>2</table></main><p>out", "1\n2"),
    ("<p title='a>b'>t<p hidden>no</p><div style='display: none'>no</div><div role=navigation>n</div>", "t"),
    ("<article><header><h2>Head</h2></header><p>x</article><style>p</style><p>< 3", "Head\nx"),
    ("<div><p>open <b>bold <div>next</p></span></div></div>tail<", "open bold\nnext\ntail<"),
    ("<!-- never closed <p>x", ""),
])
def test_markup(source, text):
    assert html_text.Page(source).text(frozenset()) == text


def test_licenses(spark):
    statements = {60: ("mit", "Released under the MIT License."), 61: ("apache", "licensed under the APACHE license, version 2.0"),
                  62: ("gpl", "This work is licensed under the GNU General Public License, version 3."),
                  63: ("creative_commons", "Licensed under CC BY-NC 4.0."), 64: ("proprietary", "All rights reserved."),
                  65: ("unknown", "He renewed his driving license and asked permission to park.")}
    rows = [*EDGES, *[(i, prose(i, 40) + "\n\n" + text + "\n" + prose(i + 1, 30)) for i, (_, text) in statements.items()]]
    docs = table(spark, rows)
    model = license_scan.fit_licenses(docs)
    got = license_scan.scan(docs, model).collect()
    assert len(got) == len(rows)
    family = {r["doc_id"]: r["family"] for r in got}
    for i, (expected, _) in statements.items():
        assert family[i] == expected
    assert {f for i, f in family.items() if i not in statements} == {"unknown"}
    found = next(r for r in got if r["doc_id"] == 60)
    assert [x["paragraph"] for x in found["licenses"] if x["confirmed"]] == [2] and found["n_paragraphs"] == 3
    # scores by hand
    spans = [x for r in got for x in r["licenses"]]
    assert all(0.5 <= x["probability"] <= 1 and 0 <= x["similarity"] <= 1 for x in spans)
    assert license_scan.scan(table(spark, []), license_scan.fit_licenses(table(spark, []))).collect() == []


def wrapped(text, width=76):
    return "\n".join(textwrap.wrap(text, width))


def test_wrapped_and_inner_licenses(spark):
    """Hard-wrapped statements, and statements inside long paragraphs."""
    stated = license_scan.TEMPLATES
    rows, expected = [], {}
    for family, statements in [("mit", stated["mit"][3:6]), ("bsd", stated["bsd"][2:5]), ("gpl", [stated["gpl"][1], stated["gpl"][4]])]:
        for k, text in enumerate([wrapped(" ".join(statements)), *map(wrapped, statements),
                                  "\n".join(" * " + x for x in wrapped(statements[-1], 60).split("\n")),
                                  f"{prose(90, 200)} {statements[0]} {prose(91, 200)}"]):
            expected[len(rows)] = family
            rows.append((len(rows), f"{prose(k, 30)}\n\n{text}\n\n{prose(k + 50, 30)}"))
    rows.append((100, f"{prose(92, 30)}\n{prose(93, 300)} All rights reserved. {prose(94, 300)}"))
    rows.append((101, "Permission is hereby granted\n\nfree of charge\n\nto any person"))
    docs = table(spark, rows)
    got = {r["doc_id"]: r for r in license_scan.scan(docs, license_scan.fit_licenses(docs)).collect()}
    assert {i: got[i]["family"] for i in expected} == expected
    assert got[100]["family"] == "proprietary" and got[101]["family"] == "unknown"
    assert [x["paragraph"] for x in got[1]["licenses"] if x["confirmed"]] == [2]
    assert len([x for x in got[0]["licenses"] if x["confirmed"]]) == 3
