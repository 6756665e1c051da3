"""Phrase collocations, spelling variants and page text on small tables."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from inkgauge.llm import collocations as col
from inkgauge.llm import html_extract as page
from inkgauge.llm import spelling
from inkgauge.llm.queries import op13_html_extraction

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# -- collocations ------------------------------------------------------------------


def plain_pieces(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\x0a-\x0d]", text):
        yield [w for w in re.split("[\x20\x09]+", piece) if w]


def plain_collocations(rows, least, scale, covered, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in plain_pieces(text):
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            cuts = [(scale * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= covered * a for b in inside):
                scored.append((-score, -a, " ".join(p).encode(), " ".join(p), found[p[:k]], found[p[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase, -a, left, right, totals[lang], -score))
    return sorted(out)


def talk(rng, n):
    marks = ["", "", "", "", ",", ".", " ", "\t", "\n", ";", "\x0b"]
    return " ".join(rng.choice("Aa b c d é É of The x y".split(" ")) + rng.choice(marks) for _ in range(n))


def test_collocations_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(talk(rng, rng.randrange(0, 120)), rng.choice(["en", "de", None, "und"])) for _ in range(120)]
    rows += [(None, "en"), ("", "fr"), ("...", "fr"), ("of the " * 200, "en"), ("of the " * 200, "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS).repartition(5)
    for least, top in ((8, 2000), (30, 7)):
        found = col.collocations(docs, least, 2_000_000, 80, top)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == plain_collocations(rows, least, 2_000_000, 80, top)


def test_collocations_with_many_spills_and_one_long_text(monkeypatch):
    rng = random.Random(6)
    rows = [(talk(rng, 2500), "en"), (talk(rng, 900), "de"), ("word" * 3000 + " of the", "de")]
    for name, value in (("FAN", 256), ("ENTRIES", 40), ("WORDS", 6), ("CHUNK", 300), ("MERGED", 50)):
        monkeypatch.setattr(col, name, value)
    for lengths in ((1,), (2,), (3, 4)):
        counters = {}
        none = np.empty(0, np.int64)
        runs = []
        for text, lang in rows:  # the same steps as a task's
            if lang not in counters:
                counters[lang] = col.PhraseCounter(lang, lengths, np.full(col.FILTER_BITS // 64, ~np.uint64(0)), 3)
            counter = counters[lang]
            counter.trie.burst = 3
            before = none
            for part in col.chunks(text.encode().translate(col._FOLD)):
                before = counter.count(part, before)
                runs += col.relieve(counters, forget=False)
            runs += col.relieve(counters, forget=True)
            assert counter.trie.size <= col.ENTRIES and len(counter.ids) <= col.WORDS + 1
        for counter in counters.values():
            runs += counter.runs(0)
        runs = sorted(tuple(r.values()) for batch in runs for r in batch.to_pylist())
        assert {r[0] for r in runs} == {0, 1, 2}
        for *_, run in runs:
            phrases = [p.split(" ") for p in col.unpacked(run)["phrase"].to_pylist()]
            assert phrases == sorted(phrases, key=lambda p: [w.encode() for w in p]) and len(set(map(tuple, phrases))) == len(phrases)
        found, total = {}, Counter()
        for batch in col.merged(iter(runs), 2):
            for row in batch.to_pylist():
                if row["words"] == 0:
                    total[row["lang"]] += row["f"]
                else:
                    assert (row["lang"], row["phrase"]) not in found  # one partition has it
                    found[row["lang"], row["phrase"]] = row["f"]
        expected, n = Counter(), Counter()
        for text, lang in rows:
            for words in plain_pieces(text):
                n[lang] += len(words)
                for k in lengths:
                    expected.update((lang, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
        assert found == {k: f for k, f in expected.items() if f >= 2}
        assert lengths != (1,) or total == n


def test_trie_counts_bursts_and_spills_whole_subtrees():
    rng = random.Random(7)
    trie, expected = col.HatTrie(burst=4), Counter()
    for _ in range(300):
        keys = [b"".join(rng.randrange(1, 9).to_bytes(4) for _ in range(rng.randrange(1, 5))) for _ in range(10)]
        trie.add(keys, [2] * 10)
        for key in keys:
            expected[key] += 2
    assert trie.size == len(expected) and isinstance(trie.root[1], col.Node)
    first = list(trie.spill(trie.size // 2))
    gone = {k[:4] for keys, _ in first for k in keys}
    assert trie.size <= len(expected) // 2 and len(gone) == len(first)
    rest = list(trie.spill(0))
    assert trie.size == 0
    out = Counter()
    for keys, counts in (*first, *rest):
        for key, n in zip(keys, counts, strict=True):
            out[key] += n
    assert out == expected
    assert not any(k[:4] in gone for keys, _ in rest for k in keys)


def test_collocations_of_nothing(spark):
    assert col.collocations(spark.createDataFrame([], DOCS)).collect() == []


# -- spelling ------------------------------------------------------------------------


def plain_words(rows, deletions, least_length, least_n):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % deletions == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_n}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, deletions=199, least_length=6, least_n=5, factor=5):
    words = plain_words(rows, deletions, least_length, least_n)
    forms, out = {}, []
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= factor * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def prose(rng, base, n):
    out = []
    for _ in range(n):
        word = rng.choice(base)
        if rng.random() < 0.35:
            i = rng.randrange(len(word))
            word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("aeé÷") + word[i:], word[:i] + "o" + word[i + 1 :]])
        out.append(word.upper() if rng.random() < 0.1 else word)
    return rng.choice([" ", "-", "1"]).join(out)


@pytest.mark.parametrize("crowded", [20_000, 3])
def test_variants_equal_brute_force(spark, crowded):
    rng = random.Random(8)
    base = ["erthat", "thater", "erthaé", "reading", "readings", "Étudier", "aaaaaaa", "aaaaaaaa", "planet", "planets", "plante"]
    rows = [(i, prose(rng, base, 150)) for i in range(60)] + [(None, "planet " * 900), (3, None), (3, ""), (4, "x"), (5, "aaaaaab " * 9)]
    rows += [(7, "chaina " * 5), (8, "chainab " * 30), (9, "chainabc " * 160), (9, "chainabcd " * 900), (10, "y" * 70_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(4)
    found = spelling.spelling_variants(docs, deletions=19, crowded=crowded)
    expected = plain_variants(rows, deletions=19)
    assert sorted(map(tuple, found.collect())) == expected
    assert any(root not in (word, form) and form for word, form, root, *_ in expected)  # chains


def test_near_words_share_a_signature():
    rng = random.Random(9)
    for _ in range(3000):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 14)))
        i = rng.randrange(len(word))
        for other in (word[:i] + word[i + 1 :], word[:i] + "x" + word[i + 1 :], word[:i] + word[0] + word[i:]):
            a, b = (spelling.signatures(spelling.projections(w)) for w in (word, other))
            assert any(x == y for x, y in zip(a, b, strict=True))


def test_variants_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []


# -- page text -----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<div id="header"><h1>Site</h1></div><nav><ul><li><a href=x>Home</a></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<div class="content"><h2>Title &amp;amp; more</h2><p>First  para&nbsp;with <b>bo</b>ld a < b &eacute;&#233;<br>x<p>Second <a title="a>b">link</a> here.
<div class="ad-box"><p>Buy now!</p><div>more</div></div><script>var a="<a href='x"; if(a<b){}</script><!-- <p>no</p> --><p>Third and a few words more.
<ul><li>one<li>two</ul><form><p>Mail<input></form><aside>other</aside><p>Last \U0001f600 one, which is as long as it must be.</div>
<h3>3 Comments</h3><div><p>I am a reader and write a lot of words here, more than the article has in all its lines</p></div>
<div class="page-footer">foot</div></body>"""
TEXT = (
    "Title &amp; more\n\nFirst para with bold a < b éé x\n\nSecond link here.\n\nThird and a few words more.\n\none\n\ntwo\n\nLast \U0001f600 one, which is as long as it must be."
)


def test_page_text():
    assert page.main_text(PAGE, {}) == TEXT
    for cut in range(len(PAGE)):  # a page may end anywhere
        page.main_text(PAGE[:cut], {})
    marked = PAGE.replace('<div class="content">', "<main>").replace("</div>\n<h3>", "</main>\n<h3>")
    weights = {}
    for (kind, inside), _ in page.kind_counts(marked).items():
        weights[kind] = page.learned_weight(kind, *(page.kind_counts(marked)[kind, s] for s in (True, False)))
    assert "tag:main" not in weights and weights["word:p"] > 2 > 0 > weights["aside:nav"]
    assert page.main_text(marked, weights) == TEXT


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""),
        ("", ""),
        ("<nav><p>a b c</p></nav>", ""),
        ("plain   text", "plain text"),
        ("<p>a</p><p>&lt;b&gt;</p>", "a\n\n<b>"),
        ("<form><main><h1>x</h1><p>y z</p></main></form>", "x\n\ny z"),
        ('<div id="comments"><article><p>me too</p></article></div>', ""),
        ('<article><h1>x</h1><p>a b</p></article><article class="comment"><p>first of all</p></article>', "x\n\na b"),
        ("<script>if (a < b) document.write('<p>x</p>')", ""),
        ("<p>a<!-- no end <p>b", "a"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ],
)
def test_small_pages(source, text):
    assert page.main_text(source, {}) == text


def test_region_is_the_best_of_all_ranges():
    rng = random.Random(10)
    for _ in range(300):
        weights = {"word:p": 1.0, "word:div": 0.5, "tag:p": -1.0, "aside:nav": -3.0}
        tokens = [(rng.choice(list(weights)), rng.randrange(1, 4), 0, "") for _ in range(rng.randrange(0, 25))]
        sums = {(a, b): sum(weights[k] * n for k, n, _, _ in tokens[a:b]) for a in range(len(tokens)) for b in range(a + 1, len(tokens) + 1)}
        top = max(sums.values(), default=0)
        span = page.region(tokens, dict(weights))
        if top <= 0:
            assert span == (0, 0)
        else:
            ends = min(b for (a, b), s in sums.items() if s == top)
            assert sums[span] == top and span[1] == ends


def test_extraction_of_tables(spark):
    rows = [(i, "u", PAGE.replace('<div class="content">', "<main>").replace("</div>\n<h3>", "</main>\n<h3>"), "mine") for i in range(30)]
    rows += [(None, None, None, None), (1, "u", "<p>" + "word " * 400_000, "x"), (2, "v", "", "n")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(3)
    found = page.extract_text(pages, page.learn_weights(pages, sample=8))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((len(r["text"]), r["n_chars"], r["text"][:20]) for r in found.collect())
    assert got == sorted([(len(TEXT), len(TEXT), TEXT[:20])] * 30 + [(0, 0, "")] * 2 + [(1_999_999, 1_999_999, "word word word word ")])
    empty = spark.createDataFrame([], pages.schema)
    assert page.learn_weights(empty) == {} and page.extract_text(empty, {}).collect() == []


def test_extraction_leaves_the_marked_article_alone(spark):
    sf = "/root/testdata/sf0.01"
    found = {r["page_id"]: r for r in op13_html_extraction(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(found) == len(pages)
    for p in pages:
        body = re.search("<article>(.*?)</article>", p["html"], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", body)
        blocks = [" ".join(page.html.unescape(re.sub("<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks]
        assert found[p["page_id"]]["text"] == "\n\n".join(b for b in blocks if b)
        assert found[p["page_id"]]["n_chars"] == len(found[p["page_id"]]["text"])
