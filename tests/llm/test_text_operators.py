"""Quality, language, fingerprints and the n-gram join on small tables."""

import base64
import bisect
import functools
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from inkgauge.llm import language_id, quality
from inkgauge.llm.ngram_join import band_limits, ngram_jaccard_join, signatures
from inkgauge.llm.shingles import BLOCK, shingle_set, word_hashes
from inkgauge.llm.syncmers import BITS, CUTS, GRID, INNER, SPACES, K, S, anchors, fingerprint_edits, likeness, numbered
from inkgauge.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# -- shingles and the join ---------------------------------------------------------


def plain_set(text, width):
    found = (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ")
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in found).split(" ")
    found = [w for w in found if w]
    if not found:
        return frozenset()
    width = min(width, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def plain_components(rows, width, percent):
    """Brute force over all pairs."""
    sets = [plain_set(t, width) for _, t in rows]
    reach = {i: i for i in range(len(rows))}

    def top(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                reach[top(i)] = top(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted((d, len(s), least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def edited(rng, text, n):
    found = text.split(" ")
    for _ in range(n):
        found[rng.randrange(len(found))] = f"x{rng.randrange(10**6)}"
    return " ".join(found)


def test_words_are_split_and_folded_as_said():
    a = word_hashes("One\ttwo\x0b\x0cTHREE\r\n one é É")
    assert len(a) == 6 and a[0] == a[3] and a[4] != a[5]
    assert len(word_hashes(None)) == len(word_hashes(" \n")) == 0
    assert len(shingle_set("a b c", 4)) == 1


def test_long_texts_are_cut_between_words():
    text = " ".join(f"word{i}" for i in range(BLOCK // 5))
    assert len(text) > BLOCK
    some = word_hashes(text)
    assert len(some) == BLOCK // 5
    assert some[-1] == word_hashes(f"word{BLOCK // 5 - 1}")[0]


@pytest.mark.parametrize("percent", [80, 85])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(3)
    for size in (7, 9, 14, 40, 150, 700, 3000):
        for _ in range(25):
            base = np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
            gone = int(rng.integers(0, size // 8 + 1))
            other = np.unique(np.concatenate([base[gone:], rng.integers(1, 1 << 63, gone // 3, dtype=np.uint64)]))
            common = len(np.intersect1d(base, other))
            similar = 100 * common >= percent * (len(base) + len(other) - common)
            if similar and common < max(len(base), len(other)):
                assert set(signatures(base, percent)) & set(signatures(other, percent))


@pytest.mark.parametrize("percent", [80, 85])
def test_partners_across_a_band_edge_share_a_signature(percent):
    rng = np.random.default_rng(5)
    lost, tried = [], 0
    for edge in (x for x in band_limits(percent, 5000) if 4 <= x <= 5000):
        large = edge + 1
        sizes = {(edge, large), (-(-large * percent // 100), large), (edge, edge * 100 // percent)}
        for a, b in sorted(x for x in sizes if x[0] <= edge < x[1] <= x[0] * 100 // percent):
            common = -(-percent * (a + b) // (100 + percent))  # just similar enough
            if common > a:
                continue
            for _ in range(5):
                pool = rng.permutation(np.unique(rng.integers(1, 1 << 63, a + b, dtype=np.uint64)))
                one, two = np.sort(pool[:a]), np.sort(pool[a - common :][:b])
                assert (len(one), len(two), len(np.intersect1d(one, two))) == (a, b, common)
                tried += 1
                if not set(signatures(one, percent)) & set(signatures(two, percent)):
                    lost.append((a, b))
    assert tried > 300 and lost == []


def test_bands_hold_all_partners():
    limits = band_limits(85, 5000)
    for size in range(1, 4000):
        own = np.searchsorted(limits, size)
        assert size * 100 // 85 <= limits[own + 1]


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_join_equals_brute_force(spark, width, percent):
    rng = random.Random(7)
    texts = [None, "", " \n", "one", "One", "a b c", "a b c d", "a b c", "longer " * 300]
    for size in (6, 12, 30, 90, 400):
        for _ in range(4):
            base = words(rng, size)
            texts += [base] + [edited(rng, base, rng.randrange(size // 8 + 2)) for _ in range(5)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[20]), (None, "no id at all"), (3, "one"), (3, "one")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], DOCS).repartition(3)
    df = df.withColumnsRenamed({"lang": "cls", "source": "component_id"})
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard_join(df, width=width, percent=percent).collect()]
    key = lambda r: [(x is None, x or 0) for x in r]
    assert sorted(got, key=key) == sorted(
        [(d, n, c) for d, n, c in [*plain_components([r for r in rows if r[0] is not None], width, percent)]]
        + [(None, *[r for r in plain_components(rows_with(rows, texts[20]), width, percent)][0][1:])]
        + [(None, 1, None)],
        key=key,
    )


def rows_with(rows, text):
    return [r for r in rows if r[1] == text and r[0] is not None]


def test_join_of_one_crowded_cell(spark):
    """More near copies than a block holds, of which many are no partners."""
    rng = random.Random(11)
    base = words(rng, 120, 5000)
    rows = [(i, edited(rng, base, 1 + i % 12)) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard_join(df).collect())
    assert got == plain_components(rows, 4, 85)


def test_join_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_jaccard_join(df).collect() == []


# -- language ----------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    from inkgauge.llm.queries import op3_language_id

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = op3_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got} == {True} and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)


def test_language_of_odd_texts(spark):
    learn = [(i, "the cat and the dog sat on a mat with " * 5, "en") for i in range(5)]
    learn += [(9 + i, "der hund und die katze auf dem dach mit " * 5, "de") for i in range(5)]
    learn += [(90, None, "de"), (91, "", "fr"), (92, "unlabelled text", None), (None, "the cat", "en")]
    df = spark.createDataFrame(learn, "doc_id bigint, text string, lang string")
    dictionaries = language_id.learn_dictionaries(df, "text", "lang", "doc_id")
    assert set(dictionaries) == {"en", "de"}
    rows = [(1, None), (2, ""), (3, "12 !? 34"), (4, "the dog and the cat"), (4, "the dog and the cat"), (None, "und die katze")]
    rows += [(7, "the cat and the dog " * 20000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, score string")
    got = {(r.doc_id, r.lang_pred, r.rejected) for r in language_id.identify_language(df, dictionaries).collect()}
    assert got == {
        (1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False), (None, "de", False), (7, "en", False),
    }
    kept = language_id.keep_identified(df, dictionaries)
    assert kept.columns == df.columns and kept.count() == 4
    assert language_id.identify_language(df, {}).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify_language(df.limit(0), dictionaries).count() == 0


# -- quality -----------------------------------------------------------------------


def test_sum_of_squares_is_the_pairwise_sum():
    machine = quality.FactorisationMachine(6)
    machine.bias, machine.linear = 0.3, np.arange(6) / 10
    index, value = np.array([0, 2, 5]), np.array([0.5, 1.0, 2.0])
    z = 0.3 + float(machine.linear[index] @ value)
    for i in range(3):
        for j in range(i):
            z += float(machine.factors[index[i]] @ machine.factors[index[j]]) * value[i] * value[j]
    assert machine.score(index, value) == pytest.approx(1 / (1 + np.exp(-z)))


def test_quality_of_held_out_documents(spark):
    from inkgauge.llm.queries import op1_quality_classifier

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = op1_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in scored if r.quality == 1]
    bad = [r for r in scored if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.98 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.9 * len(bad)


def test_quality_of_odd_rows(spark):
    docs = [(i, "good words here and there " * 3, "en", "s", 70) for i in range(40)]
    docs += [(100 + i, "BAD!!! $$$ ### " * 6, "en", "s", 80) for i in range(40)]
    docs += [(500, None, None, None, None), (501, "", "en", "s", 0), (502, "x" * 3_000_000, "en", "s", 3), (None, "a", "en", "s", 1)]
    df = spark.createDataFrame(docs, DOCS)
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(7, 1), (999, 1), (None, 0), (5, None)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.learn_quality(df, labels, "doc_id", "text", "quality", ("n_chars",))
    rows = quality.score_quality(df, model).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.predicted for r in rows}
    assert by[3] == 1 and by[110] == 0
    assert quality.keep_good(df, model).where("doc_id < 200").count() == 40
    nothing = quality.learn_quality(df, labels.limit(0), "doc_id", "text", "quality", ("n_chars",))
    assert {r.predicted for r in quality.score_quality(df, nothing).collect()} == {1}
    assert quality.score_quality(df.limit(0), model).count() == 0


# -- fingerprints ------------------------------------------------------------------


def plain_units(text):
    units, unit = [], b""
    for byte in (text or "").encode():
        if byte not in SPACES:
            unit += bytes([byte])
        if unit and (byte in SPACES or byte in CUTS):
            units.append(unit)
            unit = b""
    return units + [unit] * bool(unit)


def plain_hash(*values):
    seed = 42
    for v in values:
        data = v if isinstance(v, bytes) else v.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_anchors(text):
    """Anchors in order, by the definition."""
    hashes = [plain_hash(u.decode("latin-1").encode()) for u in plain_units(text)]
    inner = []
    for i in range(len(hashes) - S + 1):
        inner.append(plain_hash(hashes[i], hashes[i + 1]))
    assert S == 2
    found = []
    for i in range(len(hashes) - K + 1):
        here = inner[i : i + INNER]
        if min(here) in (here[0], here[-1]):
            found.append(functools.reduce(plain_hash, [*here[:-1:S], here[-1]]) % (1 << BITS))
    if not found and hashes:
        return [plain_hash(*hashes) % (1 << BITS)]  # an array is hashed element by element
    return found


def plain_likeness(a, b):
    """nth occurrences paired, then the longest sequence of pairs whose blocks do not fall."""
    if not a and not b:
        return 1.0
    places = {}
    for at, value in enumerate(b):
        places.setdefault(value, []).append(at)
    longer, pairs, seen = max(len(a), len(b)), [], {}
    for at, value in enumerate(a):
        n = seen[value] = seen.get(value, -1) + 1
        if n < len(places.get(value, ())):
            pairs.append((at * GRID // longer, places[value][n] * GRID // longer))
    tails = []
    for _, column in sorted(pairs):
        i = bisect.bisect_right(tails, column)
        tails[i : i + 1] = [column]
    return 2 * len(tails) / (len(a) + len(b))


def test_fingerprints_equal_the_plain_model(spark):
    rng = random.Random(17)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(2000))
    code = "".join(rng.choice("ABCDEFGHabcdefghijklmnop0123456789+/") for _ in range(3000))
    text = words(rng, 2000, 3000)
    passages = [text.split()[i : i + 20] for i in range(0, 2000, 20)]
    rng.shuffle(passages)
    lines = "the very same line stands here\n"
    cases = {
        "same": (text, text),
        "shuffled": (text, " ".join(w for p in passages for w in p)),
        "five": (text, " ".join([text] * 5)),
        "han": (han, han[:3] + "\u5b57" + han[3:]),
        "code": (code, "x" + code),
        "header": (text, words(rng, 150, 3000) + " " + text),
        "lines": (lines * 50, "first\n" + lines * 40),
        "few": ("a b c", "a b c"),
        "other": (text, words(random.Random(3), 900, 9000) + " q"),
        "long": ("x" * 500_000, "x" * 500_000 + "y"),
        "null": (None, " \n"),
        "half": ("", text),
    }
    rows = spark.createDataFrame([(k, *v) for k, v in cases.items()], "name string, a string, b string").repartition(3)
    rows = rows.select("name", anchors(rows.a).alias("a"), anchors(rows.b).alias("b"))
    got = {r.name: r for r in rows.select("*", likeness(numbered(rows.a), numbered(rows.b)).alias("near")).collect()}
    for name, (a, b) in cases.items():
        assert got[name].a == plain_anchors(a) and got[name].b == plain_anchors(b), name
        assert got[name].near == pytest.approx(plain_likeness(got[name].a, got[name].b), abs=1e-12), name
    assert got["same"].near == 1.0 and got["null"].near == 1.0 and got["half"].near == 0.0
    assert got["shuffled"].near < 0.4 and got["five"].near < 0.4
    assert got["han"].near > 0.95 and got["code"].near > 0.95 and got["header"].near > 0.9


def test_rows_without_ids_are_spread(spark):
    rows = [(None, f"text without id {i} " + "and words " * (i % 7)) for i in range(400)] + [(1, "the only one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = fingerprint_edits(df, buckets=16).collect()
    # first the row with an id, then the others by their hashes
    texts = ["the only one"] + [t for _, t in sorted((plain_hash(t.encode()), t) for _, t in rows[:-1])]
    expected = []
    for i, text in enumerate(texts):
        cut = len(text) // 3
        expected.append(hashlib.sha256((text[: len(text) - cut] + texts[(i + 1) % 401][:cut]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in got) == sorted(expected)


def test_edits_and_likeness(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, n)) for i, n in enumerate((0, 1, 3, 10, 50, 300, 301, 5000))]
    rows += [(20, None), (21, "é ü " * 30), (22, rows[5][1]), (-4, "last of all"), (None, "without id")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, near_next double").repartition(4)
    got = {r.doc_id: r for r in fingerprint_edits(df, buckets=5).collect()}
    order = sorted(((d, t or "") for d, t in rows if d is not None), reverse=True) + [(None, "without id")]
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= got[doc].near_next <= 1
        if len(text) > 200:
            assert 0.5 < got[doc].near_edited < 0.85 and got[doc].near_next < 0.2
    assert got[5].fingerprint == got[22].fingerprint != got[6].fingerprint
    assert got[0].fingerprint == got[20].fingerprint == ""


def test_anchors_are_closed_syncmers(spark):
    rng = random.Random(8)
    text = words(rng, 200)
    df = spark.createDataFrame([(1, text), (2, "zzz " * 3 + text)], "doc_id bigint, text string")
    prints = [r.fingerprint for r in fingerprint_edits(df, buckets=2).orderBy("doc_id").collect()]
    a, b = ([p[i : i + 4] for i in range(0, len(p), 4)] for p in prints)
    assert base64.b64decode(prints[0]) == b"".join(x.to_bytes(3, "big") for x in plain_anchors(text))
    runs = len(plain_units(text)) - K + 1
    assert 0.9 * 2 / INNER < len(a) / runs < 1.2 * 2 / INNER and S < K
    assert b[-len(a) :] == a  # context-free: what stands in front changes no later anchor


def test_fingerprints_of_few_rows(spark):
    one = spark.createDataFrame([(1, "only one here")], "doc_id bigint, text string")
    row = fingerprint_edits(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"only one only").hexdigest() and row.near_next == 1.0
    assert fingerprint_edits(one.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (None, "c")], "doc_id bigint, text string")
    assert fingerprint_edits(same).count() == 4


def test_queries_read_whole_tables(spark):
    from inkgauge.llm.queries import QUERIES

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_language_id", "op5_ngram_jaccard_join"):
        assert QUERIES[name](spark, SF).count() == n
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_numerals_are_no_letters(spark):
    assert language_id.letters_of("½ ² Ⅷ ① ٣ _ 4") == ""
    assert language_id.letters_of("½Ab² É_x") == "ab é x"
    learned = {"en": b"the of and to in a is that it was", "de": "der die und in den von zu das mit".encode()}
    df = spark.createDataFrame([(1, "½ ² Ⅷ ①"), (2, "the and ½")], "doc_id bigint, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify_language(df, learned).collect()}
    assert found[1] == ("und", 0.0) and found[2][0] == "en"
