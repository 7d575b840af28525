"""Fingerprints, classifiers, page text, pieces: small cases and brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vitalflow.llm import fingerprints, html_text, linear, pieces, quality, toxicity, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


ODD = [None, "", " ", "a", "ab", "é🎉" * 40, "same", "same", "x" * 100_000]


# ---- fingerprints ------------------------------------------------------------------------


def test_spans_and_extensions_match_plain_comparison():
    rng = random.Random(1)
    for _ in range(200):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))
        x, y = fingerprints.Prefixes(a), fingerprints.Prefixes(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = rng.randint(0, min(len(a) - i, len(b) - j))
        assert fingerprints.spans_equal(x, i, y, j, n) == (a[i : i + n] == b[j : j + n])
        common = 0
        while i + common < len(a) and j + common < len(b) and a[i + common] == b[j + common]:
            common += 1
        assert fingerprints.common_extension(x, i, y, j) == common
        keep, take = rng.randint(0, len(a)), rng.randint(0, len(b))
        whole = fingerprints.Prefixes(a[:keep] + b[:take])
        assert x.spliced(keep, y, take).fingerprint() == whole.fingerprint()
        assert (x.fingerprint() == y.fingerprint()) == (a == b)


def test_likeness_follows_the_share_of_changed_words():
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words_ = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(600)]
    text = " ".join(words_)
    own = fingerprints.Prefixes(text)
    assert fingerprints.likeness(own, fingerprints.Prefixes(text)) == 1.0
    before = 1.0
    for share in (0.01, 0.05, 0.1, 0.5):
        new = [rng.choice(["x", "yy"]) if rng.random() < share else w for w in words_ if rng.random() > share / 4]
        now = fingerprints.likeness(own, fingerprints.Prefixes(" ".join(new)))
        assert now < before and now >= 1 - 6 * share
        before = now
    other = "".join(rng.choice(letters + " ") for _ in range(3_000))
    assert fingerprints.likeness(own, fingerprints.Prefixes(other)) < 0.02
    moved = fingerprints.Prefixes("one more line " + text[:900] + text[930:])
    assert fingerprints.likeness(own, moved) > 0.95


def test_likeness_takes_up_texts_past_any_difference():
    rng = random.Random(8)

    def prose(n, least=2, most=9):
        letters = "abcdefghijklmnopqrstuvwxyz"
        return ["".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)]

    def like(x, y):
        return fingerprints.likeness(fingerprints.Prefixes(x), fingerprints.Prefixes(y))

    text, new = " ".join(prose(800)), " ".join(prose(800))
    at = len(text) // 3
    assert like(text, text[:at] + new[:200] + text[at:-30] + "changed" + text[-25:]) > 0.93
    assert like(new[:300] + text + new[300:500], new[-280:] + text + new[600:900]) > 0.85
    assert like(text, text[:at] + new[:3_000] + text[at + 3_000 :]) == pytest.approx(1 - 3_000 / len(text), abs=0.02)
    assert like(text, text[at:] + text[:at]) > 0.98  # moved
    short = prose(900, 2, 4)
    changed = [w if k % 3 else w[::-1] + "q" for k, w in enumerate(short)]
    assert 0.55 < like(" ".join(short), " ".join(changed)) < 0.95
    assert like(text, new) < 0.02
    # what one text has once counts once, however often the other repeats it
    assert like("x" * 100_000, "x" * 50 + "y" * 99_950) < 0.001
    assert like(text * 3 + new, text + new * 3) < 0.55


def test_fingerprints_of_odd_rows(spark):
    ids = [5, 3, 9, None, 2, 7, 2, 2, 1]
    got = fingerprints.fingerprints(docs(spark, ODD, ids)).collect()
    order = sorted(zip(ids, ODD, strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in order]
    want = []
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        want.append((order[k][0], len(text), hashlib.sha256(new.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = {r.fingerprint for r in got if r.doc_id == 2 and r.n_chars == 4}
    assert len(same) == 1
    assert fingerprints.fingerprints(docs(spark, [], [])).count() == 0
    lone = fingerprints.fingerprints(docs(spark, ["abcd"])).first()
    assert lone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and lone.near_next == 1.0


# ---- words -------------------------------------------------------------------------------


def test_word_hashes_tell_words_apart_wherever_they_stand():
    texts = ["The cat\tsat", "", "cat THE\x0bsat\n", "  ", "ünï cat", "thecat"]
    column = pa.array(texts)
    seen, by_hash = {}, {}
    for row, end, data, offsets in words.chunks(column):
        hashes, bounds = words.words(data, offsets)
        for i in range(row, end):
            own = texts[i].encode().lower().split()
            found = hashes[bounds[i - row] : bounds[i - row + 1]].tolist()
            assert len(found) == len(own)
            for w, h in zip(own, found, strict=True):
                assert seen.setdefault(w, h) == h and by_hash.setdefault(h, w) == w


def test_chunks_cover_long_and_short_rows(monkeypatch):
    monkeypatch.setattr(words, "CHUNK", 10)
    texts = ["a" * 50, "", "b c", "d", "e" * 9, "f " * 20]
    joined = [
        data[offsets[i - row] : offsets[i - row + 1]].tobytes().decode()
        for row, end, data, offsets in words.chunks(pa.array(texts))
        for i in range(row, end)
    ]
    assert joined == texts


# ---- classifiers -------------------------------------------------------------------------


def labelled(spark, good, bad, label):
    texts = good + bad
    frame = docs(spark, texts)
    marks = [(i, int(i < len(good))) for i in range(len(texts))]
    other = "toxic" if label == "quality" else "quality"
    return frame, spark.createDataFrame(marks, f"doc_id long, {label} int").withColumn(other, F.lit(0))


def sentences(rng, n):
    plain = ["the", "house", "river", "walks", "under", "morning", "light", "paper", "slowly"]
    return [" ".join(rng.choice(plain) for _ in range(rng.randint(8, 40))) for _ in range(n)]


def test_quality_tells_held_out_junk_from_prose(spark):
    rng = random.Random(2)
    junk = [" ".join(w + "%%%" for w in s.split()) for s in sentences(rng, 60)]
    again = [" ".join([w] * 6) for w in (rng.choice(["river", "paper", "house"]) for _ in range(60))]
    frame, marks = labelled(spark, sentences(rng, 240), junk + again, "quality")
    got = {r.doc_id: r for r in quality.quality_scores(frame, marks).collect()}
    assert len(got) == 360
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(r.predicted, int(i < 240)) for i, r in got.items() if r.held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in got.values())
    kept = quality.keep_good(frame.withColumn("score", F.lit("mine")), marks)
    assert set(kept.columns) == {*frame.columns, "score"}
    assert 230 <= kept.filter("doc_id < 240").count() and kept.filter("doc_id >= 240").count() <= 5


def test_features_are_found_and_counted_by_one_python_process_per_task(spark, monkeypatch):
    plans, to_pandas = [], type(spark.range(0)).toPandas

    def told(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return to_pandas(df)

    monkeypatch.setattr(type(spark.range(0)), "toPandas", told)
    rng = random.Random(5)
    frame, marks = labelled(spark, sentences(rng, 60), [s.replace("e", "qx") for s in sentences(rng, 60)], "quality")
    frame = frame.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"), allowMissingColumns=True)
    marks = marks.unionByName(spark.createDataFrame([(-1, 1), (-2, 0)], "doc_id long, quality int"), allowMissingColumns=True)
    rows = linear.labelled_rows(frame, marks, "quality", lambda doc_id: F.lit(True))
    linear.fit(rows, quality.extract)
    assert [p.count("MapInArrow") for p in plans] == [1]
    got, sizes = linear.log_ratios(rows, quality.extract, 3, 0.0)
    counts, known = np.zeros((2, linear.FEATURES)), rows.collect()
    for r in known:
        (found,) = quality.extract(pa.array([r.text]))
        counts[r.y][found] += 1
    n0, n1 = (sum(r.y == c for r in known) for c in (0, 1))
    assert sizes == (n0, n1) and n0 + n1 == 122
    want = np.log((counts[1] + 1) / (n1 + 2) / ((counts[0] + 1) / (n0 + 2)))
    assert np.allclose(got, np.where(counts.sum(axis=0) >= 3, want, 0.0))


def test_classifiers_on_odd_rows_and_without_labels(spark):
    frame = docs(spark, ODD, [None, *range(1, len(ODD))])
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for scores in (quality.quality_scores, toxicity.toxic_scores):
        got = scores(frame, none).collect()
        assert len(got) == len(ODD) and len({r.score for r in got}) == 1
        assert scores(frame.limit(0), none).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(40)]
    y = np.where([len(set(r) & {0, 1, 2}) > 1 for r in rows], 1, -1)
    scale = rng.normal(size=12)
    w, b = linear.dual_coordinate_descent(rows, y, scale, 1.0, 400, 0)

    def loss(w, b):
        m = np.array([w[r] @ scale[r] + b for r in rows])
        return 0.5 * (w @ w + b * b) + (np.maximum(0, 1 - y * m) ** 2).sum()

    best = loss(w, b)
    for _ in range(300):
        assert loss(w + rng.normal(size=12) * 0.01, b + rng.normal() * 0.01) >= best - 1e-6


def character_cube(texts):
    counts = np.ones((toxicity._SIZE,) * 3)
    for t in texts:
        codes = [toxicity._EDGE, toxicity._EDGE, *[toxicity._code(c) for c in t], toxicity._EDGE]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 50
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


def test_restoring_matches_the_best_of_all_paths():
    cube = character_cube(["idiot", "loser", "stupid", "the", "house"])

    def value(word, cost):
        codes = [toxicity._EDGE, toxicity._EDGE, *[toxicity._code(c) for c in word], toxicity._EDGE]
        return sum(float(cube[a, b, c]) for a, b, c in zip(codes, codes[1:], codes[2:])) - cost

    for token in ("1d10t", "l0$er", "stuuupid", "i-d-i-o-t", "5tup1d", "hou5e"):
        paths = [("", 0.0)]
        for ways in toxicity.lattice(token):
            paths = [(w + s, c + x) for w, c in paths for s, x in ways]
        best = max(value(*p) for p in paths)
        got = toxicity.restore(token, cube)
        assert max(value(w, c) for w, c in paths if w == got) == pytest.approx(best, abs=1e-4)
    known = {}
    text = "You 1d10t, l.o.s.e.r and s t u p i d! 42 times 3rd A1 the."
    assert toxicity.restored(text, cube, known).startswith("You idiot, loser and stupid!")
    assert toxicity.restored("clean text stays, 100% as it is...", cube, known) == "clean text stays, 100% as it is..."


INSULTS = ["idiot", "loser", "stupid", "the", "house", "asshole", "ass", "météo", "a"]


def test_long_tokens_are_restored():
    cube, known = character_cube(INSULTS), {}
    assert toxicity.restored("idi" + "o" * 90 + "t", cube, known) == "idiot"
    run = "/".join(["the"] * 20) + "/1d10t/" + ",".join(["house"] * 20) + ",l0ser"
    assert toxicity.restored(run, cube, known) == run.replace("1d10t", "idiot").replace("l0ser", "loser")
    dotted = ".".join(["the"] * 20 + ["1d10t"] + ["house"] * 20)
    assert toxicity.restored(dotted, cube, known) == dotted.replace("1d10t", "idiot")
    long = "1d10t-" * 20_000 + "the"
    assert toxicity.restored(long, cube, known).count("idiot") == 20_000
    assert all(len(k) <= toxicity.LONGEST for k in known)


def test_prefilter_passes_over_nothing_that_would_be_restored():
    cube = character_cube(INSULTS)
    rng = random.Random(7)
    texts = [
        "the los€r", "ééé", "m é t é o", "mééété", "(i.d.i.o.t)", "a55!", "i di ot", "id.iot", "st--upid",
        "“l o s e r”", "((a b c))", "ŁŁŁ", "日日日", "🎉🎉🎉", "x", "", "é", "a b", "«i  d  i»", "\u3000i d i o",
    ]
    alphabet = "aioé€日🎉1$!( .-_*'\"/“\n\u3000ñ"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(6_000)]
    column = pa.array(texts)
    passed = []
    for row, _, data, offsets in words.chunks(column):
        passed += [row + i for i in np.flatnonzero(~toxicity._suspicious(data, offsets)).tolist()]
    known = {}
    for i in passed:
        assert toxicity.restored(texts[i], cube, known) == texts[i], texts[i]
    assert len(passed) > 50 and not {0, 1, 2} & set(passed)
    assert toxicity.restored("the los€r", cube, known) == "the loser"
    assert toxicity.restored("m é t é o", cube, known) == "météo"


@pytest.mark.parametrize(
    "text, want",
    [
        ("a55!", "ass!"),
        ("an asshol3!!", "an asshole!!"),
        ("(i.d.i.o.t)", "(idiot)"),
        ('"l o s e r"', '"loser"'),
        ("i  d  i  o  t", "idiot"),
        ("l - o - s - e - r", "loser"),
        ("st-upid", "stupid"),
        ("id.iot.", "idiot."),
        ("i di ot", "idiot"),
        ("The-house, a the.house", "The-house, a the.house"),
    ],
)
def test_plain_disguises_are_restored(text, want):
    assert toxicity.restored(text, character_cube(INSULTS), {}) == want


def test_toxic_words_in_disguise_are_found(spark):
    rng = random.Random(4)
    clean = sentences(rng, 200)
    bad = [s + " " + rng.choice(["idiot", "loser", "moron"]) + " " + t for s, t in zip(sentences(rng, 80), sentences(rng, 80))]
    frame, marks = labelled(spark, bad, clean, "toxic")
    hidden = ["the house is an 1d10t by the river", "paper l0ser light slowly walks", "under the m o r o n house light"]
    more = docs(spark, hidden, [1000, 1001, 1002])
    got = {r.doc_id: r for r in toxicity.toxic_scores(frame.unionByName(more), marks, least=2).collect()}
    assert [got[i].predicted for i in (1000, 1001, 1002)] == [1, 1, 1]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(r.predicted, int(i < 80)) for i, r in got.items() if r.held_out and i < 1000]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_long_clean_texts_among_disguised_ones(spark):
    long = "the house by the river " * 30_000
    texts = [long, long + " 1d10t", long, "s t u p i d", ""]
    frame = docs(spark, texts).coalesce(1).sortWithinPartitions("doc_id")
    marks = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int")
    assert toxicity.toxic_scores(frame, marks).count() == len(texts)


# ---- page text ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>a<b>b</b>c</p><p>d", "abc d"),
        ("<article><h1>T</h1><p>x\n\t y<br>z<p>&lt;w&#62; &eacute;", "T x y z <w> é"),
        ("<nav><a href=a>m</a></nav><article><p>One.</p></article><footer>f</footer>", "One."),
        ("<div class='content'><p>Some words, here, now.</p><div class='comments'><p>Nice, good, post!</p></div></div>", "Some words, here, now."),
        ("<div class=ad><p>Buy, buy, buy!</p></div><main><p>Real, text.</p><form><p>Name, please</p></form></main>", "Real, text."),
        ("<body><aside>side</aside><script>var t='</p>'</script><div><p>A b, c.</p></div>", "A b, c."),
        ("<article><p>1 < 2 and a<!-- no --> b</article>", "1 < 2 and a b"),
        ("<article><p>cut <a href=\"x", "cut"),
        ("<div class='cookie-notice'>We, use, cookies</div><article>Bare text <i>here</i></article>", "Bare text here"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = "Words of the article, and more of them, which go on for a while, as they do. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        ("<form id=aspnetForm><input><div><p>{0}</p><p>{0}</p><select><option>o</select></div></form>", "{0} {0}"),
        ("<nav><a href=a>m</a></nav><div class='content no-sidebar'><h1>T</h1><p>{0}</p></div>", "T {0}"),
        (
            "<div class='elementor-widget elementor-widget-theme-post-content'><p>{0}</p><p>{0}</p></div><footer>f</footer>",
            "{0} {0}",
        ),
        (
            "<div><div class='elementor-widget-text-editor'><p>{0}</p></div>"
            "<div class='elementor-widget-text-editor'><p>{0}</p></div><div class='widget-menu'><p>{0}</p></div></div>",
            "{0} {0}",
        ),
        ("<div class='post comments-open has-share'><h1>T</h1><p>{0}</p></div>", "T {0}"),
        ("<div class=login><p>{0}</p></div>", "{0}"),
        ("<form>{0}<br>{0}<button>Send</button></form><footer>f</footer>", "{0} {0}"),
        ("<footer>Not an article</footer>", ""),
        # what is not the article stays out, however long
        ("<article><p>Short, one.</p></article><div class=comments><p>{0}</p><p>{0}</p></div>", "Short, one."),
        ("<main><p>{0}</p><form><p>Name, please</p></form><div class=sidebar><p>{0}</p></div></main>", "{0}"),
    ],
)
def test_main_text_is_not_dropped_by_a_name(page, text):
    assert html_text.main_text(page.format(LONG.strip())) == text.format(LONG.strip())


SHORT = "<h2>Head</h2><p>A short one.</p><p>Another.</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        (
            f"<article><section>{SHORT}</section><section>{'<p>{0}</p>' * 20}</section><section>{SHORT}</section></article>",
            "Head A short one. Another. " + "{0} " * 20 + "Head A short one. Another.",
        ),
        (
            f"<main><div><p>Intro.</p></div><div>{'<p>{0}</p>' * 9}</div><div><p>The end.</p></div></main>",
            "Intro. " + "{0} " * 9 + "The end.",
        ),
        (
            "<body><div><ul><li><a href=a>m</a><li><a href=b>n</a></ul></div><div id=wrap><h3>Title</h3>"
            f"<div><p>An <i>introduction.</i></p></div>Loose text stands here.<div>{'<p>{0}</p>' * 20}</div>"
            "<ul><li>eggs<li>milk</ul><section><p>Conclusion.</p></section><div><a href=x>Further links</a></div></div>"
            "<div><a href=c>Contact</a> <a href=d>Terms</a></div></body>",
            "Title An introduction. Loose text stands here. " + "{0} " * 20 + "eggs milk Conclusion.",
        ),
        (
            f"<body><h1>Top</h1><div><div>{'<p>{0}</p>' * 5}</div><div>{SHORT}</div></div></body>",
            "Top " + "{0} " * 5 + "Head A short one. Another.",
        ),
    ],
)
def test_main_text_keeps_all_parts(page, text):
    assert html_text.main_text(page.format(LONG.strip())) == text.format(LONG.strip())


def test_pages_of_odd_rows(spark):
    rows = [(1, None, None, "x"), (None, "u", "<p>a", "y"), (1, "u", "<p>" + "long " * 50_000, "z"), (1, None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.n_chars) for r in html_text.extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (None, 1), (1, 249_999)], key=str)
    assert html_text.extract_pages(pages.limit(0)).count() == 0


# ---- pieces ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(public_tokenizers.path(pieces.MODEL))


def best_score(text, v):
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            own = v.scores.get(text[start:end], v.lowest if start == end - 1 else -np.inf)
            best[end] = max(best[end], best[start] + own)
    return best[-1]


def test_segmentation_has_the_best_score(vocabulary):
    v = vocabulary
    by_id = {i: p for p, i in v.ids.items()}
    rng = random.Random(3)
    letters = "theringsoa" + pieces.MARK
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        ids = pieces.stream_ids(text, v)
        assert "".join(by_id[i] for i in ids) == text
        assert sum(v.scores[by_id[i]] for i in ids) == best_score(text, v)
        plain = text.replace(pieces.MARK, "x")
        (found,) = pieces.together([plain], v)
        assert np.frombuffer(found, "<u2").tolist() == pieces.stream_ids(plain, v)


def test_window_is_bounded_and_ids_come_early(vocabulary):
    stream, early, longest = pieces.Stream(vocabulary), 0, 0
    for c in (pieces.MARK + "thering") * 3_000:
        early += len(stream.feed(c))
        longest = max(longest, len(stream.text))
    assert early > 5_000 and longest < 200


def test_ids_of_the_library_decode_too(vocabulary):
    # the library merges pieces by rank, so its ids are others; their texts are the same
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    assert model.encode("") == []
    for text in ("日本語", "\n", "🎉"):
        assert pieces.decode(model.encode(text), vocabulary) == text


def test_encoding_round_trips_any_text(spark, vocabulary):
    texts = [*ODD, "a  b ", " lead", "▁ mark ▁x", "\n\n a\t\r", "a\0b", "\0", "日本語 テキスト", "​́ é", "Don't  stop.\nNow"]
    got = pieces.encode_documents(docs(spark, texts), public_tokenizers.path(pieces.MODEL)).collect()
    assert len(got) == len(texts) and all(r.exact for r in got)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(texts):
        assert by_id[i].n_tokens == len(by_id[i].ids)
        assert pieces.decode(by_id[i].ids, vocabulary) == (t or "")
        if t and pieces.MARK not in t:
            assert by_id[i].ids == pieces.stream_ids((" " + t).replace(" ", pieces.MARK), vocabulary)
    assert pieces.encode_documents(docs(spark, [], []), public_tokenizers.path(pieces.MODEL)).count() == 0


def test_forgetting_words_changes_nothing(vocabulary, monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcde \n") for _ in range(200)) for _ in range(30)]
    whole = [a.tolist() for a in pieces.encode_batch(texts, vocabulary, {})]
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    assert [a.tolist() for a in pieces.encode_batch(texts, vocabulary, {})] == whole


# ---- markup ------------------------------------------------------------------------------

SENTENCE = "A sentence of some length, with commas, that reads on for a while and tells of things."


@pytest.mark.parametrize("start", ["<p data-x=it's>", "<p title=a\"b>", "<p data-x=\"it's\" title='a > b'>", "<p a = 'b>' c>"])
def test_quotes_open_values_only_after_an_equals_sign(start):
    page = f"<html><body><article><p>{SENTENCE}</p>{start}{SENTENCE}</p><p>{SENTENCE}</p><p>See <a href=/it's>this</a> too, it's said.</p></article></body></html>"
    assert html_text.main_text(page) == f"{SENTENCE} {SENTENCE} {SENTENCE} See this too, it's said."


def test_parsing_is_linear_in_the_depth():
    import time

    def seconds(depth):
        start = time.perf_counter()
        html_text.main_text("<div>" * depth + f"<p>{SENTENCE}</p>" + "</b>" * depth)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(50_000) < 20  # hours if every tag looked through all that are open
