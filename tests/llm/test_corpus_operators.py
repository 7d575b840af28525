"""Deduplication, mixing, files and the pipeline: small cases and brute force."""

import base64
import hashlib
import gzip
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_text_operators import ODD, docs
from vitalflow.llm import archives, exact_dedup, mixing, near_dedup, pieces, quality, token_files
from vitalflow.llm.common import documents, labels
from vitalflow.session import fresh_path

# ---- mixing ------------------------------------------------------------------------------


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()) * share, set()
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        rate = rest / max(sum(weight[s] for s in names if s not in stopped), 1e-9)
        over = {s for s in names if s not in stopped and rate * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in stopped else rate * weight[s] for s in names}
        stopped |= over


def test_mix_meets_targets_and_repeats_itself(spark):
    rng = random.Random(1)
    rows = [
        (i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "a", "a", "a", "é", "b", None, "z"]), None)
        for i in range(2_000)
    ] + [(None, None, None, None, None), (7, "w w", "en", "a", None), (7, "w w", "en", "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_plan(frame).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    want = targets_by_hand(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert math.floor(r.target / r.source_size) <= r.copies <= math.ceil(r.target / r.source_size) <= 2
        taken[r.source] += r.copies * r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    again = mixing.mix_plan(frame.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    clash = frame.withColumn("row", F.lit(1)).withColumn("row_key", F.lit("k")).withColumn("copies", F.lit(0))
    whole = mixing.mix(clash)
    assert whole.columns == clash.columns
    times = Counter(r.doc_id for r in whole.collect())
    assert all(times[r.doc_id] == r.copies for r in got if r.doc_id not in (None, 7))


def test_mix_of_nothing(spark):
    frame = docs(spark, [])
    assert mixing.mix_plan(frame).count() == 0 and mixing.mix(frame).count() == 0
    blank = mixing.mix_plan(docs(spark, ["", None, " "])).collect()
    assert [r.copies for r in blank] == [0, 0, 0] and {r.target for r in blank} == {0.0}


# ---- exact dedup -------------------------------------------------------------------------


def groups_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        import re

        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return groups


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: (F.length(c) % 3).cast("string")])
@pytest.mark.parametrize("files", [1, 1_000])
def test_exact_groups_hold_by_bytes_over_micro_batches(spark, digest, files):
    rng = random.Random(5)
    texts = ["a  b", "a b", "a\tb", "ab", "ba", "", None, " ", "é", "x" * 50_000, "x" * 50_000]
    rows = [(rng.choice([*range(40), None]), rng.choice(texts)) for _ in range(150)]
    frame = docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(5)
    _, groups = exact_dedup.exact_groups(frame, digest=digest, files_per_batch=files)
    got = groups.collect()
    want = groups_by_hand(rows)
    expected = []
    for members in want.values():
        known = [i for i in members if i is not None]
        expected += [(i, min(known, default=None), len(members)) for i in members]
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == sorted(expected, key=str)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_keeps_whole_rows(spark):
    frame = docs(spark, ["a", "a ", " b", "a"]).withColumns({"digest": F.lit(1), "row_key": F.lit(2), "row": F.col("doc_id")})
    out = exact_dedup.exact_dedup(frame)
    assert out.columns == frame.columns
    assert sorted((r.doc_id, r.text, r.row) for r in out.collect()) == [(0, "a", 0), (1, "a ", 1), (2, " b", 2)]
    assert exact_dedup.exact_dedup(frame.limit(0)).count() == 0


# ---- near dedup --------------------------------------------------------------------------


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w[i : i + size]) for i in range(len(w) - size + 1)] or [tuple(w)])


def components_by_hand(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both and 100 * both >= percent * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest[root(k)] = min(smallest.get(root(k), i), i)
    return [(rows[k][0], len(sets[k]), smallest[root(k)]) for k in range(len(rows))]


def near_rows(rng):
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(120)]
    texts = ["", None, " ", "one", "ONE", "two words", "Two  Words", "x y z"]
    for _ in range(120):  # copies at many distances, some in chains
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = rng.choice(["p", "q", "rr"])
        texts.append(" ".join(own))
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["passage " * 3 + " ".join(base[:40]) + f" tail {i} {i * 7}" for i in range(20)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_groups_match_all_pairs(spark, size, percent):
    rows = near_rows(random.Random(size))
    frame = docs(spark, [t for _, t in rows])
    _, groups = near_dedup.near_groups(frame, size=size, percent=percent, miss=1e-9)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in groups.collect())
    assert got == sorted(components_by_hand(rows, size, percent))
    kept = near_dedup.near_dedup(frame.withColumn("kept", F.lit("mine")), size=size, percent=percent, miss=1e-9)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_a_pair_that_meets_in_many_tables_is_made_once(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(12)] + ["alone with some words"]
    rows = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "row_key long, doc_id long, text string")
    groups = near_dedup.group_count(0.85)
    nodes = near_dedup.signatures(rows, 3, groups, near_dedup.WIDTH, 20).withColumnRenamed("row_key", "node")
    tables = near_dedup._tables(nodes).withColumn("component", F.col("node")).cache()
    odd = [F.col("odd")[k].alias(f"odd{k}") for k in range(near_dedup.SKETCH_WORDS)]
    halves = F.transform(F.concat("left", "right"), lambda v, k: F.xxhash64(k, v)).alias("halves")
    made = near_dedup._pairs_left(tables, nodes.select("node", *odd, halves), 80)
    a, b = (tables.select("table_key", F.col("node").alias(c)) for c in "ab")
    met = a.join(b, "table_key").filter("a < b").select("a", "b")
    assert met.count() > 5 * met.distinct().count()
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, met.distinct().collect()))
    tables.unpersist()


def test_tables_with_the_same_members_are_one_and_make_every_pair_once(spark):
    rng = random.Random(12)
    texts = []
    for k in range(40):  # two near copies each, and a few larger groups of them
        base = [f"w{k}_{i}" for i in range(60)]
        for j in range(5 if k % 10 == 0 else 2):
            at = rng.randrange(60)
            texts.append(" ".join(base[:at] + [f"x{j}"] + base[at + 1 :]))
    rows = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "row_key long, doc_id long, text string")
    groups = near_dedup.group_count(0.8)
    nodes = near_dedup.signatures(rows, 3, groups, near_dedup.WIDTH, 20).withColumnRenamed("row_key", "node")
    tables = near_dedup._tables(nodes).cache()
    by_table = defaultdict(set)
    for r in tables.collect():
        by_table[r.table_key].add(r.node)
    several = [frozenset(s) for s in by_table.values() if len(s) > 1]
    kept = near_dedup._different(tables)
    found = [frozenset(by_table[r.table_key]) for r in kept.collect()]
    assert sorted(map(sorted, found)) == sorted(map(sorted, set(several))) and 5 * len(found) < len(several)
    odd = [F.col("odd")[k].alias(f"odd{k}") for k in range(near_dedup.SKETCH_WORDS)]
    halves = F.transform(F.concat("left", "right"), lambda v, k: F.xxhash64(k, v)).alias("halves")
    members = tables.join(kept, "table_key").withColumn("component", F.col("node"))
    made = near_dedup._pairs_left(members, nodes.select("node", *odd, halves), 10)
    want = {(a, b) for s in several for a in s for b in s if a < b}
    assert sorted(map(tuple, made.collect())) == sorted(want)
    tables.unpersist()


def test_marks_keep_all_wanted_rows_and_few_others(spark):
    rows = spark.range(-10_000, 30_000).select(F.col("id").alias("node"), F.lit("t").alias("text"))
    wanted = spark.range(-7_000, 7_000, 70).select(F.col("id").alias("node"))
    likely = near_dedup._likely(rows, wanted)
    assert likely.columns == ["node", "text"]
    got = [r.node for r in likely.collect()]
    assert set(range(-7_000, 7_000, 70)) <= set(got) and len(got) == len(set(got)) <= 220
    assert near_dedup._likely(rows, wanted.limit(0)).count() == 0


def test_texts_and_sets_of_no_candidate_are_not_shuffled(spark, monkeypatch):
    written, shuffled = {}, near_dedup.staged

    def staged(df, name, *path):
        out = shuffled(df, name, *path)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        written.setdefault(name, []).append((plan.count("bitmap_construct_agg"), out))
        return out

    monkeypatch.setattr(near_dedup, "staged", staged)
    rows = near_rows(random.Random(8))
    _, groups = near_dedup.near_groups(docs(spark, [t for _, t in rows]), size=3, percent=85)
    groups.collect()
    assert written["near-sets"][0][0] == 1
    assert all(count == 2 for count, _ in written["near-links"])
    for name in ("near-alone", "near-tables"):
        (_, out), = written[name]
        with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
            out.collect()


def test_near_groups_of_odd_rows(spark):
    ids = [5, 3, 9, None, 2, 7, 2, 2, 1]
    rows, groups = near_dedup.near_groups(docs(spark, ODD, ids))
    got = groups.collect()
    assert len(got) == len(ODD) and sum(r.kept for r in got) == len(ODD) - 1
    assert rows.count() == len(ODD)
    assert near_dedup.near_dedup(docs(spark, [])).count() == 0


def test_sketches_never_rule_out_a_link(spark):
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        whole = rng.integers(0, 1 << 63, n * 2, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(whole[:n]), np.unique(whole[int(rng.integers(0, n)) :][:n])
        both = len(np.intersect1d(a, b))
        items, bounds = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        x, y = np.array(near_dedup._odd_sketches(items, bounds).to_pylist(), dtype=np.int64).view(np.uint64)
        apart = int(np.bitwise_count(x ^ y).sum())
        assert apart <= len(a) + len(b) - 2 * both


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 300), (300, 250), (9, 9)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in [*range(61), 300, 250]} | {i: 100 for i in range(100, 160)}
    assert got == want
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- token files -------------------------------------------------------------------------


def test_wavelet_matrix_matches_plain_search():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 511, 512, 513, 3_000):
        ids = rng.choice([0, 1, 2, 7, 300, 49_407, 65_535], n).astype(np.uint16)
        raw = token_files.to_bytes([None, 5], [n, 0], ids)
        doc_ids, lengths, m = token_files.from_bytes(raw)
        assert doc_ids == [None, 5] and lengths.tolist() == [n, 0]
        assert (m.ids() == ids).all()
        for i in rng.integers(0, max(n, 1), 20 if n else 0).tolist():
            assert m.access(i) == ids[i]
        for value in (0, 2, 7, 49_407, 3):
            places = np.flatnonzero(ids == value)
            low, high = sorted(rng.integers(0, n + 1, 2).tolist())
            assert m.count(value, low, high) == int(((places >= low) & (places < high)).sum())
            for k in range(0, len(places), 37):
                assert m.occurrence(value, k) == places[k]
            with pytest.raises(IndexError):
                m.occurrence(value, len(places))


def test_token_files_hold_what_the_library_gives(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*ODD, "don't I'LL", "a\x01b \x01", "<|endoftext|> x<|startoftext|>y", "a\x1cb\x85c\xa0d", "é ́x", "İΣΑΣ 日本 １２. The THE, the!. .,! ,the a.b. Ab.'s"]
    ids = [5, 3, 9, None, 2, 7, 2, 2, 1, *range(20, 26)]
    folder = fresh_path(spark, "tokens")
    files = token_files.write_token_files(docs(spark, texts, ids), path, folder, shard_ids=50)
    assert files.count() > 1
    library = Tokenizer.from_file(path)
    order = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for i, t in order:
        own = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    got = token_files.token_file_sums(files, folder).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    whole = token_files.read_token_files(files, folder).collect()
    assert {zlib.crc32(bytes(r.ids)) for r in whole} == {w[3] for w in want}
    empty = fresh_path(spark, "tokens")
    none = token_files.write_token_files(docs(spark, []), path, empty)
    assert none.count() == 0 and token_files.token_file_sums(none, empty).count() == 0


def test_encoder_takes_words_straight_from_the_model():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    signs = "aÀé.,'<|st \t\x01\x0b\x1cΩ3ßñt×÷İ≠º\u0301\u0338\xa0日—"
    texts = ["", " ", "naïve—dash co-op 12a3", "O'Neil's WE'LL", *("".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(2_000))]
    encoder = token_files.Encoder(path)
    for part in (texts[:1_000], texts[1_000:], texts):
        for text, ids in zip(part, encoder.encode(pa.array(part)), strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text

    encoder, rest, plain = token_files.Encoder(path), [], encoder._encoded
    encoder._encoded = lambda pieces: rest.extend(pieces) or plain(pieces)
    words = [f"{a}{b}{end}" for a in "aÉs" for b in ("stra", "ße", "on") for end in ("", ".", ",", "###")]
    encoder.encode(pa.array([" ".join(words), " ".join(words[::-1])]))
    assert sorted(rest) == ["###", ",", "."]


# ---- archives ----------------------------------------------------------------------------


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_become_warc_records(version):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    bodies = [b"", b"<p>\n\nhttp://a 0.0.0.0 20240101000000 text/html 5\n", b"\r\n" * 4, b"x" * 100_000]
    records = [(f"http://a/{i} b", "20050102030405", "text/html", http + b) for i, b in enumerate(bodies)]
    records.append(("dns:a", "2005", "text/dns", b"a 1.2.3.4"))
    arc = archives.write_arc("old.arc", records, version)
    read = list(archives.read_arc(arc))
    assert [r.fields["URL"] for r in read[1:]] == [r[0] for r in records]
    assert [r.content for r in read[1:]] == [r[3] for r in records]
    assert tuple(read[0].fields) == archives.FIELDS[version]
    out = list(archives.read_warc(archives.convert(arc, "old.arc")))
    assert [r.headers["WARC-Type"] for r in out] == ["warcinfo", *["response"] * 4, "resource"]
    assert len({r.headers["WARC-Record-ID"] for r in out}) == 6
    assert {r.headers["WARC-Date"] for r in out[1:5]} == {"2005-01-02T03:04:05Z"}
    for r, body in zip(out[1:5], bodies, strict=True):
        assert r.content == http + body
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r.headers["WARC-Payload-Digest"] == f"sha1:{digest}"
    import gzip

    assert archives.convert(gzip.compress(arc), "old.arc") == archives.convert(arc, "old.arc")
    with pytest.raises(ValueError):
        list(archives.read_arc(b"filedesc://x 0.0.0.0 2005 text/plain 4\n9 0 x"))


def test_many_members_are_read_in_one_go():
    one = gzip.compress(b"x" * 300)
    start = time.process_time()
    # copying the rest of the file for each of the members takes minutes
    assert archives.unzipped(one * 150_000) == b"x" * 45_000_000
    assert time.process_time() - start < 30


def test_archives_of_odd_pages(spark):
    rows = [
        (4, "http://a b", "<p>x", 1), (9, None, "<p>x", 1), (9, "u", "<p>x", 2), (None, "u", "<p>x", 3), (2, "u", None, 4),
        (3, "u", "", 5), (-5, "é", "é" * 60_000, 6), (None, "u", "only", 7), (8, "u", "HTTP/1.1 200\r\n\r\n", 8),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 int").repartition(4)
    folder = fresh_path(spark, "warc")
    files = archives.write_archives(pages, folder, archive_bytes=1_000)
    got = archives.read_archives(files, folder).collect()
    want = []
    for i, _, h, _ in rows:
        body = (h or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (h or "") and r[0] is not None]
        keeper = max(same, default=None)
        revisit = keeper is not None and keeper != i
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, len(body), digest, "revisit" if revisit else "response", keeper if revisit else None))
    shown = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(shown, key=str) == sorted(want, key=str)
    assert {archives.page_of_urn(archives.page_urn(i)) for i in (0, -1, 2**62, 65_536)} == {0, -1, 2**62, 65_536}
    empty = fresh_path(spark, "warc")
    none = archives.write_archives(pages.limit(0), empty)
    assert none.count() == 0 and archives.read_archives(none, empty).count() == 0


# ---- the pipeline ------------------------------------------------------------------------


def test_pipeline_matches_the_stages_by_hand(spark, sf_dir):
    """Each stage on all that the one before kept; the last row counts are those of the mix."""
    table = documents(spark, sf_dir)
    rows = {r.doc_id: r for r in table.collect()}
    good = {r.doc_id for r in quality.keep_good(table, labels(spark, sf_dir)).select("doc_id").collect()}
    assert 0 < len(good) < len(rows)
    left = {}
    for i in sorted(good):
        left.setdefault(next(iter(groups_by_hand([(i, rows[i].text)]))), i)
    unique = sorted(left.values())
    alone = components_by_hand([(i, rows[i].text) for i in unique], 5, 80)
    last = {c for _, _, c in alone}
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(table.filter(F.col("doc_id").isin(*last))).collect()}
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids", "exact"]
    found = got.collect()
    assert Counter(r.doc_id for r in found) == Counter({i: n for i, n in plan.items() if n})
    words = pieces.Vocabulary(public_tokenizers.path(pieces.MODEL))
    for r in found[:20]:
        assert r.exact and pieces.decode(r.ids, words) == rows[r.doc_id].text
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "minhash_near_dedup", "source_mixing", "sentencepiece",
    ]
