import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.bpe_chunks import encode_decode, join_ids, round_trip
from basketry.llm.encoder import default_path, encoder
from basketry.llm.gsaca import suffix_array
from basketry.llm.minhash_bayes import keep_one, least_matches, near_duplicates
from basketry.llm.mixing import copies, mix
from basketry.llm.pfor_files import FileWriter, pack, token_files, unpack
from basketry.llm.ppm import _known, _spread, _squeeze, ppm_scores
from basketry.llm.quality_qda import features, keep_good, quality_scores
from basketry.llm.suffix_dedup import remove_repeats, repeats, window_verdicts
from basketry.llm.toxicity_weak import toxicity_scores
from tests.llm import helpers as H

ROWS = H.texts()
WITH_NULLS = [*ROWS, (None, ROWS[5][1]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return H.frame(spark, WITH_NULLS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return H.frame(spark, []).limit(0)


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(0)
    for k in range(400):
        t = rng.integers(0, rng.integers(1, 6), rng.integers(0, 40))
        if k % 5 == 0:
            t = np.tile(t, 3)
        x = t.tolist()
        assert suffix_array(t).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_window_verdicts_are_the_least_ids():
    rng = np.random.default_rng(1)
    strings = [rng.integers(1, 3, rng.integers(4, 30)) for _ in range(30)]
    ids = rng.permutation(30)
    got = window_verdicts(strings, ids, 4)
    for s, v in zip(strings, got):
        for k in range(len(s) - 3):
            w = s[k:k + 4].tolist()
            assert v[k] == min(d for t, d in zip(strings, ids) if any(t[j:j + 4].tolist() == w for j in range(len(t) - 3)))


def test_repeats(docs, empty):
    got = [tuple(r) for r in repeats(docs).collect()]
    H.same(got, H.removed(WITH_NULLS))
    assert repeats(empty).count() == 0


def test_remove_repeats_keeps_rows_and_columns(docs):
    out = remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(WITH_NULLS)
    kept = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert kept[114].text == "" and kept[114].n_tokens == 2
    assert kept[107].text == dict(ROWS)[107]
    assert kept[101].text == ""


def test_near_duplicates(docs, empty):
    want = H.near_duplicates(WITH_NULLS)
    got = near_duplicates(docs).collect()
    assert len(got) == len(WITH_NULLS)
    size = {i: len(H.shingles(t)) for i, t in WITH_NULLS}
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
            assert r.n_shingles == size[r.doc_id]
    assert near_duplicates(empty).count() == 0
    one = keep_one(docs)
    assert one.columns == docs.columns
    ids = [r.doc_id for r in one.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i == c)
    assert ids.count(None) == 2


def test_one_row_of_a_repeated_id_stays_and_it_is_the_same_one(spark):
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(1, long), (1, long + " more"), (1, "another text of its own with words"), (2, "x y z"), (2, "x y z"), (None, "n"), (None, "n")]
    def kept(order):
        out = keep_one(H.frame(spark, [rows[k] for k in order]).select("doc_id", "text").repartition(3))
        return sorted((r.doc_id or 0, r.text) for r in out.collect())
    got = kept(range(7))
    assert [i for i, _ in got] == [0, 0, 1, 2]
    assert kept([6, 2, 4, 1, 3, 0, 5]) == got == kept([1, 0, 2, 5, 6, 3, 4])


def test_hot_group_of_near_copies(spark):
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(300):
        w = list(base)
        w[k % 60] = f"own{k // 60}"
        rows.append((k, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near_duplicates(H.frame(spark, rows)).collect()}
    assert got == H.near_duplicates(rows)


def test_posterior_pruning_keeps_what_can_reach_the_threshold():
    need = least_matches(0.85, 1e-5)
    assert need == sorted(need) and all(m < 0.85 * 18 * (k + 1) for k, m in enumerate(need))


def test_ppm(docs, empty):
    learn = lambda i: H.crc(i, 5) != 1
    got = [(r.doc_id, r.n_tokens, r.score) for r in ppm_scores(docs, C.crc_mod(5) != 1).collect()]
    tokens = lambda t: H.WORD.findall((t or "").translate(H.LOWER))
    want = [(i, len(tokens(t)) + 1, s) for (i, t), s in zip(WITH_NULLS, H.ppm(WITH_NULLS, learn))]
    H.same(got, want)
    assert ppm_scores(empty, C.crc_mod(5) != 1).count() == 0


def test_ppm_many_rows_of_a_chunk_and_split_contexts(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "".join(rng.choice(list("aab \u00e9z"), rng.integers(0, 40)))) for i in range(700)]
    rows += [(700, "the end of the tale " * 60), (701, "ab" * 900)]  # contexts with a large share of all positions
    learn = lambda i: H.crc(i, 5) != 1
    frame = H.frame(spark, rows)
    assert 0 < _known(frame.where(C.crc_mod(5) != 1)).hot.sum() <= 1024
    got = [(r.doc_id, r.score) for r in ppm_scores(frame, C.crc_mod(5) != 1).collect()]
    H.same(got, [(i, s) for (i, _), s in zip(rows, H.ppm(rows, learn))])


def test_ppm_numbers_travel_whole():
    for v in (np.zeros(0, np.uint64), np.array([5, 1 << 56, 0], np.uint64), np.array([-1.5, math.inf]), np.array([7, 1 << 31], np.uint32)):
        assert _spread(_squeeze(v), len(v), v.dtype).tolist() == v.tolist()


def test_ppm_base_score_and_no_training(docs):
    from collections import Counter

    tokens = lambda t: [*H.WORD.findall((t or "").translate(H.LOWER)), None]
    count = Counter(w for i, t in WITH_NULLS if H.crc(i, 5) != 1 for w in tokens(t))
    n, v = sum(count.values()), len(count)
    got = [(r.doc_id, r.n_known, r.train_tokens, r.base_score) for r in ppm_scores(docs, C.crc_mod(5) != 1).collect()]
    want = [(i, sum(count[w] > 0 for w in tokens(t)), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)))
            for i, t in WITH_NULLS]
    H.same(got, want)
    flat = ppm_scores(docs.where("doc_id = 103"), F.lit(False)).first()
    assert math.isclose(flat.score, -4 * math.log10(256), rel_tol=1e-6) and flat.train_tokens == 0


def library_ids(text):
    return encoder(default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoding_agrees_with_the_library(docs, empty):
    import hashlib

    t = encoder(default_path()).tokenizer
    want = []
    for i, x in WITH_NULLS:
        ids = library_ids(x)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    H.same([tuple(r) for r in encode_decode(docs).collect()], want)
    assert encode_decode(empty).count() == 0
    out = round_trip(docs)
    assert out.columns == [*docs.columns, "encoded"] and out.count() == len(WITH_NULLS)


def test_joins_are_repaired_wherever_a_text_is_cut():
    rng = np.random.default_rng(5)
    enc = encoder(default_path())
    import pyarrow as pa

    for text in ("don't we'll <|endoftext|> stop", "thethe there  ing\nx", "é́clair ÉCLAIR ß", "aaaa" * 9):
        for _ in range(30):
            cut = sorted(set(rng.integers(1, len(text), rng.integers(1, 5)).tolist()))
            parts = [text[a:b].encode() for a, b in zip([0, *cut], [*cut, len(text)])]
            ids = [enc.encode(pa.array([p.decode()]))[0] for p in parts]
            assert join_ids(enc, parts, ids).tolist() == library_ids(text), parts


def test_pfor_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 255, 256, 257, 5000):
        x = rng.integers(0, 49408, n).astype(np.uint32)
        x[rng.random(n) < 0.02] = 2 ** 32 - 1
        if n == 257:
            x[:] = 7
        ids, docs, null, counts = unpack(pack(x, np.array([5, -1]), np.array([0, 1]), np.array([n, 0])))
        assert (ids == x).all() and docs.tolist() == [5, -1] and null.tolist() == [0, 1] and counts.tolist() == [n, 0]


def test_file_writer_holds_less_than_a_block_whatever_the_documents():
    rng = np.random.default_rng(1)
    import io

    sink, whole, rows = io.BytesIO(), [], []
    writer = FileWriter(sink)
    for k in range(60):
        x = rng.integers(0, 49408, int(rng.integers(0, 3000))).astype(np.uint32)
        writer.add(x, np.array([k]), np.array([0]), np.array([len(x)]))
        whole.append(x)
        assert len(writer.rest) < 256
    writer.close()
    ids, docs, null, counts = unpack(sink.getvalue())
    assert (ids == np.concatenate(whole)).all() and docs.tolist() == list(range(60)) and counts.tolist() == [len(x) for x in whole]


def test_token_files(docs, empty):
    got = token_files(docs).collect()
    assert len(got) == len(WITH_NULLS)
    size = {}
    for r in got:
        size.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    want = {}
    for i, t in WITH_NULLS:
        ids = np.array([*library_ids(t), 1], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert {i: sorted(x[1:] for x in v) for i, v in size.items()} == {i: sorted(v) for i, v in want.items()}
    ordered = sorted(got, key=lambda r: r.start)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in ordered]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert token_files(empty).count() == 0


def test_mixing(docs, empty):
    rows = copies(docs, share=(1, 2), epochs=3).collect()
    assert len(rows) == len(WITH_NULLS)
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.copies for r in rows) <= total // 2
    assert {r.copies for r in rows} <= {0, 1, 2, 3}
    assert copies(empty).count() == 0
    out = mix(docs, share=(9, 1), epochs=2)
    assert out.columns == docs.columns and out.count() == 2 * len(WITH_NULLS)


def test_shortage_goes_to_siblings_first(spark):
    from basketry.llm.mixing import leaf_budgets

    leaves = spark.createDataFrame([("a", "x", "s", 10), ("a", "x", "t", 1000), ("a", "y", "s", 1000), ("b", "x", "s", 1000)],
                                   "domain string, lang string, source string, tokens long")
    one = [("domain", "a", None, None, 1), ("domain", "b", None, None, 1), ("lang", "a", "x", None, 1), ("lang", "a", "y", None, 1),
           ("lang", "b", "x", None, 1), ("source", "a", "x", "s", 1), ("source", "a", "x", "t", 1), ("source", "a", "y", "s", 1),
           ("source", "b", "x", "s", 1)]
    weights = spark.createDataFrame(one, "level string, domain string, lang string, source string, weight long")
    got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(leaves, 800, 1, weights).collect()}
    assert got == {("a", "x", "s"): 10, ("a", "x", "t"): 190, ("a", "y", "s"): 200, ("b", "x", "s"): 400}


def labelled(spark, n=600):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdeghilmnorstu"), rng.integers(2, 9))) for _ in range(800)]
    rows, marks = [], []
    for k in range(n):
        w = rng.choice(words, rng.integers(20, 120)).tolist()
        bad, toxic = k % 5 == 0, k % 4 == 1 and k % 5 != 0
        if toxic:
            for at in rng.integers(0, len(w), 3):
                w[at] = rng.choice(["blorgish", "blorgen", "zwekking", "idiot"])
        text = " ".join(w)
        if bad:
            text = text.upper() + "!! " * len(w) if k % 2 else " | ".join([w[0]] * len(w))
        rows.append((k, text))
        marks.append((k, int(not bad), int(toxic)))
    marks += [(0, None, None), (None, 1, 1), (1, 7, 7)]
    return H.frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), marks


def test_quality_held_out_and_edges(spark, docs, empty):
    d, labels, marks = labelled(spark)
    known = labels.select("doc_id", F.col("quality").alias("label"))
    got = {r.doc_id: r for r in quality_scores(d, known, C.crc_mod(3) != 1).collect()}
    held = [(m[1], got[m[0]].score >= 0.5) for m in marks if m[0] is not None and m[1] in (0, 1) and not got[m[0]].learn]
    assert len(held) > 100 and sum(y == p for y, p in held) / len(held) > 0.97
    scores = quality_scores(docs, known, C.crc_mod(3) != 1).collect()
    assert len(scores) == len(WITH_NULLS) and all(0 <= r.score <= 1 for r in scores)
    assert quality_scores(empty, known, C.crc_mod(3) != 1).count() == 0
    nothing = quality_scores(docs, known.limit(0), C.crc_mod(3) != 1).collect()
    assert {r.score for r in nothing} == {0.5}
    kept = keep_good(d, known, C.crc_mod(3) != 1)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if r.score >= 0.5}


def test_quality_features_do_not_depend_on_the_batch():
    import pyarrow as pa

    t = [x for _, x in ROWS]
    whole = features(pa.array(t))
    for k in range(0, len(t), 7):
        assert np.allclose(features(pa.array([t[k]], pa.string()))[0], whole[k])


def test_toxicity_held_out_and_edges(spark, docs, empty):
    d, labels, marks = labelled(spark)
    known = labels.select("doc_id", F.col("toxic").alias("label"))
    got = {r.doc_id: r for r in toxicity_scores(d, known, C.crc_mod(5) != 0).collect()}
    held = [(m[2], got[m[0]].score >= 0.5) for m in marks if m[0] is not None and m[2] in (0, 1) and not got[m[0]].learn]
    assert len(held) > 60 and sum(y == p for y, p in held) / len(held) > 0.97
    scores = toxicity_scores(docs, known, C.crc_mod(5) != 0).collect()
    assert len(scores) == len(WITH_NULLS) and all(0 <= r.score <= 1 for r in scores)
    assert toxicity_scores(empty, known, C.crc_mod(5) != 0).count() == 0
    assert {r.score for r in toxicity_scores(docs, known.limit(0), C.crc_mod(5) != 0).collect()} == {0.5}
