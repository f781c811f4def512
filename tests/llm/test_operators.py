import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers as P
from llm import brute
from corpusloom.llm import bytebpe, common, exact, idfiles, lines, mph, packing, quality, queries, simhash, substrings, tokencount, toxicity, wordbpe
from corpusloom.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, rep long, n long, keep long, words string, lines string, cuts string, digit string, length long, salt int, before long"
WORDS = P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = P.path("piece_bpe_32k.model")


def corpus(seed=1, n=60):
    """Copies, near copies, shared passages, a hot line, odd texts, and one long text."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdehinorstü") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    text = lambda k: "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", " ", ", ", ".\n", " x "]) for _ in range(k))
    passage, hot, base = text(70), "a line that everybody has got", text(150)
    docs = []
    for _ in range(n):
        t = text(rng.choice([5, 60, 120]))
        kind = rng.randrange(7)
        if kind == 0:
            t = base
        elif kind == 1:
            w = base.split(" ")
            w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
        elif kind == 2:
            t = text(20) + passage + text(20)
        elif kind == 3:
            t = hot + "\n" + t
        docs.append(t)
    docs += [None, "", " \n\t ", "One two", "one TWO", "é ß\x0b x\x0cy\r\nz", "0 10 a0 <|endoftext|> <s> ▁ ▁a  b", text(6000), base.upper(), "the the the the the the"]
    return list(enumerate(docs))


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The corpus with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", 0, 1, 1, 1, 1, "w", "l", "c", "d", 1, 1, 1) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    outs = [
        quality.quality_filter(empty), simhash.near_groups(empty), bytebpe.round_trips(empty, RANKS, P.PATTERN), packing.pack(empty, WORDS), lines.drop_common_lines(empty), idfiles.id_files(empty, WORDS),
        exact.exact_groups(empty), toxicity.score(empty, toxicity.train(empty, labels)), tokencount.token_counts(empty, PIECES), substrings.drop_repeats(empty),
    ]
    assert [o.count() for o in outs] == [0] * 10


def test_batches_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 1 << 16)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    rows = common.as_docs(spark.range(50).selectExpr("id AS doc_id", "repeat('long text ', 1000) AS text"))
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    most = max(r.n for r in rows.mapInArrow(sizes, "n long").collect())
    spark.conf.set(key, before)
    assert most <= 8


def test_repeated_rows_and_null_ids(spark, rows):
    twice = spark.createDataFrame([(7, "same text here"), (7, "same text here"), (7, "another text"), (None, "same text here"), (None, None), (9, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 1), (7, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    full = twice.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    outs = [
        quality.quality_filter(full), simhash.near_groups(twice), bytebpe.round_trips(twice, RANKS, P.PATTERN), packing.pack(twice, WORDS), lines.drop_common_lines(twice), idfiles.id_files(twice, WORDS),
        exact.exact_groups(twice), toxicity.score(twice, toxicity.train(twice, labels)), tokencount.token_counts(twice, PIECES), substrings.drop_repeats(twice),
    ]
    assert [o.count() for o in outs] == [6] * 10
    kept = {(r.doc_id, r.keep_id, r.kept) for r in outs[6].collect()}
    assert kept == {(7, 7, True), (None, 7, False), (None, 9, False), (9, 9, True)}
    assert all(r.n_tokens is not None for r in outs[5].collect())


def test_names_that_operators_use_inside(spark, rows):
    names = ["__text", "__of", "__cuts", "__spans", "__digest", "a.b", "text", "Text", "of", "digest", "spans", "whole", "c0", "c1", "rep", "first", "DOC_ID", "doc_id", "score", "a`b"]
    df = spark.createDataFrame([tuple(t if n == "text" else i if n == "doc_id" else "z" for n in names) for i, t in rows[:40]], T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.StringType()) for n in names]))
    plain = spark.createDataFrame(rows[:40], "doc_id long, text string")
    machine = toxicity.fit([], np.zeros(0))
    for f in (lines.drop_common_lines, substrings.drop_repeats, lambda d: toxicity.with_score(d, machine, "own")):
        wide, thin = f(df), f(plain)
        assert wide.columns == [*names, *thin.columns[2:]]
        at = [wide.columns.index(c) for c in thin.columns]
        assert sorted([tuple(r[k] for k in at) for r in wide.collect()], key=str) == sorted(map(tuple, thin.collect()), key=str)
    for f in (exact.exact_groups, simhash.near_groups, lambda d: packing.pack(d, WORDS), lambda d: tokencount.token_counts(d, PIECES)):
        assert f(df).count() == f(plain).count()


# ---- 1 --------------------------------------------------------------------------------------------------------


def test_measures(rows, docs):
    got = {r.doc_id: r for r in quality.text_stats(docs).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == brute.measures(t), t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t#|é\x0b\xa0", max_size=60))
def test_measures_of_any_text(text):
    assert quality.measure(text.encode()) == (brute.measures(text) if brute.words(text) else (0,) * 6)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=20))
def test_buckets_are_tight(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v long").selectExpr("v", f"cast({quality.bucket_of('v')} as bigint) AS b").selectExpr("v", "b", f"cast({quality.bucket_floor('b')} as bigint) AS f").collect()
    assert all(r.f <= r.v <= r.f + max(r.f // 32, 0) and r.f <= r.v for r in got)


def test_outliers_of_a_group_go_and_clean_documents_stay(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    clean = [" ".join(word() for _ in range(80)) for _ in range(300)]
    junk = [" ".join(word() + "###" for _ in range(80)) for _ in range(10)]
    df = spark.createDataFrame([(i, t, "en", "a" if i % 2 else "b") for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_filter(df).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 310))


# ---- 2 --------------------------------------------------------------------------------------------------------


def test_fences_follow_their_group(spark):
    """Two sources of one language: what is common in one of them is beyond the fence of the other, and a lone document leans on its language."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(n - 2, n + 2)))
    text = lambda n, every: " ".join(word(n) + ("|" if every and k % every == rng.randrange(3) else "") for k in range(300))
    rows = [(i, text(5, 0), "en", "prose") for i in range(200)] + [(200 + i, text(8, 20), "en", "tables") for i in range(200)] + [(400, text(8, 20), "en", "prose"), (401, text(5, 0), "en", "alone"), (402, text(25, 3), "en", "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    stats = quality.text_stats(df)
    fences = {r.source: r for r in quality.thresholds(stats).collect()}
    assert fences["prose"].max_symbols < 400 < fences["tables"].max_symbols
    assert fences["prose"].max_word_len < fences["tables"].max_word_len and fences["prose"].min_word_len < fences["tables"].min_word_len
    got = {r.doc_id: r.kept for r in quality.quality_filter(df).collect()}
    assert not got[400] and not got[402] and got[401] and sum(got[i] for i in range(400)) >= 380


def test_quantiles_move_smoothly_with_the_size_of_a_group(spark):
    fence = []
    for n in range(47, 54):  # no size at which a group stops leaning on its language
        rows = [(i, " ".join(["abcde"] * 60 + [f"w{k}" for k in range(40)]), "en", "big") for i in range(500)] + [(500 + i, " ".join(f"longerword{k}" for k in range(100)), "en", "own") for i in range(n)]
        stats = quality.text_stats(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
        fence.append({r.source: r.max_word_len for r in quality.thresholds(stats).collect()}["own"])
    steps = [b - a for a, b in zip(fence, fence[1:])]
    assert max(map(abs, steps)) < 0.05 * fence[0]


def test_near_groups(rows, docs):
    assert listed(simhash.near_groups(docs), "doc_id", "fingerprint", "component_id") == sorted((i, f"{f:016x}", c) for i, f, c in brute.near_groups(rows))


@pytest.mark.parametrize(("chunk", "blocks"), [(4096, simhash.BLOCKS), (5, simhash.BLOCKS), (4096, simhash.WIDE_BLOCKS)])
def test_links_join_all_within_the_threshold(spark, chunk, blocks):
    rng = random.Random(chunk)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps.add(centre)
        for _ in range(25):
            near = centre
            for b in rng.sample(range(64), rng.randint(1, 5)):
                near ^= 1 << b
            fps.add(near)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long"), chunk, blocks)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert [roots.get(k, k) for k in range(len(fps))] == brute.components(list(range(len(fps))), fps)


@pytest.mark.parametrize("blocks", [simhash.BLOCKS, simhash.WIDE_BLOCKS])
def test_anchors_cover(blocks):
    """Two fingerprints within the threshold meet: the home of one is among the anchors of the other."""
    rng = random.Random(3)
    for _ in range(300):
        a = b = rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randint(0, simhash.THRESHOLD)):
            b ^= 1 << bit
        keys, visit, row = simhash.meetings(np.array([a, b], np.uint64), blocks)
        assert set(keys[(row == 0) & (visit == 0)]) & set(keys[row == 1])


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(3, 3), (5, 4)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(101, 141)} | {k: 7 for k in range(200, 260)} | {5: 4}


# ---- 3 --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})


def test_round_trips(rows, docs, reference):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert listed(bytebpe.round_trips(docs, RANKS, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)
    back = bytebpe.decode_ids(bytebpe.encode_ids(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted((r.doc_id, bytes(r.text).decode()) for r in back.collect()) == sorted((i, t or "") for i, t in rows)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="etaoinshr dlu", max_size=80), st.text(alphabet="a ", max_size=60)))
def test_encoding_of_any_text(reference, text):
    assert bytebpe.codec(RANKS, P.PATTERN).encode(text) == reference.encode_ordinary(text)


# ---- 4 and 6 --------------------------------------------------------------------------------------------------


def ids_of(text):
    return wordbpe.encoder(WORDS).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.text(alphabet="abAB.,'0 1é\n|<>İ", max_size=30)), max_size=6))
def test_word_encoder(texts):
    e = wordbpe.encoder(WORDS)
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert [np.frombuffer(r, "<u4").tolist() for r in e.encode_many([t.encode() for t in texts])] == [ids_of(t) for t in texts]


def test_word_encoder_forgets_safely(monkeypatch):
    monkeypatch.setattr(wordbpe, "MEMO", 20)
    monkeypatch.setattr(wordbpe, "CHUNK", 64)
    e = wordbpe.WordEncoder(WORDS)
    texts = [t or "" for _, t in corpus(2, 20)]
    assert [np.frombuffer(r, "<u4").tolist() for r in e.encode_many([t.encode() for t in texts])] == [ids_of(t) for t in texts]


def test_packing(rows, docs):
    out = packing.pack(docs, WORDS, end_id=1, capacity=512).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        ids = [*ids_of(t), 1]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(k, a, min(512, len(ids) - a)) for k, a in enumerate(range(0, len(ids), 512))]
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in pieces)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    assert len(by_sequence) <= 1.1 * sum(r.length for r in out) / 512


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60), st.integers(60, 100))
def test_plans_hold_every_piece(sizes, capacity):
    from collections import Counter

    lengths = Counter(sizes)
    before, after = packing.best_fit(lengths, capacity), None
    after = packing.local_search(before, capacity)
    assert sum(after.values()) <= sum(before.values()) and all(sum(b) <= capacity for b in after)
    for bins in (before, after):
        held = Counter()
        for b, n in bins.items():
            for x in b:
                held[x] += n
        assert held == lengths


def test_local_search_empties_a_bin():
    from collections import Counter

    # 6+3 | 4+4 | 3: exchanging 3 for 4 fills the first bin and makes room for the last 3 in the second
    assert sum(packing.local_search(Counter({(6, 3): 1, (4, 4): 1, (3,): 1}), 10).values()) == 2


def test_local_search_ends_without_an_exchange():
    from collections import Counter

    rng = random.Random(1)
    lengths = Counter(rng.randrange(700, 2001) for _ in range(1000))
    before = packing.best_fit(lengths)
    after = packing.local_search(before)
    under = sorted((b for b in after if sum(b) < 4096), key=sum)
    bound = -(-sum(k * n for k, n in lengths.items()) // 4096)
    assert bound <= sum(after.values()) < sum(before.values()) and sum((Counter({x: n for x in b for n in [b.count(x) * k]}) for b, k in after.items()), Counter()) == lengths
    assert sum(after.values()) == bound or not any(packing._steps(y, x, 4096) for i, x in enumerate(under) for y in under[i:] if x != y or after[x] > 1)


def test_id_files(rows, docs, spark, tmp_path):
    folder = f"file://{tmp_path}/ids"
    out = listed(idfiles.id_files(docs, WORDS, 2, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    want, at = [], 0
    for i, t in rows:
        ids = [*ids_of(t), 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert out == want
    manifest = idfiles.write_ids(docs, WORDS, 2, f"{folder}2")
    unknown = idfiles.read_ids(spark.createDataFrame([(3,), (10**6,), (-5,)], "doc_id long"), manifest, f"{folder}2")
    assert listed(unknown.fillna(-1), "doc_id", "n_tokens") == [(-5, -1), (3, want[3][2]), (10**6, -1)]


def test_small_shards(rows, docs, tmp_path, monkeypatch):
    whole = listed(idfiles.id_files(docs, WORDS, 2, f"file://{tmp_path}/whole"), "doc_id", "start", "n_tokens", "ids_crc32")
    monkeypatch.setattr(idfiles, "SHARD_IDS", 50)
    assert listed(idfiles.id_files(docs, WORDS, 2, f"file://{tmp_path}/ids"), "doc_id", "start", "n_tokens", "ids_crc32") == whole


def test_shards_that_begin_within_a_doc_id(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idfiles, "SHARD_IDS", 3)
    df = spark.createDataFrame([(7, f"some words {k}") for k in range(9)] + [(None, "no id"), (8, "last"), (None, None)], "doc_id long, text string")
    out = idfiles.id_files(df, WORDS, 2, f"file://{tmp_path}/ids").collect()
    assert len({r.start for r in out}) == 12 and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(-(2**62), 2**62), max_size=300))
def test_perfect_hash(ids):
    with pytest.raises(ValueError):
        mph.PerfectHash.build(np.array([5, 7, 5], np.uint64))
    keys = mph.keys_of(np.array(sorted(ids), np.int64), np.zeros(len(ids), np.int64))
    table, slots = mph.PerfectHash.build(keys)
    assert sorted(slots.tolist()) == list(range(len(ids))) and (table.find(keys) == slots).all()


# ---- 5 --------------------------------------------------------------------------------------------------------


def test_line_dedup(rows, docs):
    got = listed(lines.drop_common_lines(docs), "doc_id", "text", "n_lines", "n_cut")
    assert got == sorted(brute.lines(rows))
    assert any(r[3] for r in got) and lines.drop_common_lines(docs).columns == [*docs.columns, "n_lines", "n_cut"]


def test_most_of_what_any_earlier_document_has_goes(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = listed(lines.drop_common_lines(df), "doc_id", "text", "n_lines", "n_cut")
    assert got == brute.lines(rows) and sum(r[3] for r in got) >= 0.9 * sum(r[3] for r in brute.lines(rows, all_pairs=True)) > 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=9), st.lists(st.sampled_from("abcdef"), max_size=9), st.sampled_from([4, 1 << 28]))
def test_patience(a, b, table):
    lines.TABLE, before = table, lines.TABLE
    got = lines.patience(a, b)
    lines.TABLE = before
    if table > 4:
        assert got == brute.patience(a, b)
    assert all(a[i] == b[j] for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    assert lines.patience(a, a) == [(i, i) for i in range(len(a))]


def test_lines_that_occur_twice_are_aligned(monkeypatch):
    block, rng = list("pqr"), random.Random(6)
    assert lines.common_blocks([*block, "x", *block], ["y", *block, "z"], [9] * 5) == [(1, 3)]
    assert lines.common_blocks(["x", *block, "y"], ["v", *block, "w", *block, "z"], [9] * 9) in ([(1, 3)], [(5, 7)])
    for table in (1 << 28, 6):  # whole tables, and halves of them
        monkeypatch.setattr(lines, "TABLE", table)
        for _ in range(300):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
            got = lines.longest_common(a, b, 0, len(a), 0, len(b))
            assert len(got) == len(brute.longest_common(a, b)) and all(a[i] == b[j] for i, j in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


@pytest.mark.parametrize("copies", [50, 51, 1500])
def test_groups_of_copies_lose_all_but_one_whatever_their_size(spark, copies):
    text = "\n".join(f"this is line number {k} of the text" for k in range(6))
    df = spark.createDataFrame([(i, text) for i in range(copies)], "doc_id long, text string")
    assert listed(lines.drop_common_lines(df), "doc_id", "n_cut") == [(0, 0)] + [(i, 6) for i in range(1, copies)]


def test_large_groups_lose_their_common_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "PARTNERS", 9)
    text = "one two three four five six\nseven eight nine ten eleven\n"
    copies = [(i, text + "a line that only copies have got") for i in range(70)]
    others = [(i, f"own line number {i} comes first here\n" + text + f"own line number {i} of this document") for i in range(70, 150)]
    df = spark.createDataFrame(copies + others, "doc_id long, text string")
    assert listed(lines.drop_common_lines(df), "doc_id", "n_cut") == [(0, 0)] + [(i, 3) for i in range(1, 70)] + [(i, 2) for i in range(70, 150)]
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert sum(r.n_cut for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()) == 69 * 3 + 80 * 2


def test_rows_that_share_a_doc_id_lose_lines(spark):
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "twelve thirteen fourteen fifteen sixteen"
    rows = [(1, a), (2, a), (2, a), (2, f"{b}\n{c}"), (2, f"{c}\nx"), (3, b), (3, c), (3, "own words of this document only")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = listed(lines.drop_common_lines(df), "doc_id", "n_lines", "n_cut")
    assert got[:5] == [(1, 1, 0), (2, 1, 1), (2, 1, 1), (2, 2, 0), (2, 2, 0)]
    assert got == listed(lines.drop_common_lines(df.repartition(3)), "doc_id", "n_lines", "n_cut")


def test_a_block_meets_the_earliest_document_that_has_it_as_a_block(spark):
    one, two, three, short = "first line of the block", "second line of the block", "third line of the block", ["a b", "c d", "e f"]
    texts = ["\n".join(x) for x in ([two, "own 0", one], [three, "own 1", two], [one, two, three], ["own 3", one, two, three, "own 3 too"], short[::-1], short, ["own 6", *short], ["a b", "x 7"], ["c d", "x 8"], ["e f", "x 9"], ["own", *short])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(listed(lines.drop_common_lines(df), "doc_id", "n_cut"))
    assert got[3] == got[6] == got[10] == 3 and got == {r[0]: r[3] for r in brute.lines(list(enumerate(texts)))}


def test_keys_of_lines():
    rng = random.Random(4)
    for _ in range(300):
        words = [rng.randint(1, 7) for _ in range(rng.randrange(9))]
        spans = {(i, j) for j in range(len(words) + 1) for i in range(j)}
        enough = {x for x in spans if sum(words[slice(*x)]) >= 5}
        want = {(i, j) for i, j in spans if j - i <= 2 or (i, j) in enough and not {(i, j - 1), (i + 1, j)} <= enough}
        assert len(lines.keys_of(np.arange(len(words)), words)) == len(want)


# ---- 7 --------------------------------------------------------------------------------------------------------


def test_exact_groups(rows, docs):
    assert listed(exact.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(rows)


def test_texts_that_differ_late(spark):
    long = "Abc " * 3000
    rows = list(enumerate([long, long.upper(), long + "x", long[:-1], long, "Ä", "ä", long[:64], long[:512], long[:576], long[:576]]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert listed(exact.exact_groups(df), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(rows)


# ---- 8 --------------------------------------------------------------------------------------------------------


def test_scores_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").toPandas()
    test = out[out.held_out]
    assert set(out[~out.held_out].doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)) == {False}
    toxic, clean = test[test.toxic == 1].score.to_numpy(), test[test.toxic == 0].score.to_numpy()
    assert (toxic[:, None] > clean[None, :]).mean() + 0.5 * (toxic[:, None] == clean[None, :]).mean() > 0.95
    assert (test[test.predicted == 1].toxic == 1).mean() > 0.9 and (test[test.toxic == 1].predicted == 1).mean() > 0.75


def test_scores_against_sums_over_pairs(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    m = toxicity.train(docs, labels)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r.doc_id: r.score for r in toxicity.score(docs, m).collect()}
    weights = {int(b): (w, v) for b, w, v in zip(m.buckets, m.w, m.v)}
    assert len(weights) > 4
    for i, t in rows:
        words = {x.lower() for x in re.findall(rb"[A-Za-z\x80-\xff]+", (t or "").encode())}
        mine = [weights[b] for b in sorted({zlib.crc32(x) % toxicity.BUCKETS for x in words}) if b in weights]
        z = m.bias + sum(w for w, _ in mine) + sum(float(a[1] @ b[1]) for k, a in enumerate(mine) for b in mine[:k])
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_gradients():
    rng = np.random.default_rng(3)
    x = (rng.random((12, 7)) < 0.4).astype(float)
    labels, params = (rng.random(12) < 0.5).astype(float), [np.array([0.3]), rng.normal(size=7), rng.normal(size=(7, 3))]

    def loss(b, w, v):
        z = b[0] + x @ w + np.array([sum(r[i] * r[j] * (v[i] @ v[j]) for i in range(7) for j in range(i)) for r in x])
        return np.mean(np.log1p(np.exp(z)) - labels * z) + 0.01 / 2 * ((w**2).sum() + (v**2).sum())

    got = toxicity.Design(*np.nonzero(x), 12, 7).gradients(params, labels, 0.01)
    for k, p in enumerate(params):
        for at in np.ndindex(p.shape):
            ends = []
            for step in (1e-5, -1e-5):
                moved = [q.copy() for q in params]
                moved[k][at] += step
                ends.append(loss(*moved))
            assert abs((ends[0] - ends[1]) / 2e-5 - got[k][at]) < 1e-7


def test_every_telling_term_is_kept():
    terms, labels = [], []
    for i in range(4000):  # 1500 terms that only toxic documents have
        terms.append(np.array(sorted({toxicity.bucket(b"t%d" % (i * 7 % 1500 + k)) for k in range(5)}) if i % 2 else [toxicity.bucket(b"x%d" % (i % 40))], np.int32))
        labels.append(i % 2)
    assert len(toxicity.fit(terms, np.array(labels, float), steps=2).buckets) > 1100


def test_long_words_are_not_remembered():
    m = toxicity.fit([], np.zeros(0))
    c = bytebpe.codec(RANKS, P.PATTERN)
    for k in range(30):
        long = b"%d" % k + b"ab" * 5000
        m.score(long.translate(None, b"0123456789") + b"c" * k)
        c.pieces(long.decode())
    assert all(len(t) <= toxicity.LONG for t in m.known) and all(len(t) <= bytebpe.LONG for t in c.memo)


def test_pairs_of_terms_weigh_together():
    rng = random.Random(2)
    terms, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [b"w%d" % rng.randrange(50) for _ in range(5)] + [b"insult"] * a + [b"group"] * b
        terms.append(np.array(sorted({toxicity.bucket(w) for w in words}), np.int32))
        labels.append(a and b)
    m = toxicity.fit(terms, np.array(labels, float))
    assert m.score(b"insult group w1") > 0.6 and m.score(b"insult w1") < 0.4 and m.score(b"group w1") < 0.4 and m.score(b"w1") < 0.1


def test_without_labels_every_score_is_the_prior():
    m = toxicity.fit([], np.array([]))
    assert m.score(b"x") == m.score(b"") and 0 < m.score(b"") < 1


def test_only_the_text_counts(spark, docs):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    m = toxicity.train(docs, labels)
    moved = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string")})
    assert [s for _, s in listed(toxicity.score(docs, m), "doc_id", "score")] == [s for _, s in listed(toxicity.score(moved, m), "doc_id", "score")]


# ---- 9 --------------------------------------------------------------------------------------------------------


def test_token_counts(rows, docs):
    model = tokencount.counter(PIECES).model
    want = sorted((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows)
    assert listed(tokencount.token_counts(docs, PIECES), "doc_id", "n_bytes", "n_tokens") == want
    assert {r.over_limit for r in tokencount.token_counts(docs, PIECES, limit=100).collect()} == {True, False}


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=30), st.text(alphabet=" ▁a\nb.é<s>", max_size=30)))
def test_count_of_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    c, found = tokencount.counter(PIECES), tokencount.pretokens(text.encode())
    assert sum(c.pieces(found)) == len(c.model.encode(text))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**62), 2**62)), st.lists(st.integers(-(2**31), 2**31 - 1)), st.binary())
def test_packed_arrays(long, short, raw):
    got = tokencount.unpack(tokencount.pack(np.array(long, np.int64), np.array(short, np.int32), raw))
    assert got[0].tolist() == long and got[1].tolist() == short and got[2] == raw


def test_every_pretoken_is_counted_once(spark, docs, monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t]}) for i, t in enumerate([b"a b c a", b"c d", b"a d e", b""])]
    rows = [r for b in tokencount._blocks(batches, 2) for r in b.to_pylist()]
    words, asked = sorted((r for r in rows if r["part"] >= 0), key=lambda r: r["part"]), []
    c = tokencount.counter(PIECES)
    monkeypatch.setattr(c, "pieces", lambda new, f=c.pieces: asked.extend(new) or f(new))
    list(tokencount._count_parts([pa.RecordBatch.from_pylist(words, schema=tokencount.BLOCKS)], PIECES))
    assert sorted(asked) == [b"a", b"b", b"c", b"d", b"e"]


def test_blocks_of_any_size(rows, docs, monkeypatch):
    monkeypatch.setattr(common, "SLICE", 3000)
    monkeypatch.setattr(tokencount, "BLOCK", 3000)
    model = tokencount.counter(PIECES).model
    assert listed(tokencount.token_counts(docs, PIECES), "doc_id", "n_tokens") == sorted((i, len(model.encode(t or ""))) for i, t in rows)


# ---- 10 -------------------------------------------------------------------------------------------------------


def test_substrings(rows, docs):
    out = substrings.drop_repeats(docs)
    assert listed(out, "doc_id", "n_words", "n_removed", "text") == brute.substrings(rows)
    assert out.columns == [*docs.columns, "n_words", "n_removed"]


def test_hot_phrases(rows, docs, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_ROWS", 2)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    assert listed(substrings.drop_repeats(docs), "doc_id", "n_words", "n_removed", "text") == brute.substrings(rows)


def test_periodic_texts(spark):
    rows = [(1, "a b " * 60), (2, "b a " * 40 + "c " * 80), (3, "c " * 50), (4, "c " * 49), (5, "c " * 51)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert listed(substrings.drop_repeats(df), "doc_id", "n_words", "n_removed", "text") == brute.substrings(rows)


def test_only_what_the_automata_find_goes():
    found = list(substrings.Shard().occurrences(False))
    shard = substrings.Shard()
    words = [f"w{k}" for k in range(60)]
    for i, at in ((1, 0), (2, 3)):
        shard.add(7, i, i, at, 5, " ".join(words[: 52 + i]).encode())
    shard.add(7, 3, 3, 0, 5, " ".join(["x", *words[1:52]]).replace("w7", "y").encode())  # the same hash, other words
    got = [(row[0], windows) for found in shard.occurrences(False) for row, windows in found]
    assert found == [] and got == [(1, [0, 1, 2, 3]), (2, [0, 1, 2, 3, 4])]
    assert len([1 for found in shard.occurrences(True) for _ in found]) == 3


def test_slabs_of_long_texts(rows, docs, monkeypatch):
    words = [f"w{k % 700}".encode() for k in range(2000)]
    whole = list(substrings._slabs(words))
    monkeypatch.setattr(substrings, "SLAB", 97)
    parts = list(substrings._slabs(words))
    assert len(parts) > 20 and np.concatenate([p[3] for p in parts]).tolist() == whole[0][3].tolist() and [p[0] for p in parts] == list(range(0, 1951, 97))


def test_one_id_with_two_texts(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(1, a), (5, a), (5, b + " z"), (5, b + " z"), (7, b)], "doc_id long, text string")
    assert listed(substrings.drop_repeats(df), "doc_id", "n_removed") == [(1, 0), (5, 0), (5, 0), (5, 60), (7, 60)]


# ---- queries --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_against_sql(name, spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    canonical = lambda rows: sorted(tuple(map(repr, r)) for r in rows)
    assert canonical(map(tuple, df.select(*columns).collect())) == canonical(c.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall())
