"""The operators on small tables with NULLs, empty texts, ties, repeated rows and clashing names."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import hpylm
from starloom.llm.decontamination import benchmark_hits
from starloom.llm.hpylm import score_texts
from starloom.llm.jaccard import jaccard_components
from starloom.llm.licenses import license_scan
from starloom.llm.mixing import mix, source_targets, split_quotas
from starloom.llm.permutation_index import nearest
from starloom.llm.quality import resample
from starloom.llm.sharding import minimax_shards
from starloom.llm.token_counts import token_counts
from starloom.llm.token_files import crc_of_both, from_planes, read_digests, to_planes, write_ids

SCHEMA = "doc_id long, text string, lang string, source string, size long, id string, row long, n long"
LONG = " ".join(f"word{k % 977}" for k in range(30_000))
TEXTS = ["one two three four five six seven", None, "", "One  two\nthree four five six seven", "a b", "a b", LONG, "x" * 90_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", [None, "b", "a"][k % 3], 1, "x", 2, 3) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "null id", None, "a", None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def words(text):
    return text.encode().split() if text else []


def test_jaccard(spark, docs, nothing):
    found = sorted(map(tuple, jaccard_components(spark, docs).collect()), key=str)
    by_id = {row[0]: row[1:] for row in found}
    assert len(found) == 10 and by_id[0] == (3, 0) and by_id[3] == (3, 0) and by_id[1] == (0, 1) and by_id[2] == (0, 2)
    assert by_id[5] == (1, 4) and by_id[4] == (1, 4) and by_id[7] == (1, 7) and by_id[None] == (1, None)
    assert jaccard_components(spark, nothing).count() == 0


def test_mix(spark, docs, nothing):
    pieces = mix(spark, docs, block_words=64, shards=5).collect()
    taken, size, target = collections.Counter(), {}, {}
    for p in pieces:
        taken[p.row_index] += p.words
        size[p.row_index] = (p.source, p.size)
        target[p.source] = p.target
    assert len(size) == 10 and all(taken[k] <= 3 * n for k, (_, n) in size.items())
    for source, wanted in target.items():
        assert abs(sum(taken[k] for k, (s, _) in size.items() if s == source) - wanted) <= 0.5
    assert mix(spark, nothing).count() == 0


def test_targets_reshare_what_is_over(spark):
    sized = spark.createDataFrame([("a", 100), ("b", 1), ("c", 5)], "source string, size long")
    assert {r.source: round(r.target, 6) for r in source_targets(sized).collect()} == {"a": 88.0, "b": 3.0, "c": 15.0}


def test_split_keeps_quotas(spark):
    leaves = split_quotas(spark.createDataFrame([([50, 0, 7],)], "quota array<long>"), 6, 1).collect()
    assert len(leaves) == 6 and np.sum([r.quota for r in leaves], axis=0).tolist() == [50, 0, 7]
    assert all(9 <= sum(r.quota) <= 10 for r in leaves)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards(spark, docs, shards):
    rows = minimax_shards(spark, docs, shards).collect()
    assert len(rows) == 10
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id in (4, 5)}) == 1
    assert {r.text_crc32 for r in rows if r.doc_id == 0} == {zlib.crc32(TEXTS[0].encode())}


def test_shards_are_minimax(spark):
    sizes = np.random.default_rng(3).integers(1, 400, 3000).tolist()
    table = spark.createDataFrame([(k, f"{k} " + "x" * n) for k, n in enumerate(sizes)], "doc_id long, text string")
    groups = [len(f"{k} ") + n + 16 for k, n in enumerate(sizes)]

    def need(capacity):
        n, full = 1, 0
        for size in groups:
            n, full = (n + 1, size) if full + size > capacity else (n, full + size)
        return n

    low, high = max(groups), sum(groups)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if need(middle) <= 7 else (middle + 1, high)
    by_shard = minimax_shards(spark, table, 7).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(by_shard) == 7 and max(r.n for r in by_shard) <= low


def test_shards_of_nothing(spark, nothing):
    assert minimax_shards(spark, nothing, 4).count() == 0


def test_tokens(spark, docs, nothing):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    counts = {r.doc_id: r for r in token_counts(spark, docs, "word_bpe_49k.json", chunk_chars=4000, overlap=40).collect()}
    assert all(counts[k].n_tokens == len(x) and counts[k].over_limit == (len(x) > 2048) for k, x in enumerate(ids))
    assert counts[1].n_bytes == 0 and len(counts) == 9 and token_counts(spark, nothing, "word_bpe_49k.json").count() == 0
    for bits in (False, True):
        found = read_digests(write_ids(spark, docs, "word_bpe_49k.json", 1, bits=bits, parts=3)).collect()
        crcs = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in found}
        assert len(found) == 10
        assert all(crcs[k] == (len(x) + 1, zlib.crc32(np.array([*x, 1], "<u4").tobytes())) for k, x in enumerate(ids))
        order = sorted(found, key=lambda r: r.start)
        assert [r.start for r in order] == np.cumsum([0, *[r.n_tokens for r in order[:-1]]]).tolist()
    assert read_digests(write_ids(spark, nothing, "word_bpe_49k.json", 1)).count() == 0


def test_planes_and_checksums():
    ids = np.random.default_rng(0).integers(0, 1 << 32, 1001).astype("<u4")
    for bits in (False, True):
        assert (from_planes(to_planes(ids, bits), len(ids), bits) == ids).all()
    assert crc_of_both(zlib.crc32(b"abc"), zlib.crc32(b"defgh"), 5) == zlib.crc32(b"abcdefgh")


def test_decontamination(spark, docs, nothing):
    items = [(1, "THREE, four"), (2, None), (3, ""), (4, "zzz"), (4, "zzz"), (None, "one two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in benchmark_hits(spark, docs, benchmark).collect()}
    assert (found[3].n_words, found[3].n_hit, found[3].n_items, found[3].contaminated) == (7, 2, 1, True)
    assert [TEXTS[3].encode()[s.begin : s.end] for s in found[3].spans] == [b"three four"]
    assert found[1].n_words == 0 and not found[6].contaminated
    assert benchmark_hits(spark, nothing, benchmark).count() == 0
    assert not any(r.contaminated for r in benchmark_hits(spark, docs, benchmark.limit(0)).collect())


def test_quality(spark, docs, nothing):
    clean = [(k, f"the cat {k % 7} sat on the mat today") for k in range(300)]
    junk = [(1000 + k, f"idiot### cat$$$ {k % 7}### fool&&&") for k in range(100)]
    table = spark.createDataFrame(clean + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 1000), 0) for k, _ in clean + junk], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in resample(spark, table, labels).collect()} == {k for k, _ in clean}
    assert resample(spark, docs, labels.limit(0)).count() == 10 and resample(spark, nothing, labels).count() == 0


def test_scores(spark, docs, nothing):
    rows = score_texts(spark, docs).collect()
    assert len(rows) == 10 and all(r.n_tokens == len(words(TEXTS[r.doc_id])) + 1 for r in rows if r.doc_id is not None)
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows) and score_texts(spark, nothing).count() == 0
    assert sum(r.n_tokens for r in rows if not r.held_out) == rows[0].train_tokens


def test_scores_of_split_blocks(spark, docs, monkeypatch):
    whole = sorted(score_texts(spark, docs).collect(), key=str)
    monkeypatch.setattr(hpylm, "SPLIT_TOKENS", 10)
    split = sorted(score_texts(spark, docs).collect(), key=str)
    assert [r[:5] for r in split] == [r[:5] for r in whole]
    assert np.allclose([r.score for r in split], [r.score for r in whole])


def test_nearest(spark):
    random = np.random.default_rng(0)
    vectors = [(k, random.normal(size=8).tolist()) for k in range(300)] + [(1000 + k, [1.0] * 8) for k in range(50)]
    odd = [(2001, None), (2002, [0.0] * 8), (2003, [float("nan")] * 8), (2004, [None] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    found = nearest(spark, table, F.col("vec_id") % 20 == 0, k=5)
    hits = total = 0
    by_query = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: r.rank):
        by_query[r.query_id].append(r.vec_id)
    everything = np.array([v for _, v in vectors])
    for k, v in vectors:
        if k % 20 == 0:
            order = sorted((-float(s), i) for (i, _), s in zip(vectors, everything @ np.array(v), strict=True) if i != k)
            hits += len({i for _, i in order[:5]} & set(by_query[k]))
            total += 5
    assert hits >= 0.9 * total and by_query[1000] and set(by_query) == {k for k, _ in vectors if k % 20 == 0}
    assert nearest(spark, table.limit(0), F.lit(True)).count() == 0


def test_licenses(spark, docs):
    files = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x", "text"), (3, "a/b/c/y", "Licensed under CC BY 4.0\nmore")]
    files += [(4, "z", None), (5, None, ""), (6, "q/z", "the license"), (2, "a/b/x", "text")]
    table = spark.createDataFrame(files, "doc_id long, path string, text string")
    found = {r.doc_id: r for r in license_scan(spark, table, F.col("path"), F.col("path").endswith("LICENSE")).collect()}
    assert (found[1].own_license, found[2].license, found[2].inherited_from, found[3].license) == ("MIT", "MIT", "a", "CC-BY-4.0")
    assert found[4].license is None and found[5].license is None and found[6].license is None


def brute_components(rows, percent=75):
    """Component of each row by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        found = (text or "").encode().lower().split()
        k = min(5, len(found))
        sets.append({tuple(found[i : i + k]) for i in range(len(found) - k + 1)} if found else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (name, _) in enumerate(rows):
        least[find(i)].append(name)
    return [(name, len(sets[i]), min(least[find(i)]) if sets[i] else name) for i, (name, _) in enumerate(rows)]


def edge_cases():
    """Families of texts around the threshold, copies within and across batches, and passages that many share."""
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(10**6)}"
    passage = [word() for _ in range(40)]
    texts = []
    for family in range(25):
        # Two sets of n + k tokens with n in common: n / (n + 2k) is 0.75 for n = 6k.
        k = 2 + family % 3
        common = [word() for _ in range(6 * k + 4)]
        texts += [" ".join(common + [word() for _ in range(k + extra)]) for extra in (0, 0, 1, -1)]
        texts += [texts[-1], texts[-2].upper()]
        texts.append(" ".join(passage + [word() for _ in range(60 + family)]))
    texts += ["same text again and again for ever"] * 40 + [None, "", "short one", "short  ONE", LONG, LONG + " tail"]
    return [(int(i), texts[k]) for k, i in enumerate(rng.permutation(len(texts)))]


@pytest.mark.parametrize(("batch", "part_bytes"), [("10000", 24 << 20), ("7", 300)])
def test_jaccard_against_all_pairs(spark, monkeypatch, settings, batch, part_bytes):
    from starloom.llm import jaccard

    monkeypatch.setattr(jaccard, "PART_BYTES", part_bytes if part_bytes > 1000 else 20_000)
    settings(spark__sql__execution__arrow__maxRecordsPerBatch=batch)
    rows = edge_cases()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(map(tuple, jaccard_components(spark, df).collect()))
    wanted = sorted(brute_components(rows))
    assert any(a[0] != a[2] for a in wanted) and found == wanted


def test_jaccard_tokens_in_order_pack_small():
    from starloom.llm import jaccard

    tokens = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 50_000).astype(np.uint64))
    for some in (tokens, tokens[:1], tokens[:0], np.array([0, 0, (1 << 48) - 1], np.uint64)):
        assert jaccard._unpack_sorted(jaccard._pack_sorted(some)).tolist() == some.tolist()
    # Of six bytes of a token the upper planes are hardly more than zeros.
    assert len(zlib.compress(jaccard._pack_sorted(tokens), 1)) < 5.2 * len(tokens) < len(zlib.compress(jaccard._pack(tokens), 1))
    shared = np.zeros(3, jaccard._SHARED)
    shared["owner"], shared["rarity"], shared["token"] = [7, 65_535, 0], [255, 4, 8], [0, 5, (1 << 48) - 1]
    packed = jaccard._pack_shared(shared)
    assert len(packed) == 27 and jaccard._unpack_shared(packed).tolist() == shared.tolist()
