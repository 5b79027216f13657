"""Tree concatenation, centroid clustering and source divergence against the library and brute force, and on awkward tables."""

import glob
import hashlib
import itertools
import os
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import centroids, divergence, merges, perfect_hash, queries, remembered, token_files, toxicity, vectors
from tarmac.llm.ship import ship

WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def codec():
    return merges.Codec(WORDS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def same_ids(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts)):
        found = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == found, text[:100]
        assert codec.decode(ids) == library.decode(found, skip_special_tokens=False)


def symbols_of(codec, word):
    raw = list(word.encode())
    return [*codec.inner[raw[:-1]].tolist(), int(codec.final[raw[-1]])]


def test_ids_of_mixed_texts(codec, library):
    draw = random.Random(1)
    letters = [*"abtheing \n\té漢😀ÀΣİ ́k12.,'s!_-\x1c\x85 ſ²º", "<|endoftext|>", "<|startoftext|>", "'ll", "ing", "the"]
    same_ids(codec, library, ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(2000)])
    same_ids(codec, library, ["", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>b", " <|endoftext|> ", "it's O'Neill's"])


def test_ids_of_every_character(codec, library):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    blocks = ["a".join(points[k : k + 128]) + " x" + " ".join(points[k : k + 128]) for k in range(0, len(points), 128)]
    wanted = library.encode_batch(blocks, add_special_tokens=False)
    assert all(ids.tolist() == want.ids for ids, want in zip(codec.encode(blocks), wanted))


@pytest.mark.parametrize("alphabet", ["abtheingos", "a", "ab", "ha", "=-", "漢字", "!"])
def test_long_unsplit_text_is_joined_exactly(codec, library, alphabet):
    draw = random.Random(2)
    same_ids(codec, library, ["".join(draw.choices(alphabet, k=draw.randrange(1, 900))) for _ in range(60)])
    same_ids(codec, library, [alphabet * 20_000])


def test_side_by_side_is_merging_one_by_one(codec):
    draw = np.random.default_rng(3)
    sequences = [symbols_of(codec, "".join(draw.choice(list("then ing"), n))) for n in draw.integers(1, 60, 300)]
    assert codec.merger.merged(sequences) == [codec.merger.by_heap(s) for s in sequences]


def test_joining_agrees_with_merging_the_whole(codec):
    draw = np.random.default_rng(4)
    for n in draw.integers(2, 200, 100):
        symbols = symbols_of(codec, "".join(draw.choice(list("theinga"), n)))
        cut = int(draw.integers(1, n))
        halves = [codec.merger.by_heap(symbols[:cut]), codec.merger.by_heap(symbols[cut:])]
        assert codec.merger.joined([tuple(halves)]) == [codec.merger.by_heap(symbols)]


def test_forgetting_changes_no_ids(library):
    small = merges.Codec(WORDS)
    small.LIMIT = 3
    texts = [f"word{k % 7} and others, {k}" for k in range(50)]
    for _ in range(2):
        for text in texts:
            same_ids(small, library, [text])
    assert len(small.known) < 20 and len(small.pieces) < 20


def test_other_kinds_of_files_are_refused(tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"model": {"type": "Unigram", "vocab": []}}')
    with pytest.raises(ValueError, match="byte-pair"):
        merges.Codec(str(path))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and a clashing extra column."""
    ship(spark)
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (None, "a b c d e f", "en", "a", 11), (4, "x" * 70_000 + " one two" * 3000, "en", "a", 1),
        (5, "x@y.org is mine", "en", "a", 15), (5, "x@y.org is mine", "en", "a", 15), (7, " \n\t ", None, "b", 4),
        (8, "é漢😀 ÀB Àb <|endoftext|>", "en", "b", 3), (9, "a b c d e f", "fr", None, 11),
    ]
    return spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("mine")).withColumn("term", F.lit(1))


def test_merges_on_awkward_and_empty_tables(spark, awkward, library):
    rows = merges.spelt(awkward, WORDS).collect()
    wanted = sorted([(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in awkward.collect()], key=repr)
    assert sorted([(r.doc_id, r.ids) for r in rows], key=repr) == wanted
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    assert merges.spelt(spark.createDataFrame([], DOCS), WORDS).count() == 0


def test_merges_query_equals_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_merges"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), decoded)]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), *digests)


# --- Centroids ---------------------------------------------------------------------------


def lloyd(rows, k=8, rounds=10):
    """vec_id, cluster and distance of each kept vector in whole numbers, plainly."""
    kept = [
        (i, [floor(1024 * Fraction(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    middles = [v for _, v in first]

    def nearest(v):
        return min((sum((x - m) ** 2 for x, m in zip(v, middle)), c) for c, middle in enumerate(middles))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        middles = [[sum(d) // len(groups[c]) for d in zip(*groups[c])] if groups[c] else m for c, m in enumerate(middles)]
    return sorted([(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], key=repr) if middles else [], middles


def clusters_of(spark, rows, **more):
    found, middles = centroids.clustered(spark.createDataFrame(rows, VECTORS).withColumn("v", F.lit(1)).withColumn("cluster", F.lit("x")), **more)
    return sorted([tuple(r) for r in found.collect()], key=repr), middles


@pytest.mark.parametrize("block", [1, 4, 10, 64])
def test_clusters_equal_brute_force(spark, block):
    ship(spark)
    draw = np.random.default_rng(block)
    centres = draw.normal(size=(5, 64))
    vectors = (centres[draw.integers(0, 5, 120)] + 0.3 * draw.normal(size=(120, 64))).astype(np.float32).tolist()
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(200 + i, vectors[0], 1) for i in range(40)]
    got, middles = clusters_of(spark, rows, block=block)
    want, wanted = lloyd([r[:2] for r in rows])
    assert got == want and middles.tolist() == wanted


def test_clusters_on_awkward_tables(spark):
    ship(spark)
    same = [0.5] * 64
    odd = [
        (1, None, 1), (2, [], 1), (3, [1.0] * 63, 1), (4, [float("nan")] + same[1:], 1), (5, [float("inf")] + same[1:], 1),
        (6, [None] + same[1:], 1), (7, [1.0] * 65, None),
    ]
    rows = [*odd, (10, same, 1), (10, same, 1), (11, [-0.5] * 64, None), (None, [-0.4] * 64, 2), (12, [0.0] * 64, 1)]
    got, middles = clusters_of(spark, rows)
    want, wanted = lloyd([r[:2] for r in rows])
    assert got == want and middles.tolist() == wanted and len(got) == 5
    assert clusters_of(spark, odd)[0] == [] and clusters_of(spark, [(None, same, 1)])[0] == []
    found = centroids.with_inertia(*centroids.clustered(spark.createDataFrame(odd, VECTORS)))
    assert found.count() == 0
    with pytest.raises(Exception, match="beyond"):
        clusters_of(spark, [(1, [1e9] * 64, 1)])


def test_chunks_lose_nothing():
    draw = np.random.default_rng(7)
    vectors = draw.integers(-3, 3, (500, 10))
    chunk = centroids.Chunk.of(pa.array(range(500)), vectors, 4)
    row = chunk.row()
    again = centroids.Chunk.from_row(chunk.ids, row["sizes"], row["subvectors"], row["codes"], 10, 4)
    assert (np.concatenate([d[c] for d, c in zip(again.dictionaries, again.codes)], axis=1) == vectors).all()
    middles = draw.integers(-3, 3, (4, 10))
    cluster, distance = again.nearest(middles)
    apart = ((vectors[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (cluster == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    assert (again.sums(cluster, 4) == [vectors[cluster == c].sum(axis=0) for c in range(4)]).all()


# --- Divergence --------------------------------------------------------------------------


def audit(rows, least=10):
    """The rows of the audit by plain counting, in whole numbers."""
    terms = [
        (lang or "", source or "", re.findall(r"[^\x00-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for text, lang, source in rows
    ]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in terms:
        seen[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        sources = [s for other, s in counts if other == lang]

        def shares(found):
            total = sum(found[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (found[t] + 2) // total for t in kept}

        by_source = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            p = by_source[s]
            pairs = [(-sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept), o.encode(), o) for o, q in by_source.items() if o != s]
            best = [(-((p[t] - whole[t]) ** 2 // (p[t] + whole[t])), t.encode(), t) for t in kept if counts[lang, s][t] and p[t] > whole[t]]
            out += [(lang, s, "pair", item, -f, k) for k, (f, _, item) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", item, -f, k) for k, (f, _, item) in enumerate(sorted(best)[:10], 1)]
    return sorted(out)


def audited(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("value", F.lit("x"))
    return sorted(tuple(r) for r in divergence.audited(docs.withColumn("rank", F.lit(1))).collect())


def texts(seed, n=300):
    draw = random.Random(seed)
    words = ["The", "the", "Élan", "élan", "漢字", "x-ray", "don't", "aB", "ſ", "z\x00q", *(f"w{chr(97 + k)}" for k in range(26))]
    return [
        (" ".join(draw.choices(words, k=draw.randrange(12))), draw.choice(["en", "de", None]), draw.choice(["a", "b", "B", "é", None]))
        for _ in range(n)
    ]


def test_audit_equals_counting(spark):
    ship(spark)
    rows = [*texts(1), (None, "en", "empty"), ("", "xx", "one"), ("rare", "xx", "two"), ("!!", "yy", None), *[("tie tied", "zz", s) for s in "ab" for _ in range(10)]]
    assert audited(spark, rows) == audit(rows)


def test_audit_in_several_shards_passes_and_blocks(spark, monkeypatch):
    ship(spark)
    for name, value in (("SHARD", 5), ("AT_ONCE", 700), ("CELLS", 8), ("HELD", 6), ("SLICE", 300)):
        monkeypatch.setattr(divergence, name, value)
    rows = [*texts(2), ("word " * 5000, "en", "a")]
    assert audited(spark, rows) == audit(rows)


def test_audit_of_awkward_and_empty_tables(spark, awkward):
    got = sorted(tuple(r) for r in divergence.audited(awkward).collect())
    assert got == audit([(r.text, r.lang, r.source) for r in awkward.collect()])
    assert divergence.audited(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_stay_exact_for_large_counts():
    counts, total, kept = np.array([10**12, 3, 0]), np.array(10**13 + 7), 10**6
    got = divergence.shares(counts, total, kept).tolist()
    assert got == [1 + 10**9 * (int(c) + 2) // (int(total) + 2 * kept) for c in counts]


def test_perfect_hashes_know_their_words(monkeypatch):
    words = [f"word{k}".encode() for k in range(5000)]
    sizes, levels, by_slot = perfect_hash.build(words + words[:7])
    perfect = perfect_hash.PerfectHash(sizes, levels, pa.array(by_slot, pa.large_binary()))
    asked = words + [f"other{k}".encode() for k in range(5000)]
    slots = perfect.slots(pa.array(asked, pa.large_binary()), perfect_hash.hashes(asked))
    assert sorted(slots[:5000]) == list(range(5000)) and (slots[5000:] == -1).all()
    assert [by_slot[s] for s in slots[:5000]] == words
    # words with equal hashes are told apart by name
    monkeypatch.setattr(perfect_hash.xxhash, "xxh3_64_intdigest", lambda w: len(w))
    sizes, levels, by_slot = perfect_hash.build([b"a", b"b", b"ccc"])
    perfect = perfect_hash.PerfectHash(sizes, levels, pa.array(by_slot, pa.large_binary()))
    asked = [b"a", b"b", b"ccc", b"d", b"eee"]
    slots = perfect.slots(pa.array(asked, pa.large_binary()), perfect_hash.hashes(asked))
    assert sorted(slots[:3]) == [0, 1, 2] and slots[3:].tolist() == [-1, -1]
    assert perfect_hash.build([]) == ([], [], [])


# --- Memory ------------------------------------------------------------------------------


def test_caches_of_another_operator_are_emptied():
    cache = {"a": 1}
    remembered.kept_for("one", cache.clear)
    remembered.begin("one")
    assert cache
    remembered.begin("two")
    assert not cache


def test_ranges_by_size():
    assert list(remembered.by_size([1, 1, 5, 1, 1, 1], 3)) == [(0, 2), (2, 3), (3, 6)]
    assert list(remembered.by_size([], 3)) == []


# --- SQL ---------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_agree_with_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    want = con.sql(queries.ORACLE[name]).select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert got and sorted(got, key=repr) == sorted(want, key=repr)


# --- Operators of earlier rounds ---------------------------------------------------------


def test_restoring_finds_the_cheapest_way_through_the_lattice():
    """The search over the last two symbols against all ways through short lattices."""
    draw = np.random.default_rng(6)
    costs = draw.random((toxicity.N_SYMBOLS,) * 3).astype(np.float32) * 5

    def cost(letters):
        total, x, y = 0.0, 0, 0
        for letter in letters:
            z = toxicity.CODES.get(letter, 1)
            total, x, y = total + float(costs[x, y, z]), y, z
        return total + float(costs[x, y, 0])

    for _ in range(150):
        word = "".join(draw.choice(list("ab1340@$.-t"), draw.integers(1, 8)))
        ways = itertools.product(*toxicity.lattice(word))
        every = {}
        for way in ways:
            said = "".join(letters for letters, _ in way)
            every[said] = min(every.get(said, np.inf), cost(said) + sum(extra for _, extra in way))
        best = toxicity.restored(word, costs)
        assert every[best] == pytest.approx(min(every.values()), abs=1e-3), word


def test_token_files_of_empty_and_repeated_rows(spark, awkward, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    nothing = token_files.write_token_files(spark.createDataFrame([], DOCS), str(tmp_path / "none"), path)
    assert token_files.read_token_files(nothing, str(tmp_path / "none")).count() == 0
    files = token_files.write_token_files(awkward, str(tmp_path / "some"), path)
    library = Tokenizer.from_file(path)
    got = sorted(np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_token_files(files, str(tmp_path / "some")).collect())
    assert got == sorted([*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in awkward.collect())


def test_vectors_of_other_lengths_without_ids_and_repeated(spark):
    ship(spark)
    a, b = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [
        (1, a, 0), (2, b, 0), (3, a, 1), (4, [1.0, 0.0], 0), (5, [1.0, 0.05], 0), (6, None, 0), (7, [0.0, 0.0], 0),
        (8, [float("nan"), 1.0], 0), (9, a, None), (10, [None, 1.0], 0), *[(20 + k, [0.0, 1.0, 0.0], 0) for k in range(30)],
    ]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    alone = {k: (0, k, True) for k in (3, 6, 7, 8, 9, 10)}
    pairs = {1: (1, 1, True), 2: (1, 1, False), 4: (1, 4, True), 5: (1, 4, False)}
    assert got == alone | pairs | {20 + k: (29, 20, k == 0) for k in range(30)}
