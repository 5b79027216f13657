"""The numbered operators against brute force, the libraries, and awkward tables."""

import re
import subprocess
import sys
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarmac.llm import (
    bagminhash,
    components,
    encode,
    language_model,
    measure,
    packing,
    pieces,
    private_data,
    rules,
    token_files,
    toxicity,
    vectors,
    weak_labels,
)
from tarmac.llm.queries import QUERIES
from tarmac.llm.ship import ship

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "one two three four five six seven eight nine ten " * 3000


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and a clashing extra column."""
    ship(spark)
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (None, "a b c d e f", "en", "a", 11), (4, LONG, "en", "a", 1),
        (5, "x@y.org is mine", "en", "a", 15), (5, "x@y.org is mine", "en", "a", 15), (7, " \n\t ", None, "b", 4),
        (8, "é漢😀 +1 (988) 555-2485", "en", "b", 3), (9, "a b c d e f", "en", "a", 11),
    ]
    return spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("mine")).withColumn("score", F.lit(1))


@pytest.fixture(scope="module")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, empty):
    assert rules.ledger(empty).count() == 0
    assert bagminhash.near_duplicates(empty).count() == 0
    assert private_data.find(empty).count() == 0
    assert private_data.redacted(empty).columns == empty.columns
    assert packing.packed(empty, BPE).count() == 0
    assert pieces.encoded(empty, PIECES).count() == 0
    assert language_model.scored(*language_model.fit(empty)).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(empty, labels).score("fine") == pytest.approx(toxicity.LEAK)
    _, scorer = weak_labels.fit(empty)
    assert scorer.bad(["", "some words"]).max() < 0.5


def test_awkward_tables(spark, awkward, tmp_path):
    assert rules.ledger(awkward).count() == 9
    classes = sorted(map(tuple, bagminhash.near_duplicates(awkward).collect()), key=repr)
    assert classes == sorted([(1, 1), (2, 1), (None, 9), (4, 4), (5, 5), (5, 5), (7, 7), (8, 8), (9, 9)], key=repr)
    assert bagminhash.deduplicated(awkward).columns == awkward.columns
    masked = {r.doc_id: r.text for r in private_data.redacted(awkward).collect()}
    assert masked[1] is None and masked[5] == "<EMAIL> is mine" and masked[8] == "é漢😀 <PHONE>"
    found = pieces.decoded(pieces.encoded(awkward, PIECES), PIECES).collect()
    assert sorted((r.text for r in found)) == sorted(r.text or "" for r in awkward.collect())
    rows = {r.doc_id: r for r in language_model.scored(*language_model.fit(awkward)).collect()}
    assert rows[1].n_tokens == 0 and rows[1].pseudo_perplexity is None and rows[4].n_tokens == 30_000
    files = token_files.write_token_files(awkward, str(tmp_path / "t"), BPE)
    assert token_files.read_token_files(files, str(tmp_path / "t")).count() == 9
    labels = spark.createDataFrame([(1, None, None), (4, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(awkward, labels)
    assert awkward.select(toxicity.toxic_score(spark, model)("text").alias("s")).where("s between 0 and 1").count() == 9


def test_units_give_the_ids_of_whole_texts():
    library = Tokenizer.from_file(BPE)
    random = np.random.default_rng(1)
    letters = list("ab  \n\t\r.,!'s1é漢\x1c\x85\xa0​<|endoftext|>")
    texts = ["".join(random.choice(letters, random.integers(0, 40))) for _ in range(2000)] + ["<|endoftext|> x", "don't  we'll\n\n x "]
    texts += ["<|endoftext|>", "<|endoftext|><|endoftext|>", "in<|endoftext|>side", " <|endoftext|>  \n", "a <|endoftext|> b", "<|endof text|>"]
    for text, ids in zip(texts, encode.Encoder(BPE, 0).encode(texts)):
        assert np.frombuffer(ids, encode.ID).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text


def test_token_files(spark, tmp_path):
    ship(spark)
    docs = spark.createDataFrame([(i * 3, f"document {i} " * (i % 7)) for i in range(200)], "doc_id long, text string").repartition(5)
    path = str(tmp_path / "tokens")
    files = token_files.write_token_files(docs, path, BPE)
    rows = sorted(token_files.read_token_files(files, path).collect())
    whole = b"".join(r.ids for r in rows)
    assert [r.doc_id for r in rows] == [i * 3 for i in range(200)]
    assert all(whole[4 * r.start : 4 * r.start + len(r.ids)] == r.ids for r in rows)
    some = token_files.read_token_files(files, path, only=[30, 31, 300]).collect()
    assert {r.doc_id: r.ids for r in some} == {r.doc_id: r.ids for r in rows if r.doc_id in (30, 300)}
    one = files.orderBy("part").first()
    raw = (tmp_path / "tokens" / one.file.rsplit("/", 1)[1]).read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert plain == whole[: 4 * one.n_tokens]  # any tool can read the file

    class Damaged:
        data = raw[:9] + bytes([raw[9] ^ 1]) + raw[10:]

        def size(self):
            return len(self.data)

        def read_at(self, n, offset):
            return self.data[offset : offset + n]

    with pytest.raises(Exception):
        token_files.Reader(Damaged()).content(0)


def test_pieces_are_those_of_the_library():
    model = pieces.Model(PIECES)
    random = np.random.default_rng(5)
    letters = list("abtheing \n\té漢漣😀▁  12.,")
    texts = ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(1500)] + ["", " x", "x ", "a" * 300]
    unigram = bytearray(model.library.serialized_model_proto())
    spec = bytes(dict(pieces.fields(bytes(unigram)))[pieces.TRAINER_SPEC])
    at = unigram.find(spec) + spec.find(bytes([pieces.MODEL_TYPE << 3, pieces.BPE])) + 1
    unigram[at] = pieces.UNIGRAM
    ids = [model.encode(t) for t in texts]
    assert [np.frombuffer(i, encode.ID).tolist() for i in ids] == model.library.encode(texts)
    assert [model.decode(i) for i in ids] == model.library.decode(model.library.encode(texts))
    # as a unigram model: no spelling that the library finds scores better
    own = pieces.Model(proto=bytes(unigram))
    for text in (" ".join("".join(random.choice(list("abtheing"), 5)) for _ in range(6)) for _ in range(300)):
        mine, theirs = np.frombuffer(own.encode(text), encode.ID).tolist(), own.library.encode(text)
        assert sum(own.scores[i] for i in mine) >= sum(own.scores[i] for i in theirs)
        assert own.decode(np.array(mine, encode.ID).tobytes()) == text
    assert (model.kind, own.kind) == (pieces.BPE, pieces.UNIGRAM)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def brute_spans(text):
    def passes(kind, m):
        digits = [int(c) for c in m if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            doubled = sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(reversed(digits)))
            return 12 <= len(digits) <= 19 and doubled % 10 == 0
        return kind != "phone" or 9 <= len(digits) <= 15

    spans = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE) for m in re.finditer(p, text) if passes(kind, m.group())]
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(spans))


def test_fixed_patterns(spark):
    texts = [
        "a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "x@y", "4111 1111 1111 1111", "4111-1111-1111-1111 2", "+1 (988) 555-2485.",
        "1" * 5000, "a." * 6000 + "@", "1-" * 9000, "+" + "1 " * 9000, "é4111111111111111ü", "000000255.1.1.1", "1.1.1.256", "",
        "a@b.c@d.e@f.g", "user.name@x-.y..z@q.w", "12 4111111111111111", "4111111111111111 1", "😀 a@b.co 😀 1.2.3.4", "@@a@b.c.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = dict(df.select("i", private_data.written(private_data.spans(F.col("text")))).collect())
    assert [got[i] for i in range(len(texts))] == [brute_spans(t) for t in texts]


def test_identifiers_are_learnt_from_their_context(spark):
    rows = [(i, f"note {i}z then my e-mail is u{i}@mail.example.com thanks") for i in range(50)]
    rows += [(100 + i, f"it cost me {i * 37} coins") for i in range(50)] + [(500, "so my e-mail is joe7-at-home thanks")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    added = private_data.find(docs).where("size(spans) > size(base)").collect()
    assert [(r.doc_id, len(r.spans)) for r in added] == [(500, 1)]
    plan = private_data.redacted(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_identifiers_of_several_groups_are_learnt(spark):
    def card(i):
        body = f"4111{i:04d}1234{i * 7 % 1000:03d}"
        doubled = sum(sum(divmod(2 * int(c), 10)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(body)))
        digits = f"{body}{-doubled % 10}"
        return " ".join(digits[k : k + 4] for k in range(0, 16, 4))

    rows = [(i, f"note {i}z you can phone me on: +1 ({200 + i}) 555-{1000 + i * 13}, or not") for i in range(50)]
    rows += [(100 + i, f"please pay with card {card(i)} by noon") for i in range(50)]
    rows += [(200 + i, f"it cost me {i * 37} coins") for i in range(50)]
    rows += [(500, "and phone me on: (020) 7946 0018, or not"), (501, "I pay with card 4111 1111 1111 1112 by noon"), (502, "phone me on: 020 7946 0018. 12 do")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in private_data.find(docs).collect()}
    texts = dict(rows)
    added = {i: [(texts[i][s.start : s.end], private_data.KINDS[s.kind]) for s in r.spans if s not in r.base] for i, r in got.items()}
    want = {500: [("(020) 7946 0018", "phone")], 501: [("4111 1111 1111 1112", "card")], 502: [("020 7946 0018", "phone")]}
    assert {i: a for i, a in added.items() if a} == want
    edges = private_data.scanned(docs).selectExpr("inline(mentions)").where("kind >= 0")
    assert {r.kind: r.n for r in edges.groupBy("kind").agg(F.countDistinct("value").alias("n")).collect()} == {2: 50, 3: 50}


def test_vectors_against_all_pairs(spark):
    ship(spark)
    random = np.random.default_rng(3)
    centres = random.normal(size=(12, 24))
    x = np.concatenate([centres[random.integers(0, 12, 500)] + random.normal(0, 0.12, (500, 24)), random.normal(size=(100, 24))]).astype("f4")
    x[7] = x[8]
    labels = [int(v) for v in random.integers(0, 2, 600)]
    labels[7] = labels[8]
    rows = [(i, x[i].tolist(), labels[i], i) for i in range(600)]
    rows += [(700, None, 1, 0), (701, [0.0] * 24, 1, 0), (702, [float("nan")] * 24, 1, 0), (703, x[0].tolist(), None, 0), (704, [None] * 24, 1, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == labels)
    np.fill_diagonal(link, False)
    found, true = sum(got[i].n_links for i in range(600)), link.sum()
    assert 0.9 * true <= found <= true and all(got[i].n_links <= link[i].sum() for i in range(600))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(700, 705))
    assert got[7].component_id == got[8].component_id


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 100), (7, 7), (None, 3)] + [(200, k) for k in range(201, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(1, 41)} | {100: 60} | {k: 200 for k in range(201, 300)}


@pytest.mark.parametrize("counts", [{1024: 5, 512: 7, 3: 1}, {700: 9, 300: 9, 24: 9}, {1: 5000}, {}])
def test_combinations_use_up_the_counts(counts):
    used, bins = Counter(), 0
    for times, chosen in packing.combinations(counts):
        assert sum(n * length for length, n in chosen.items()) <= 1024
        bins += times
        for length, n in chosen.items():
            used[length] += times * n
    assert used == Counter(counts)
    assert bins <= 1 + -(-sum(a * b for a, b in counts.items()) // 1024) + (counts.get(512, 0) > 0)


def test_fullest_is_the_best_sum():
    random = np.random.default_rng(2)
    for _ in range(200):
        counts = {int(k): int(random.integers(1, 3)) for k in random.integers(1, 40, 5)}
        room = int(random.integers(1, 90))
        sums = {0}
        for length, n in counts.items():
            sums |= {s + length * k for s in sums for k in range(n + 1)}
        chosen = packing.fullest(counts, room)
        assert sum(a * b for a, b in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[length] for length, n in chosen.items())


def test_rule_counts_against_brute_force():
    random = np.random.default_rng(4)
    for _ in range(300):
        text = "".join(random.choice(list("aab  \n#|\t\xa0é\x0b"), random.integers(0, 60)))
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
        runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeated = {i + k for i in range(len(words) - 2) for k in range(3) if runs[tuple(words[i : i + 3])] > 1}
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", line)]
        got = dict(zip(measure.COUNTS, measure.measure(text)))
        assert (got["n_words"], got["word_chars"], got["n_repeat_words"]) == (len(words), sum(map(len, words)), len(repeated))
        assert got["n_symbols"] == sum(c in "#*$%&|<>" for c in text) and got["n_dup_lines"] == len(lines) - len(set(lines))


def test_ablations(spark, awkward):
    entries = rules.ledger(awkward)
    policy = rules.Policy("two", 3, ("few_words", "repeated_runs"))
    got = {r.rule: tuple(r)[1:] for r in rules.ablations(entries, policy).collect()}
    assert got == {"few_words": (8, 8, 9), "repeated_runs": (1, 1, 9)}
    assert rules.judged(entries, policy).where("kept").count() == 0


def test_label_model_weighs_cautious_labellers():
    random = np.random.default_rng(6)
    bad = random.random(4000) < 0.2
    votes = np.zeros((4000, len(weak_labels.LABELLERS)), int)
    for j in range(votes.shape[1]):
        called = random.random(4000) < np.where(bad, 0.1 if j == 3 else 0.6, 0.003)
        votes[:, j] = np.where(called, 1, 2)
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_labels.label_model(rows, counts.astype(float))
    by_row = {tuple(r): q for r, q in zip(rows, model.bad(rows))}
    guess = np.array([by_row[tuple(v)] > 0.5 for v in votes])
    assert (guess == bad).mean() > 0.95
    assert model.accuracy()[3, 1, 0] < model.accuracy()[4, 1, 0]


def test_kinds_of_bad_documents_do_not_share_good_ones():
    random = np.random.default_rng(5)
    bad = random.random(20000) < 0.13
    n = len(weak_labels.LABELLERS)
    # each bad document has one fault that one of five labellers sees; three never call anything bad
    fault = np.where(bad, random.integers(0, 5, 20000), n)
    votes = np.where(random.random((20000, n)) < 0.03, 0, 2)
    votes[:, 0] = np.where(random.random(20000) < 0.005, 1, votes[:, 0])
    votes[np.arange(20000)[bad], fault[bad]] = 1
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_labels.label_model(rows, counts.astype(float))
    by_row = {tuple(r): p for r, p in zip(rows, model.bad(rows))}
    guess = np.array([by_row[tuple(v)] > 0.5 for v in votes])
    assert guess[bad].all() and guess[~bad].mean() < 0.01
    assert model.bad(np.zeros((1, n), int))[0] < 0.5  # no vote, no evidence


def test_signatures_are_unbiased():
    random = np.random.default_rng(0)
    errors = []
    for _ in range(30):
        e, a, b = random.integers(0, 2**63, 40, dtype=np.uint64), random.integers(0, 6, 40), random.integers(0, 6, 40)
        owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        s = bagminhash.signatures(np.concatenate([e[a > 0], e[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), owner, 2)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.015


def test_near_duplicates_against_all_pairs(spark):
    ship(spark)
    random = np.random.default_rng(8)
    texts = []
    for k in range(12):
        words = [f"w{random.integers(0, 4000)}" for _ in range(150)]
        for _ in range(8):
            copy = [w if random.random() > 0.015 else "new" for w in words]
            texts.append(" ".join(copy))
    texts += [texts[0]] * 5 + ["a b"] * 2 + ["same " * 40, "same " * 44, "same " * 90]
    got = dict(map(tuple, bagminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()))
    bags = [Counter(zip(*(t.split()[i:] for i in range(5)))) if len(t.split()) > 4 else Counter([tuple(t.split())]) for t in texts]
    part = list(range(len(texts)))
    for i, a in enumerate(bags):
        for j in range(i):
            if sum((a & bags[j]).values()) >= 0.8 * sum((a | bags[j]).values()):
                low, high = sorted((part[i], part[j]))
                part = [low if p == high else p for p in part]
    assert got == dict(enumerate(part))


def test_disguised_words(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    for word in ("idiot", "1d10t", "i d i o t", "idiooot", "w.o.r.t.h.l.e.s.s", "cl0wn", "m0r0n"):
        assert model.score(f"the {word} the") >= toxicity.CUT_OFF, word
    assert model.score("the of and") < toxicity.CUT_OFF


def test_repeated_rows_are_drawn_once(spark):
    rows = [(None, None)] * 3000 + [(7, "again and again")] * 3000 + [(i, f"text {i}") for i in range(100, 3100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in weak_labels.draw(docs, 200).collect()]
    assert len(got) == 200 and len({t for t, _ in got}) == 200
    weights = dict(got)
    total = sum(weights.values())  # each of the two rows is a third of the table and of the sample
    assert all(0.25 < weights[t] / total < 0.42 for t in (None, "again and again"))
    assert sorted(w for _, w in weak_labels.draw(docs, 5000).collect())[-3:] == [1, 3000, 3000]


def test_one_row_of_each_class_stays(spark):
    ship(spark)
    long = "one two three four five six seven eight nine ten eleven twelve".split()
    near = " ".join(long * 9), " ".join(long * 9 + ["more"])
    rows = [
        (1, near[0], "x"), (1, "quite another text of no class at all", "x"), (2, near[1], "x"),  # one id, two classes
        (3, "alone", "x"), (None, "alone", "x"), (None, "no id", "x"), (None, "no id", "x"), (None, near[1], "x"),
        (4, None, "x"), (5, "", "x"), (4, None, "x"), (6, "é漢😀", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    kept = bagminhash.deduplicated(docs)
    want = [(1, near[0], "x"), (1, rows[1][1], "x"), (3, "alone", "x"), (None, "no id", "x"), (4, None, "x"), (6, "é漢😀", "x")]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr) and kept.columns == docs.columns


def test_no_length_hides_a_term(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    for text in (
        "idi" + "o" * 90 + "t", "the-and-nation-1d10t-thing-over-under-and-so-on-and-on", "the-1d10t-thing",
        " ".join("youareanidiotandthatisallthereistosayaboutthisnow"), "a " * 60 + "i d i o t", "i d i o t" + " a" * 60,
    ):
        assert model.score(text) >= toxicity.CUT_OFF, text
    for text in ("9c8b45435718dcc700c184a7e303cdc64c6a8f7f" * 3, "a " * 200, "of-the-and-" * 20, "o" * 500):
        assert model.score(text) < toxicity.CUT_OFF, text
    started = time.process_time()
    for text in ("a1b2-c3." * 4000, "ab" * 16000, "a b " * 8000, "." * 16000 + "ab"):
        model.score(text)
    assert time.process_time() - started < 60


def test_classifiers_on_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    ship(spark)
    _, scorer = weak_labels.fit(docs)
    scored = docs.select("doc_id", weak_labels.bad_score(spark, scorer)("text").alias("s")).join(labels, "doc_id")
    right = scored.where((F.col("s") >= weak_labels.CUT_OFF) == (F.col("quality") == 0)).count()
    assert right >= 0.95 * scored.count()
    clean = scored.where("quality = 1")
    assert clean.where(F.col("s") >= weak_labels.CUT_OFF).count() <= 0.02 * clean.count()


def test_training_beats_word_frequencies(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trained, weights = language_model.fit(docs)
    _, untrained = language_model.fit(docs, rounds=0)
    total = [language_model.scored(trained, w).agg(F.sum("log_likelihood")).first()[0] for w in (weights, untrained)]
    assert total[0] > total[1]


def test_training_takes_every_place_once(spark):
    sizes = np.array([0, 1, 3, 0, 20, 1, 7])
    for rounds in (1, 2, 3, 8):
        taken = np.concatenate([language_model._chosen(np.arange(7), sizes, turn, rounds) for turn in range(rounds)])
        assert sorted(taken) == list(range(sizes.sum()))
    # so do copies of a text of two words, in every round
    ship(spark)
    docs = spark.createDataFrame([(i, "a b" if i % 2 else "c d") for i in range(20000)], "doc_id long, text string").coalesce(1)
    trained, weights = language_model.fit(docs)
    got = [r.pseudo_perplexity for r in language_model.scored(trained, weights).collect()]
    assert max(got) < 2


def test_every_word_has_its_own_probability(spark):
    ship(spark)
    random = np.random.default_rng(12)
    # 3,840 words fill the vocabulary; a rarer one occurs 30 times, junk once
    texts = [" ".join(f"top{i}" for i in random.permutation(3840)) for _ in range(40)]
    texts += [f"top1 top2 rare{i % 20} top3 top4" for i in range(600)] + ["É漢😀 top1 É漢😀x"] * 2
    junk = [f"top1 top2 junk{i} top3 top4" for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts + junk)), "doc_id long, text string").repartition(3)
    rows, flat = language_model.fit(docs, block_words=100)
    assert rows.docs.select("block").distinct().count() > 10
    got = {r.doc_id: r for r in language_model.scored(rows, flat).collect()}
    times = Counter(w for t in texts + junk for w in t.lower().split())
    top = {w: i for i, w in enumerate(sorted(times, key=lambda w: (-times[w], w))[: language_model.VOCABULARY - language_model.OTHERS])}
    network, marks = language_model.Network.of(flat), {}
    for w in times.keys() - top.keys():
        marks.setdefault(language_model.xxhash.xxh64_intdigest(w, 42) % language_model.OTHERS, []).append(w)
    share, mark_of = {}, {}
    for mark, members in marks.items():
        whole = sum(times[w] + language_model.SMOOTHING for w in members) + language_model.SMOOTHING
        share |= {w: np.log((times[w] + language_model.SMOOTHING) / whole) for w in members}
        mark_of |= {w: language_model.VOCABULARY - language_model.OTHERS + mark for w in members}
    for k in [0, *range(40, 60), 640, *range(642, 2642, 97)]:
        words = (texts + junk)[k].lower().split()
        ids = np.array([top.get(w, mark_of.get(w)) for w in words], np.int16)
        near = language_model.windows(ids, np.array([len(ids)]))
        want = network.log_probabilities(near, ids).sum() + sum(share.get(w, 0) for w in words)
        assert (got[k].n_tokens, got[k].log_likelihood) == (len(words), pytest.approx(want, rel=1e-3)), words[:8]
    mean = lambda ids: np.mean([got[k].log_likelihood / got[k].n_tokens for k in ids])
    assert mean(range(642, 2642)) < mean(range(40, 640)) - 0.3


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near-duplicates", "private data", "packing"]
    out = corpus_pipeline.run(spark, sf_dir)
    lengths = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert lengths.where("n > 1024 or n != end").count() == 0
    assert 0 < out.select("doc_id").distinct().count() < docs.count()


def test_packed_ids_are_those_of_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(BPE)
    want = {
        r.doc_id: np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], encode.ID)
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    rows = QUERIES["op5_packing"](spark, sf_dir).collect()
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    assert all(zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)


def test_blanks_beside_white_space():
    ids_of = encode.Encoder(BPE, 0)
    random = np.random.default_rng(5)
    parts = ["a", "b's", " ", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "é", "漢", "😀", "12", "...", "<|endoftext|>", "\r\n", "x" * 70]
    texts = ["".join(random.choice(parts, random.integers(0, 12))) for _ in range(3000)]
    texts += ["", " ", "\n", " a", "a ", "a\n", "\na", "a \n b", "a\n b", None]
    assert list(ids_of.encode(texts)) == [np.array([*x.ids, 0], "<u4").tobytes() for x in Tokenizer.from_file(BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert list(ids_of.encode(["", None, ""])) == [bytes(4)] * 3 and list(ids_of.encode([])) == []


def test_units_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(encode.Encoder, "LIMIT", 100)
    ids_of, asked = encode.Encoder(BPE, 0), Counter()
    units = ids_of._units
    monkeypatch.setattr(ids_of, "_units", lambda some: asked.update(some) or units(some))
    common = " ".join(f"common{k}" for k in range(60))
    for k in range(40):  # each batch has 20 words of its own; the common ones are in every third
        own = " ".join(f"w{k}x{i}" for i in range(20))
        list(ids_of.encode([own + " " + common if k % 3 == 0 else own]))
        assert len(ids_of.known) + len(ids_of.before) <= 400
    assert all(n == 1 for unit, n in asked.items() if unit.startswith(" common"))


def test_open_buckets_make_no_rows_of_pairs(spark, monkeypatch):
    ship(spark)
    random = np.random.default_rng(4)
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join([*base, f"end{k}"]) for k in range(60)]
    # overlaps of 0.7 to 0.85 with those: of one class or not
    for k in range(120):
        words = list(base)
        for at in random.choice(100, 3 + k % 2, replace=False):
            words[at] = f"own{k}"
        texts.append(" ".join(words))
    sent, check = [], bagminhash.verified
    monkeypatch.setattr(bagminhash, "verified", lambda pairs, *a: sent.append(pairs.count()) or check(pairs, *a))
    monkeypatch.setattr(bagminhash, "BLOCK", 7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(map(tuple, bagminhash.near_duplicates(docs).collect()))
    bags = [Counter(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    links = [(i, j) for i, a in enumerate(bags) for j in range(i) if sum((a & bags[j]).values()) >= 0.8 * sum((a | bags[j]).values())]
    part = list(range(len(texts)))
    for i, j in links:
        low, high = sorted((part[i], part[j]))
        part = [low if p == high else p for p in part]
    assert 1 < len(set(part)) < len(texts) and got == dict(enumerate(part))
    assert len(sent) == 1 + bagminhash.TURNS  # of centres with others; the rest are verified by blocks


def test_more_links_between_components(spark):
    old = [(i, i + 1) for i in range(20)] + [(40, 41), (50, 51), (60, 61)]
    more = [(5, 41), (51, 61), (70, 71), (3, 9)]
    before = components.components(spark.createDataFrame(old, "a long, b long"))
    got = dict(map(tuple, components.extended(before, spark.createDataFrame(more, "a long, b long")).collect()))
    assert got == dict(map(tuple, components.components(spark.createDataFrame(old + more, "a long, b long")).collect()))


def test_a_step_updates_all_classes_at_once(monkeypatch):
    random = np.random.default_rng(6)
    network = language_model.Network.new(random.integers(1, 50, language_model.VOCABULARY))
    trainer, plain = language_model.Trainer(network), language_model.Network.of(network.flat())
    near = random.integers(0, language_model.VOCABULARY + 1, (300, 4)).astype(np.int16)
    target = random.integers(0, language_model.VOCABULARY, 300).astype(np.int16)
    steps, step = [], trainer._step
    monkeypatch.setattr(trainer, "_step", lambda *a: steps.append(1) or step(*a))
    trainer.learn(near, target)
    assert len(steps) == 3 + near.shape[1]
    # the words of each class, by themselves
    h, size = plain.hidden(near), language_model.CLASS_SIZE
    for k in range(language_model.CLASSES):
        mine = np.flatnonzero(target // size == k)
        x = np.exp(h[mine] @ plain.words[k].T)
        x /= x.sum(axis=1, keepdims=True)
        x[np.arange(len(mine)), target[mine] % size] -= 1
        change = x.T @ h[mine] / 300
        want = plain.words[k] - language_model.RATE * change / np.sqrt(1e-6 + change * change)
        assert np.allclose(trainer.network.words[k], want, atol=2e-4)


def memory_of_a_unit(remembering, encode_all):
    encode_all(["a b"])
    tracemalloc.start()
    held = pa.total_allocated_bytes()
    texts = [" ".join(f"w{k * 40 + i:x}" for i in range(40)) for k in range(1500)]
    assert sum(map(len, encode_all(texts))) > 4 * 60_000
    taken = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - held
    tracemalloc.stop()
    assert len(remembering.known) > 55_000
    return taken / len(remembering.known)


def test_remembered_units_take_little_memory():
    ids_of = encode.Encoder(BPE, 0)
    assert memory_of_a_unit(ids_of, lambda texts: list(ids_of.encode(texts))) < 100


def test_remembered_words_take_little_memory():
    model = pieces.Model(PIECES)
    assert memory_of_a_unit(model, lambda texts: [model.encode(t) for t in texts]) < 130


def test_pieces_of_many_texts_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(pieces.Model, "LIMIT", 50)
    model, random = pieces.Model(PIECES), np.random.default_rng(8)
    texts = [" ".join(random.choice(["the", "é漢", "in", f"w{k}", "x" * 70, "", "\n"], 30)) for k in range(300)] + ["", None]
    found = model.encode_all(texts) + [i for k in range(0, 300, 7) for i in model.encode_all(texts[k : k + 7])]
    assert found == [np.array(model.library.encode(t or ""), encode.ID).tobytes() for t in [*texts, *texts[:301]][: len(found)]]
    assert len(model.known) < 150


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    stored, save = [], components.saved
    monkeypatch.setattr(components, "saved", lambda df, name: stored.append(name) or save(df, name))
    found = lambda links: sorted(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found([(2, 1), (1, 3), (3, 1), (5, 4), (6, 6), (None, 1)]) == [(2, 1), (3, 1), (5, 4)] and len(stored) == 1
    assert found([]) == [] and len(stored) == 2
    # a node with two smaller ones, and a path, take rounds
    assert found([(3, 1), (3, 2)]) == [(2, 1), (3, 1)] and found([(3, 2), (2, 1)]) == [(2, 1), (3, 1)]
    assert len(stored) == 6


def test_words_in_columns_are_those_of_split_and_fill_blocks():
    odd = ["", "  ", None, "a  b\x1cc\x85d e　", " İß ΑΣ a", "b b a b", "one two three four"] * 3
    want = [(t or "").lower().split() for t in odd]
    texts = language_model.Words(odd)
    words = texts.words.to_pylist()
    assert [words[a:b] for a, b in zip(texts.begins, texts.begins[1:])] == want
    # words of the vocabulary keep their numbers; a block ends with the text that brings its third other word
    vocabulary, first, blocks, ids = pa.array(["a", "b"], pa.large_string()), 0, [], []
    while first < len(odd):
        block = language_model.Block(vocabulary, len(blocks), 3)
        while first < len(odd) and not (block.texts() and block.full):
            ids += block.encode(texts, first)
            first = len(ids)
        blocks.append(block)
    assert len(ids) == len(odd) and [len(i) // 2 for i in ids] == list(map(len, want))
    told = [w for b in blocks for w in b.others.to_pylist()]
    assert set(told) == {w for t in want for w in t} - {"a", "b"} and all(len(b.others) >= 3 for b in blocks[:-1])
    mark = {w: language_model.VOCABULARY - language_model.OTHERS + language_model.xxhash.xxh64_intdigest(w, 42) % language_model.OTHERS for w in told}
    assert np.frombuffer(b"".join(ids), np.int16).tolist() == [{"a": 0, "b": 1}.get(w, mark.get(w)) for t in want for w in t]
    at = 0
    for block in blocks:
        sizes = np.concatenate(block.sizes).tolist()
        others = [w for t in want[at : at + len(sizes)] for w in t if w not in ("a", "b")]
        assert [block.others[k].as_py() for k in np.concatenate(block.places).tolist()] == others
        at += len(sizes)


def test_runs_of_rows_and_softmax_without_their_largest():
    random = np.random.default_rng(8)
    sizes = np.array([1, 1, 2, 9, 1, 4, 5, 300, 3, 1])
    rows, begins = random.normal(size=(sizes.sum(), 3)).astype(np.float32), np.cumsum(sizes) - sizes
    assert np.allclose(language_model._sums(rows, begins), np.add.reduceat(rows, begins), atol=1e-4)
    for x in ([[1.0, -2.0, 0.5]], [[300.0, -300.0, 299.0], [-200.0, -201.0, -250.0]]):
        x = np.array(x, np.float32)
        powers = np.exp(x - x.max(axis=1, keepdims=True))
        share, chosen = powers / powers.sum(axis=1, keepdims=True), np.full(len(x), 2)
        assert np.allclose(language_model._log_chosen(x.copy(), chosen), (x - x.max(axis=1, keepdims=True))[:, 2] - np.log(powers.sum(axis=1)))
        share[:, 2] -= 1
        assert np.allclose(language_model._error(x.copy(), chosen, 4), share / 4, atol=1e-6)


@pytest.mark.skipif(sys.platform != "linux", reason="reads the memory of a process from /proc")
def test_a_process_gives_back_what_another_operator_took():
    script = """
import re
import numpy as np, pyarrow as pa
from tarmac.llm import bagminhash, measure, remembered, toxicity

def megabytes():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()).group(1)) / 1024

rows = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a b c d e f"]})
kept = []
remembered.kept_for("first", kept.clear)
for work in (toxicity._trigrams, measure.measured, bagminhash._signed):
    remembered.begin("first")
    bare = megabytes()
    for _ in range(20_000):
        kept += [np.ones(1000), pa.array(range(100))]
    end = np.ones(1000)  # what is freed before it is no longer the end of the memory
    full = megabytes()
    list(work(iter([rows])))
    print(bare, full, megabytes())
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
    assert not done.returncode, done.stderr
    for line in done.stdout.splitlines():
        bare, full, after = map(float, line.split())
        assert full - bare > 100 and after - bare < 0.3 * (full - bare)
    assert len(done.stdout.splitlines()) == 3


def test_memory_goes_back_after_each_part_that_is_encoded(monkeypatch):
    texts = ["some words of a text, and more"] * 10
    given = encode.Encoder(BPE, 2)
    want = list(given.encode(texts))
    back = []
    monkeypatch.setattr(given, "AT_ONCE", 100)
    monkeypatch.setattr(encode, "give_back", lambda: back.append(1))
    assert list(given.encode(texts)) == want and len(back) == 2
