"""Prefix trie, fill-in-the-middle and MinHash near-dedup against plain versions, through the queries too."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidegate.llm import common, fill_in_middle, minhash, pii, prefix_trie, queries
from tidegate.storage import stage

RANDOM = random.Random(11)
SF = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def trie_of(spark, rows, tmp_path):
    schema = "conv_id long, turn long, role string, text string, block int, least int"
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([(*r, 1, 2) for r in rows], schema).repartition(3).write.parquet(path)
    got = queries.op11_prefix_trie(spark, str(tmp_path)).collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[:2])


def conversation_rows():
    """Shared starts, copies, one long conversation, NULLs, gaps and a conversation that ends inside another."""
    rows = []
    for c in range(60):
        n = RANDOM.randint(1, 14)
        for t in range(n):
            rows.append((c, t if RANDOM.random() < 0.95 else None, RANDOM.choice(["user", "assistant", None]), RANDOM.choice(["a", "bé", "", None, "x" * 30])))
    same = [(t, "user", f"turn {t}") for t in range(7)]
    for c in range(200, 260):
        rows += [(c, *t) for t in same[: 7 if c % 3 else 4]]
    rows += [(1001, t, "user", f"t{t % 9}") for t in range(70)]
    rows += [(1003, 5, "user", "late"), (1002, -3, None, None), (-7, 0, "user", "below"), (-5, 1, "user", "below")]
    rows += [(None, 1, "user", "nobody"), (2**40 + 5, 1, "user", "a")]
    return rows


def test_trie(spark, tmp_path):
    rows = conversation_rows()
    # Where turn numbers tie, the order is that of hashes: leave only ties of equal turns.
    seen, unique = {}, []
    for r in rows:
        key = (r[0], r[1])
        if seen.setdefault(key, r[2:]) == r[2:]:
            unique.append(r)
    assert trie_of(spark, unique, tmp_path) == brute.trie(unique)


def test_trie_with_hot_prefixes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "HOT_SHARE", 20)
    monkeypatch.setattr(prefix_trie, "TURNS_A_KEY", 3)
    rows = [(c, t, "user", "start" if t < 3 else f"{c % 40} {t}") for c in range(120) for t in range(3 + c % 6)]
    assert trie_of(spark, rows, tmp_path) == brute.trie(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, 0, "user", "x")], [(1, 0, "user", "x"), (6, 0, "user", "x")]])
def test_small_tries(spark, tmp_path, rows):
    assert trie_of(spark, rows, tmp_path) == brute.trie(rows)


def test_trie_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.op11_prefix_trie(spark, SF).collect()), key=lambda r: r[:2])
    assert got == brute.trie(rows)


def test_a_conversation_over_many_tasks_is_numbered_whole(spark):
    df = spark.range(5000).select(F.lit(1).alias("conv_id"), (4999 - F.col("id")).alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    got = prefix_trie.numbered(df.unionAll(df.where("turn < 3").withColumn("conv_id", F.lit(2)))).collect()
    assert sorted(r["pos"] for r in got if r["conv_id"] == 1) == list(range(5000))
    texts = {r["turn"]: r["text"] for r in df.collect()}
    first = [r["token"] for r in got if r["conv_id"] == 2 and r["pos"] == 0]
    assert first == [r["token"] for r in got if r["conv_id"] == 1 and r["pos"] == 0] and len(texts) == 5000


TEXTS = [
    None, "", "   ", "a", "a b", "  a  b \n", "é ß　x y", "\x01 \x010 \x011 x", "a <P> b", "x\x0b\x0c y\x85z ",
    "a b c d e f g h i j" * 3, "<P", "x <S y> <M", "word " * 20000, "\U0001F600 \U0001F600\n",
]


def test_fill_in_middle(spark, tmp_path):
    rows = [(i * len(TEXTS) + j, t, "x", 7) for i in range(12) for j, t in enumerate(TEXTS)]
    rows += [(None, "a b c d", "x", 7), (3, "a b c d e f", "x", 7), (3, "a b c d e f", "x", 7)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(3).write.parquet(path)
    want = []
    for i, t, *_ in rows:
        n, form, prefix, middle, output = brute.filled_in(i, t)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (output, t or "")]
        want.append((i, n, form, prefix, middle, *digests))
    got = rows_of(queries.op13_fill_in_middle(spark, str(tmp_path)))
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    none = spark.read.parquet(path).where("false")
    assert fill_in_middle.fill_in_middle(none).count() == 0


def test_fill_in_middle_in_small_runs(spark, monkeypatch):
    monkeypatch.setattr(fill_in_middle, "RUN_BYTES", 10)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 4, None, "b" * 30, "", "c" * 6, "d" * 4])], names=["text"])
    assert [len(r) for r in fill_in_middle.runs(batch)] == [2, 1, 3]
    df = stage(spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string"), "fim").frame
    always = fill_in_middle.fill_in_middle(df, seed=1, rate=100, spm_rate=0).collect()
    assert {(r["form"], r["n"]) for r in always} == {("psm", 3), ("plain", 0)}


def copies_corpus(families=6, members=14, words=90):
    """Families of edited copies of one text, copies, short texts, chains, and texts alike to 0.6 to 0.79."""
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", "  ", "A", "a", "a b c", "A B C", "a b c d", "a b c d e", "a b c e"]
    for _ in range(families):
        base = RANDOM.choices(vocabulary, k=words)
        texts.append(" ".join(base))
        for m in range(members):
            edited = list(base)
            for at in RANDOM.sample(range(words), RANDOM.randint(0, 5)):
                edited[at] = RANDOM.choice(vocabulary)
            texts.append("  ".join(edited).upper() if m % 5 == 0 else "\n".join(edited))
    words_now = RANDOM.choices(vocabulary, k=60)
    for step in range(12):
        words_now = [*words_now[1:], f"step{step}"]
        texts.append(" ".join(words_now))
    texts += [" ".join(RANDOM.choices(vocabulary, k=RANDOM.randint(1, 9))) for _ in range(60)]
    texts += [" ".join(RANDOM.choices("xyz", k=RANDOM.randint(1, 9))) for _ in range(60)]
    RANDOM.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("hot", [False, True])
def test_minhash_components(spark, tmp_path, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(common, "HOT_ROWS", 3)
        monkeypatch.setattr(common, "HOT_SHARE", 50)
    docs = copies_corpus(6 if hot else 12, 14, 90)
    path = str(tmp_path / "documents.parquet")
    schema = "doc_id long, text string, n int, cid string, band int"
    rows = [(i, t, 1, "x", 2) for i, t in docs] + [(None, docs[20][1], 1, "x", 2), (5, docs[5][1], 1, "x", 2)]
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(path)
    got = rows_of(queries.op12_minhash_dedup(spark, str(tmp_path)))
    want = [(i, n, g, i == g) for i, n, g in brute.jaccard_classes(docs, 4)]
    again = next(r for r in want if r[0] == 5)
    nobody = [r for r in got if r[0] is None]
    assert [r for r in got if r[0] is not None] == sorted([*want, again], key=lambda r: [(v is None, str(v)) for v in r])
    assert len(nobody) == 1 and nobody[0][2:] == (None, None)
    assert len({r[2] for r in want}) < len(want) - 60


def test_minhash_of_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string").where("false")
    assert minhash.near_duplicates(docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(blank)) == [(1, 0, 1, True), (2, 0, 2, True)]
    kept = minhash.first_of_each(spark.createDataFrame([(2, "x y", 1), (1, "X Y", 2), (3, "z", 3)], "doc_id long, text string, kept int"))
    assert rows_of(kept) == [(1, "X Y", 2), (3, "z", 3)]


def test_rows_of_one_doc_id_with_two_texts_are_apart(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "x y z"), (3, "a b c")], "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(df)) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_minima_estimate_the_similarity():
    import numpy as np

    one = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    two = np.concatenate([one[100:], one[:100] + np.uint64(1)])
    values = minhash.minima(np.concatenate([one, two]), np.array([0, 1000]))
    agree = (values[0] == values[1]).mean()
    assert abs(agree - 900 / 1100) < 0.16


def plain_base(text):
    found = []
    for number, kind in enumerate(pii.KINDS):
        found += [(m.start(), number, m.end()) for m in pii.BASE[kind].finditer(text) if pii.valid(kind, m[0])]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns():
    pieces = ["a", "b-c", "@", "@@", ".", ".com", "_", "%x", "1", "0", "255", "256", "1.2.3.4", " ", "+1", "(2) 34", "-", "4111 1111 1111 1111", "é", "[at]", "\n"]
    for _ in range(4000):
        text = "".join(RANDOM.choices(pieces, k=RANDOM.randint(1, 25)))
        assert pii.base_spans(text) == plain_base(text), text


def test_loose_spans_are_all_found():
    def found(text):
        return [(pii.KINDS[k], text[s:e]) for s, k, e in pii.loose_spans(text, pii.base_spans(text))]

    assert found("10[.]0[.]0[.]1 10[.]0[.]0[.]2") == [("ip", "10[.]0[.]0[.]1"), ("ip", "10[.]0[.]0[.]2")]
    assert found("mail x [At] y.com, z(AT)q [dot] org") == [("email", "x [At] y.com"), ("email", "z(AT)q [dot] org")]
    assert ("phone", "555-123-4568 2024") in found("call 555-123-4568 2024") and found("x 12-345-678") == [("phone", "12-345-678")]
    assert ("card", "4111 1111 1111 1112") in found("4111 1111 1111 1112")
    assert found("4111 1111 1111 1111 a@b.com") == []


def test_long_runs_are_searched_in_linear_time():
    zeros = "0" * 5000 + "1.1.1.1"
    spans = pii.base_spans(zeros)
    assert spans == [(0, 1, len(zeros))]
    pii.votes_of(zeros, 0, 1, len(zeros), True)
    begun = time.process_time()
    for run in ("a", "1", "1.", "a.", "1 ", "+", "+1", "@", "a@", "[at]", "a[at]", "(1"):
        text = run * (1_000_000 // len(run)) + " x@y.com 1.2.3.4"
        pii.loose_spans(text, pii.base_spans(text))
    assert time.process_time() - begun < 120


def test_the_method_adds_spans_and_no_decoys(spark, tmp_path):
    """Masked addresses like the open ones around them are added, card numbers with a wrong checksum are not."""
    def card(good):
        digits = [RANDOM.randrange(10) for _ in range(14)]
        body = "4" + "".join(map(str, digits))
        check = next(c for c in range(10) if pii.luhn(body + str(c)))
        return body + str(check if good else (check + 1 + RANDOM.randrange(8)) % 10)

    rows, masked, decoys = [], set(), set()
    for i in range(400):
        if i % 4 == 0:
            rows.append((i, f"the server address 10[.]{i % 250}[.]3[.]{i % 199} is up"))
            masked.add(i)
        elif i % 4 == 1:
            rows.append((i, f"the server address 10.{i % 250}.3.{i % 199} is up"))
        else:
            good = i % 4 == 2
            rows.append((i, f"paid by card {card(good)} today"))
            if not good:
                decoys.add(i)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op7_pii(spark, str(tmp_path)).collect()}
    added = {i for i, r in got.items() if r["spans"] and not r["n_ip"] and not r["n_card"]}
    assert not added & decoys
    assert len(added & masked) >= 0.9 * len(masked)
    assert all(r["n_ip"] + r["n_card"] == 1 and r["spans"] for i, r in got.items() if i % 4 in (1, 2))
