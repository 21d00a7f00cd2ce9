"""Filter audit, spelling variants and minimum bin slack against plain versions."""

import collections
import os
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402
from tilewright.llm import bin_slack, filter_audit, queries, spelling  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(3000)]


def run(n, seed, size=400):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, size, n))


def texts():
    """Nulls, blanks, marks, capitals, copies, white space of other kinds, one huge word, a long text."""
    long = run(30000, 1, 3000)
    out = [None, "", " \t\n ", "one", "ONE TWO", "a # b", run(120, 2), run(120, 2), run(120, 2), run(99, 3), run(100, 3)]
    out += [long, long + " end", "x" * 300_000, "the " * 200, "É" * 50, run(300, 4, 3000) + " *", run(300, 4, 3000)]
    out += ["a\x85b c\x1cd <|endoftext|> it's 12 é", "<|startoftext|>", "ALL CAPS " * 60 + "|"]
    return out


@pytest.fixture(scope="session")
def rows():
    out = [(2 * i, t, (None, "", "en", "de")[i % 4], "s", len(t or "")) for i, t in enumerate(texts())]
    out += [(None, "one", "en", "s", 3), (None, "null id", "en", "s", 7), (None, "null id", "de", "s", 7)]
    return out + [(6, "one", "en", "s", 3), (6, "one", "de", "s", 3), (12, run(120, 2), "xx", None, 0)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns named like those the operators make."""
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("part", "fails", "content", "n", "good", "word", "id", "piece", "length", "rank"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.repartition(7)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


LABELS = [(0, 1, 0), (6, 1, None), (6, 0, 1), (12, None, 1), (14, 1, 1), (None, 1, 1), (999, 1, 1), (18, 0, 0)]


def test_audit(spark, docs, rows):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    want = sorted(plain.filter_audit([(r[0], r[2], r[1]) for r in rows], LABELS), key=repr)
    got = filter_audit.audit(docs, labels)
    assert sorted_rows(got) == want
    assert len(want) == 600 * len({r[2] or "" for r in rows})
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_sql_on_awkward_rows(spark, docs, rows):
    """The checking SQL holds for nulls and repeated rows, too."""
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[2]) for r in rows])
    con.execute("create table labels (doc_id bigint, quality int, toxic int)")
    con.executemany("insert into labels values (?, ?, ?)", LABELS)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels)
    want = con.execute(f"select {', '.join(got.columns)} from ({filter_audit.ORACLE})").fetchall()
    assert sorted_rows(got) == sorted(want, key=repr)


def test_audit_query_against_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    got = queries.QUERIES["op12_filter_audit"](spark, sf)
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.ORACLES['op12_filter_audit']})").fetchall()
    assert sorted_rows(got) == sorted(want, key=repr)


def test_removal_steps_are_those_of_the_first_failed_filter():
    names, places, steps = filter_audit.removal_steps()
    assert len(set(names)) == 120
    for p, name in enumerate(names):
        assert [name[places[f, p] - 1] for f in range(5)] == list("ABCDE")
        for fails in range(32):
            first = next((i for i, f in enumerate(name, start=1) if fails >> "ABCDE".index(f) & 1), 6)
            assert steps[fails, p] == first


def ids_of(text):
    found = bin_slack._tokenizer(bin_slack.VOCABULARY).encode(text or "", add_special_tokens=False).ids
    return np.array([*found, 0], "<u4")


def check_packing(got, rows, length):
    """Every id in one piece, no sequence too long, offsets without gaps; returns the sequences."""
    want = collections.Counter()
    for doc_id, text in rows:
        ids = ids_of(text)
        for piece, at in enumerate(range(0, len(ids), length)):
            own = ids[at : at + length]
            want[doc_id, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        pieces.sort()
        ends = np.cumsum([n for _, n in pieces])
        assert [at for at, _ in pieces] == [0, *ends[:-1]] and ends[-1] <= length
    return sequences


@pytest.mark.parametrize("length", [64, 2048])
def test_bin_slack(docs, rows, length):
    got = bin_slack.pack(docs, length).collect()
    sequences = check_packing(got, [r[:2] for r in rows], length)
    assert len(sequences) <= -(-sum(r["length"] for r in got) // length) + 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aA'st1 \t\n\x0b\x1c\x85 éß́İΣ<|endofx>", max_size=60))))
def test_ids_are_those_of_the_tokenizer(some):
    text = " ".join(some)
    assert bin_slack.Ids().of([text, *some]) == [ids_of(t)[:-1].tobytes() for t in (text, *some)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=12))
def test_fullest_combination_by_brute_force(lengths):
    counts = np.bincount(lengths, minlength=31)
    chosen = bin_slack.fullest(counts, 30)
    longest = max(lengths)
    assert chosen[longest] >= 1 and all(counts[k] >= n for k, n in chosen.items())
    rest, sums = sorted(lengths)[:-1], {longest}
    for x in rest:
        sums |= {s + x for s in sums if s + x <= 30}
    assert sum(k * n for k, n in chosen.items()) == max(sums)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_combinations_use_every_piece(lengths):
    counts = np.bincount(lengths, minlength=65)
    used = np.zeros(65, int)
    plan = bin_slack.combinations(counts, 64)
    for chosen, times in plan:
        assert sum(k * n for k, n in chosen.items()) <= 64
        for k, n in chosen.items():
            used[k] += n * times
    assert (used == counts).all()
    table = bin_slack.places(plan, counts)
    assert (np.diff(table["low"]) > 0).all()


def spelling_rows(seed, n=250):
    """Words with changed, missing and doubled characters, in a small alphabet so that many are near."""
    rng, out = np.random.default_rng(seed), []
    bases = ["".join(rng.choice(list("abé"), rng.integers(5, 9))) for _ in range(40)]
    for i in range(n):
        words = []
        for _ in range(80):
            word = bases[int(40 * rng.random() ** 3)]
            at = int(rng.integers(0, len(word)))
            kind = rng.integers(0, 8)
            if kind == 0:
                word = word[:at] + word[at + 1 :]
            elif kind == 1:
                word = word[:at] + str(rng.choice(list("abÀ"))) + word[at:]
            elif kind == 2:
                word = word[:at] + "X" + word[at + 1 :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("points", [60, 1000, 1 << 19])
def test_spelling(spark, monkeypatch, points):
    """Also where a trie is numbered in many ranges."""
    monkeypatch.setattr(spelling, "RANGE_POINTS", points)
    monkeypatch.setattr(spelling, "HELD_WORDS", 100)
    rows = spelling_rows(3)
    rows += [(None, None), (None, "nullid " * 5), (7, ""), (7, "repeated " * 3), (7, "repeated " * 3), (8, "aaaaaaaa×÷ß " * 6)]
    rows += [(900 + i, "z" * 5000 + " " + "z" * 4999) for i in range(6)]
    want = plain.spelling(plain.spelling_counts(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("id", F.lit(1))
    got = spelling.variants(frame.repartition(6))
    assert sorted_rows(got) == sorted(want, key=repr)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab", max_size=6), min_size=1), st.lists(st.integers(0, 40), max_size=5))
def test_trie_numbers_stand_for_prefixes(words, cuts):
    """However the sorted words are cut into ranges: equal prefixes, and only they, have one number."""
    words = sorted(words)
    bounds = sorted({0, len(words), *(c for c in cuts if c < len(words))})
    ranges = [words[a:b] for a, b in zip(bounds, bounds[1:])]
    lasts, numbers = [r[-1] for r in ranges], collections.defaultdict(set)
    for part, own in enumerate(ranges):
        for word, path in zip(own, spelling.trie_paths(own, lasts, part)):
            assert len(path) == len(word) + 1
            for k, node in enumerate(path):
                numbers[word[:k]].add(node)
    assert all(len(found) == 1 for found in numbers.values())
    assert len(set.union(*numbers.values())) == len(numbers)


def test_spelling_of_the_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = plain.spelling(plain.spelling_counts(rows))
    assert sorted_rows(queries.QUERIES["op11_spelling"](spark, sf)) == sorted(want, key=repr)


def test_packing_of_the_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check_packing(queries.QUERIES["op13_bin_slack"](spark, sf).collect(), rows, 2048)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    assert spelling.variants(empty).count() == 0 and bin_slack.pack(empty).count() == 0
