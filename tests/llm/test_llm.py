"""Corpus operators against plain versions, on tables with every awkward case."""

import collections
import os
import re
import sys
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
import plain  # noqa: E402
from tilewright.llm import components, jaccard, language_model, licenses, mixing, neighbours  # noqa: E402
from tilewright.llm import packing, quality, simhash, substring_dedup, suffix_dedup, topk  # noqa: E402
from tilewright.llm import queries  # noqa: E402
from tilewright.llm.words import Words, pack, pack_sorted, unpack, unpack_sorted  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(3000)]


def run(n, seed, size=400):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, size, n))


@pytest.fixture(scope="session")
def rows():
    """Copies, near copies, shared passages, nulls, white space, long texts, repeated rows."""
    long, passage, phrase = run(4000, 1, 3000), run(80, 2), run(13, 3)
    texts = [long, run(300, 4), None, "", " \t\n ", "one", "One two", passage, "the " * 200]
    texts += [run(60, 5) + "\n" + passage + "\t" + run(40, 6), run(200, 7) + " " + passage]
    texts += [run(30, 8) + "  " + phrase + " x", "y " + phrase, phrase, long, long + " end", run(300, 4)]
    texts += ["Under the MIT License. CC-BY-NC 4.0", "SPDX-License-Identifier: MIT <|endoftext|> éé \U0001f600"]
    texts += [run(100, 20 + i) for i in range(40)]
    out = [(3 * i, t, "en", ("b", "a", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    out += [(None, passage + " null id", "en", "a", 1), (6, "repeated id " + phrase, "en", "b", 1)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)))
def test_packed_numbers_come_back(values):
    array = np.array(values, np.uint64)
    assert (unpack(pack(array)[0].tobytes()) == array).all()
    assert (unpack_sorted(pack_sorted(np.sort(array))) == np.sort(array)).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \t\n\x1cé ", max_size=30)), min_size=1))
def test_words_are_those_of_split(texts):
    words = Words(pa.array(texts, pa.string()))
    raw = words.data.tobytes()
    got = [[] for _ in texts]
    for d, a, b in zip(words.doc, words.starts, words.ends):
        got[d].append(raw[a:b])
    want = [(t or "").encode().split() for t in texts]
    assert got == want
    flat = [w for t in want for w in t]
    assert len(set(flat)) == len(set(words.hashes().tolist()))


@pytest.mark.parametrize("operator, window", [(substring_dedup, 13), (suffix_dedup, 50)])
def test_repeats(monkeypatch, docs, rows, operator, window):
    want = sorted(plain.repeats([r[:2] for r in rows], window), key=repr)
    assert sorted_rows(operator.remove_repeats(docs)) == want
    assert sum(r[2] for r in want) > window


def test_repeats_across_small_groups(spark, rows):
    """One document per group: everything goes through the buckets."""
    one = spark.createDataFrame(rows, DOCS).repartition(len(rows))
    for operator, window in ((substring_dedup, 13), (suffix_dedup, 50)):
        want = sorted(plain.repeats([r[:2] for r in rows], window), key=repr)
        assert sorted_rows(operator.remove_repeats(one)) == want


def test_texts_without_repeats_keep_their_white_space(docs, rows):
    found = {(r["doc_id"], r["text"]) for r in suffix_dedup.without_repeats(docs).collect()}
    clean = plain.repeats([r[:2] for r in rows], 50)
    for (d, text, *_), (_, _, removed, _) in zip(rows, clean):
        assert ((d, text) in found) == (removed == 0 or not text)
    assert suffix_dedup.without_repeats(docs).columns == docs.columns


def test_simhash(docs, rows):
    want = sorted(plain.near_duplicates([r[:2] for r in rows]), key=repr)
    assert sorted_rows(simhash.near_duplicates(docs)) == want
    kept = simhash.representatives(docs)
    names = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(names) == sorted({r[2] for r in want})


def test_simhash_in_crowded_cells(spark, monkeypatch):
    """Fingerprints one bit apart in a cell of many parts: one component, links of a forest only."""
    monkeypatch.setattr(simhash, "PART", 50)
    base = 0x123456789ABCDEF0
    values = [(base ^ (i * 3) & 0xFFF, i) for i in range(700)] + [(~base & (2**63 - 1), 900)]
    nodes = spark.createDataFrame(values, "fp long, node long").groupBy("fp").agg(F.min("node").alias("node"))
    prints = spark.createDataFrame([(i, f) for f, i in values], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash._named(prints, 4).collect()}
    all_fp = np.array(sorted(got), np.uint64)
    label = {int(f): {int(f)} for f in all_fp}
    for f in all_fp:
        for g in all_fp[np.bitwise_count(all_fp ^ f) <= 4]:
            if label[int(f)] is not label[int(g)]:
                merged = label[int(f)] | label[int(g)]
                for x in merged:
                    label[x] = merged
    least = {r["fp"]: r["node"] for r in nodes.collect()}
    assert got == {f: min(least[x] for x in label[f]) for f in got}


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500), (700, 600), (None, 3)]
    found = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert dict(map(tuple, found)) == {**{i: 0 for i in range(201)}, 600: 600, 700: 600}


def test_licenses(docs, rows):
    want = sorted([(d, *plain.licenses(t, licenses.rules())) for d, t, *_ in rows], key=repr)
    assert sorted_rows(licenses.scan(docs)) == want


def spelled(tree):
    """Texts of a parsed expression: each part once at its shortest and once at its longest, every alternative."""
    out = [""]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            parts = [chr(value)]
        elif name == "SUBPATTERN":
            parts = spelled(value[-1])
        elif name == "BRANCH":
            parts = [x for branch in value[1] for x in spelled(branch)]
        elif name == "MAX_REPEAT":
            low, high, body = value
            once = spelled(body)
            parts = ["".join(once[:1]) * low] if low > 1 else [""] * (low == 0) + once
            parts += once if high > 1 and low == 0 else []
        elif name == "NOT_LITERAL":
            parts = ["x"]
        elif name == "IN":
            kinds = {str(k): v for k, v in value}
            parts = ["x"] if "NEGATE" in kinds else ["2"] if {"RANGE", "CATEGORY"} & set(kinds) else [chr(v) for _, v in value]
        else:  # what stands before or behind
            assert name in ("ASSERT", "ASSERT_NOT"), name
            parts = [""]
        out = list(dict.fromkeys(a + b for a in out for b in parts))
        if len(out) > 200:
            out = out[:100] + out[-100:]
    return out


def test_license_rules_hold_their_keywords(spark):
    """Every spelling of every rule holds one of its keywords and is found by the scan."""
    rules = licenses.rules()
    texts = []
    for label, expression, words, _, _, _ in rules:
        found = [x.strip() for x in spelled(re._parser.parse(expression))]
        assert found and all(any(w in x for w in words) for x in found), (label, words, found[:3])
        assert all(re.search(expression, f" {x} ") for x in found), (label, found[:3])
        texts += [(label, found[0]), (label, found[-1])]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string").repartition(8)
    got = licenses.detect(frame).select("doc_id", F.transform("detections", lambda x: x["label"]).alias("found"))
    missed = [texts[r["doc_id"]] for r in got.collect() if texts[r["doc_id"]][0] not in r["found"]]
    assert not missed, missed[:5]
    written = {x[1] for x in licenses.signatures()} | {name for _, name, _ in licenses.FAMILIES}
    assert len(written) >= 300 and len({r[1] for r in rules}) == len(rules)


def test_license_texts(spark):
    texts = [
        ("GNU Lesser General Public License, version 2.1 or later", "lgpl-2.1"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa"),
        ("see the BSD 3-Clause License", "bsd-3"), ("mit dem Hund", ""),
        ("Licensed under the GPL", "gpl"), ("Released under MIT", "mit"), ("licensed under Apache 2.0", "apache-2"),
        ("This is Apache-2.0 licensed", "apache-2"), ("Licensed under BSD", "bsd"), ("license: MIT", "mit"),
        ("MIT-licensed code", "mit"), ("General Public License", "gpl"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
         "associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
         "that the following conditions are met:", "bsd"),
        ("THE SOFTWARE IS PROVIDED \"AS IS\"", "as-is"), ("please cc by email", ""),
        ("we cc attribution to authors", ""), ("CC BY 4.0", "cc-by"), ("licensed under CC BY", "cc-by"),
        ("GPLv3", "gpl-3"), ("Do What The Fuck You Want To Public License", "wtfpl"),
        ("the public may copy software freely, without any permission", ""),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = [r["labels"] for r in licenses.scan(frame).orderBy("doc_id").collect()]
    assert "lgpl-2.1" in got[0].split(",")
    assert got[1:] == [x for _, x in texts[1:]]
    plan = licenses.scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_language_model(docs, rows):
    unique = docs.filter("doc_id is null or doc_id <> 6 or text is null")
    want = plain.base_scores([r[:2] for r in rows if r[0] != 6 or r[1] is None])
    got = language_model.scores(unique).collect()
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def seated(model):
    """What the buckets of a model hold: samples per word, customers and drawn tables per pair."""
    words, pairs = {}, {}
    for row in model.words.collect():
        ids = unpack_sorted(row["blob"])
        for i, columns in zip(ids, np.array(language_model._columns(row["more"], len(ids))).T):
            words[int(i)] = np.delete(columns, [1, 2, 3])
    for row in model.pairs.union(model.lone).collect():
        seats = language_model.read_seats(row, len(model.samples))
        for key in zip(seats.ids[seats.word], seats.ids[seats.context], seats.counts, seats.drawn):
            assert key[:2] not in pairs
            pairs[tuple(map(int, key[:2]))] = key[2:]
    return words, pairs


def predicted(model, words, pairs, word, context):
    none = np.zeros(1 + 3 * len(model.samples), np.int64)
    columns = [[np.array([x]) for x in values] for values in
               (words.get(word, none), words.get(context, none), pairs.get((word, context), (0, 0)))]
    return language_model._probabilities(*columns, model.samples)[0]


def ids_of(texts):
    """Of each text, its tokens as the model tells them apart."""
    tokens = language_model.Tokens(pa.array(texts))
    ids = [int(x) for x in tokens.ids[tokens.word]]
    return [[x for x, d in zip(ids, tokens.doc) if d == i] for i in range(len(texts))]


def test_language_model_sums_to_one(spark):
    """In every context, probabilities of all words, the end and one unknown add up to 1."""
    docs = spark.createDataFrame([(i, "a b c a b a d") for i in range(40)], "doc_id long, text string")
    model = language_model.learn(docs)
    words, pairs = seated(model)
    assert len(words) == 5 and model.distinct == 5
    for context in [*words, 1]:
        assert sum(predicted(model, words, pairs, w, context) for w in [*words, 2]) == pytest.approx(1)


def test_language_model_state(docs, rows, empty):
    """Counts against plain ones, totals of words against pairs, scores against the collected model."""
    texts = [(r[0], r[1] or "") for r in rows]
    model = language_model.learn(docs)
    words, pairs = seated(model)
    tokens = ids_of([t for _, t in texts])
    end, want = tokens[0][-1], collections.Counter()
    for (doc, _), line in zip(texts, tokens):
        if doc is None or zlib.crc32(str(doc).encode()) % 7 != 2:
            want.update(zip(line, [end, *line]))
    assert {k: int(v[0]) for k, v in pairs.items()} == want
    for which in (0, 1):  # tables of all samples, by word and by context
        sums = collections.Counter()
        for key, (_, drawn) in pairs.items():
            sums[key[which]] += int(drawn)
        at = [1, 4] if which == 0 else [3, 6]
        assert sums == {w: sum(int(x[i]) for i in at) for w, x in words.items() if sum(x[i] for i in at)}
    plainly = collections.Counter()
    for (doc, _), line in zip(texts, tokens):
        logs = [np.log10(predicted(model, words, pairs, *pair)) for pair in zip(line, [end, *line])]
        plainly[doc, round(sum(logs), 6)] += 1
    got = collections.Counter((r["doc_id"], round(r["score"], 6)) for r in language_model.score(docs, model).collect())
    assert got == plainly
    nothing = language_model.score(docs, language_model.learn(empty)).collect()
    assert len(nothing) == len(rows) and all(r["score"] == 0 and r["train_tokens"] == 0 for r in nothing)


def test_language_model_in_passes(spark, docs, monkeypatch):
    """Groups asked about in several passes get the scores of one pass, each document once; shuffle files do not stay."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    monkeypatch.setattr(language_model, "TEXT_BYTES", 200)
    monkeypatch.setattr(language_model, "LEAST_GROUPS", 1)
    cleaned, staged = [], language_model.stage
    monkeypatch.setattr(language_model, "stage", lambda df, what: (cleaned.append((what, spark.conf.get(name))), staged(df, what))[1])
    got = {}
    for passes in (1, 3):
        monkeypatch.setattr(language_model, "PASSES", passes)
        cleaned.clear()
        rows = language_model.scores(docs.repartition(3), sweeps=1).collect()
        got[passes] = sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in rows)
        assert [what for what, _ in cleaned].count("scores") == passes
        assert {value for _, value in cleaned} == {"true"} and spark.conf.get(name) == before
    assert got[1] == got[3] and len(got[1]) == docs.count()


def test_different_numbers():
    values = np.array([5, 1, 5, 2**63, 0, 1], np.uint64)
    assert language_model._different(values).tolist() == [0, 1, 5, 2**63]
    assert language_model._different(values[:0]).tolist() == []


def told(rng, n, words=300, contexts=4000):
    """A row of counted pairs as tasks send it, and its pairs with their counts."""
    ids = np.sort(rng.choice(1 << 20, contexts, replace=False).astype(np.uint64))
    codes = np.unique(rng.integers(0, words, n) * contexts + rng.integers(0, contexts, n))
    word, context, counts = codes // contexts, codes % contexts, rng.integers(1, 4, len(codes))
    more = language_model._matrix([np.diff(word, prepend=0), context, counts])
    return {"blob": pack_sorted(ids), "more": more}, dict(zip(zip(ids[word].tolist(), ids[context].tolist()), counts.tolist()))


def merged(rows):
    return [row for batch in language_model.merge_counts(3, iter(rows)) for row in batch.to_pylist()]


def test_counts_of_a_bucket_merge_in_bounded_memory():
    """Adding up a bucket's counts takes at most 150 bytes for each that was sent; it took 250 before."""
    rng = np.random.default_rng(5)
    sent = [told(rng, 20000) for _ in range(30)]
    merged([sent[0][0]])
    tracemalloc.start()
    merged([row for row, _ in sent])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 * sum(len(pairs) for _, pairs in sent)


@pytest.mark.parametrize("fold, size", [(1, 7), (1000, 64), (1 << 23, 1 << 17)])
def test_counts_of_a_bucket(monkeypatch, fold, size):
    """Counts are the same sums however much is folded at once, each pair once."""
    monkeypatch.setattr(language_model, "FOLD_BYTES", fold)
    monkeypatch.setattr(language_model, "SLICE", size)
    rng = np.random.default_rng(6)
    sent, want, got = [told(rng, n, 5, 40) for n in (1, 60, 200, 1, 300)], collections.Counter(), []
    for _, pairs in sent:
        want.update(pairs)
    for row in merged([row for row, _ in sent]):
        seats = language_model.read_seats(row)
        assert sorted({*seats.word, *seats.context}) == list(range(len(seats.ids)))
        got += zip(zip(seats.ids[seats.word].tolist(), seats.ids[seats.context].tolist()), np.array(seats.counts).tolist())
    assert len(got) == len(want) and dict(got) == want


def test_language_model_works_in_slices(monkeypatch):
    """Numbers, tokens and parts of pairs do not depend on how much is worked on at once."""
    rng = np.random.default_rng(7)
    numbers = rng.integers(0, 1 << 62, 500) >> rng.integers(0, 62, 500)
    texts = pa.array([run(int(n), i) if n else None for i, n in enumerate(rng.integers(0, 90, 30))] + ["", "x"])

    def found():
        tokens = language_model.Tokens(texts)
        parts = language_model.Pairs(tokens.ids, np.unique(tokens.codes()), 9).parts()
        packed = language_model._matrix([numbers, numbers[:3]])
        out = [[b, ids.tolist(), word.tolist(), context.tolist(), at.start, at.stop] for b, ids, word, context, at in parts]
        return packed, language_model._numbers(packed).tolist(), tokens.doc.tolist(), tokens.ids[tokens.word].tolist(), out

    whole = found()
    assert whole[1] == [*numbers.tolist(), *numbers[:3].tolist()] and len(whole[4]) > 2
    assert language_model._numbers(b"").tolist() == [] and len(language_model.Tokens(texts[:0]).ids) == 0
    for size in (1, 10, 300):
        monkeypatch.setattr(language_model, "SLICE", size)
        monkeypatch.setattr(language_model, "RUN_BYTES", size)
        assert found() == whole


def test_language_model_against_single_customers(spark):
    """Predictions agree with a sampler that moves one customer at a time, and beat one word alone."""
    rng = np.random.default_rng(8)
    follow = rng.integers(0, 40, (40, 6))

    def text():
        out = [int(rng.zipf(1.6)) % 40]
        while len(out) < 40:
            out.append(int(follow[out[-1], min(rng.zipf(1.7) - 1, 5)]) if rng.random() < 0.8 else int(rng.zipf(1.5)) % 40)
        return " ".join(f"v{x}" for x in out)

    texts = [(i, text()) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = language_model.learn(docs, sweeps=12)
    got = {r["doc_id"]: r["score"] for r in language_model.score(docs, model).collect()}
    tokens = ids_of([t for _, t in texts])
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    end, d = tokens[0][-1], model.samples[0].discounts
    p = plain.pitman_yor([x for x, h in zip(tokens, held) if not h], end, d, language_model.STRENGTH, 12)
    want = {i: sum(np.log10(p(w, u)) for w, u in zip(x, [end, *x])) for (i, _), x in zip(texts, tokens)}
    for i in want:
        assert got[i] == pytest.approx(want[i], rel=0.03)
    out = [i for (i, _), h in zip(texts, held) if h]
    assert sum(got[i] for i in out) == pytest.approx(sum(want[i] for i in out), rel=0.01)


def test_pairs_of_a_frequent_word_spread(spark):
    """A word that follows all others lies in many buckets, not in one."""
    ids = np.sort(np.random.default_rng(1).integers(0, 1 << 57, 5000).astype(np.uint64))
    codes = 7 * len(ids) + np.arange(len(ids))
    sizes = np.bincount(language_model.Pairs(ids, codes, 64 * 50).bucket)
    assert (sizes > 0).sum() >= 50 and sizes.max() < 200


def test_stirling_draws_match_the_process():
    """Numbers of tables drawn exactly agree with seating customers one by one."""
    rng, n = np.random.default_rng(3), 20000
    tables = np.ones(n, int)
    for seated in range(1, 5):
        tables += rng.random(n) < (1 + 0.5 * tables) / (1 + seated)
    ones = np.full(n, 5)
    drawn = language_model.draw_tables(ones, np.zeros(n), np.ones(n), 0.5, rng)
    assert np.bincount(drawn, minlength=6)[1:] / n == pytest.approx(np.bincount(tables, minlength=6)[1:] / n, abs=0.02)
    many = language_model.draw_tables(np.full(500, 1000), np.zeros(500), np.ones(500), 0.5, rng)
    seats = np.ones(500)
    for seated in range(1, 1000):
        seats += rng.random(500) < (1 + 0.5 * seats) / (1 + seated)
    assert many.mean() == pytest.approx(seats.mean(), rel=0.1)


def test_quality_on_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    both = got.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in both]) > 0.85
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in both)


def test_quality_is_fitted_on_every_labelled_row(spark, monkeypatch):
    """All rows are in groups with both kinds, all rows of a group in its pairs, all scores in the threshold."""
    monkeypatch.setattr(quality, "GROUP", 100)
    monkeypatch.setattr(quality, "RARER", 10)
    rng = np.random.default_rng(5)
    rows = [(i, bool(rng.random() < 0.03), rng.normal(size=2).tolist()) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, good boolean, x array<double>")
    n_good = sum(r[1] for r in rows)
    groups = quality._groups(table, len(rows), n_good).collect()
    assert 25 <= len(groups) <= 30
    seen = {True: set(), False: set()}
    for g in groups:
        sides = {kind: np.frombuffer(g["good" if kind else "bad"]).reshape(-1, 2) for kind in seen}
        assert len(sides[True]) and 0 < len(sides[False]) < 400
        for kind, side in sides.items():
            seen[kind] |= set(map(tuple, side))
        apart = quality._differences(g["number"], sides[True], sides[False], 1)
        assert len(apart) == max(map(len, sides.values()))
        assert len(set(map(tuple, np.round(apart, 9)))) == len(apart)
    assert seen == {kind: {tuple(x) for _, good, x in rows if good == kind} for kind in seen}
    scores = [(float(round(x[0], 1)), good) for _, good, x in rows]
    cut = quality._threshold(spark.createDataFrame(scores, "score double, good boolean").repartition(7))
    wrong = lambda at: sum(good != (score >= at) for score, good in scores)
    assert wrong(cut) == min(wrong(at) for at in [99.0, *{s for s, _ in scores}])


def test_quality_of_awkward_texts(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, labels).count() == len(rows)
    assert quality.classify(docs, labels.limit(0)).filter("predicted = 1").count() == len(rows)
    assert quality.accepted(docs, labels.limit(0)).columns == docs.columns
    assert quality.classify(empty, labels).count() == 0


def test_mixing_comes_near_its_targets(docs, rows):
    got = mixing.taken(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode().split())
    total = sum(size(r[1]) for r in rows)
    assert sum({r["target"]: r["target"] for r in got}.values()) == pytest.approx(1.5 * total)
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] for r in got)
    assert sorted_rows(mixing.taken(docs)) == sorted(map(tuple, got), key=repr)
    mixed = mixing.mixture(docs)
    counts = collections.Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert sum(size(t) * n for (_, t), n in counts.items()) == sum(r["taken"] for r in got)
    assert mixed.columns == docs.columns


def test_mixing_levels_by_repeated_sharing(spark):
    """The closed form equals sharing out again and again."""
    rng = np.random.default_rng(5)
    sizes = {f"s{i}": int(n) for i, n in enumerate(rng.integers(1, 1000, 17))} | {None: 300}
    found = mixing.targets(spark.createDataFrame([*sizes.items()], "source string, source_size long")).collect()
    names = [*sorted(x for x in sizes if x), None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        unit = left / sum(weight[s] for s in free)
        left = 0.0
        for s in list(free):
            target[s] += unit * weight[s]
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    assert {r["source"]: r["target"] for r in found} == pytest.approx(target)


def test_packing(docs, rows):
    tokenizer = packing._tokenizer(packing.VOCABULARY)
    ids = collections.Counter()
    for d, text, *_ in rows:
        own = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        half, at = 512, 0
        while at < len(own):
            left = len(own) - at
            step = 1024 if left >= 1024 else half if left >= half else left
            ids[d, at, step, zlib.crc32(own[at : at + step].tobytes()), len(own)] += 1
            at += step
    got = packing.pack(docs).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == ids
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(sequences) <= total / 1024 * 1.05 + 2


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab' \t\n.,1é ", max_size=25), min_size=1, max_size=6))
def test_token_ids_equal_the_tokenizers(texts):
    tokenizer = packing._tokenizer(packing.VOCABULARY)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    ids, counts = packing.token_ids(pa.array(texts))
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_patterns_cover_the_demand_near_the_bound():
    rng = np.random.default_rng(1)
    demand = rng.integers(0, 300, 256)
    demand[128:] = 0
    plan = packing.patterns(demand, 256)
    assert (sum(p * n for p, n in plan) == demand).all()
    assert all((p * np.arange(1, 257)).sum() <= 256 for p, _ in plan)
    assert sum(n for _, n in plan) <= (demand * np.arange(1, 257)).sum() / 256 * 1.01 + 2


@pytest.fixture(scope="session")
def vectors(spark):
    rng = np.random.default_rng(2)
    out = {i: rng.normal(size=8).round(3).tolist() for i in range(400)}
    out |= {i: out[1] for i in range(400, 460)}  # ties
    out[500] = [0.0] * 8
    rows = [(i, v, 0) for i, v in out.items()]
    rows += [(600, None, 0), (650, [1.0, None] + [0.0] * 6, 0), (700, [float("nan")] * 8, 0), (None, out[3], 0), (3, out[3], 1)]
    return out, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(6)


def test_exact_top_k(spark, vectors):
    table, frame = vectors
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in table.items()}
    want = plain.ranked(whole, 50, 5, lambda a, b: int(a @ b))
    assert sorted_rows(topk.top_k(frame)) == sorted(want, key=repr)
    assert topk.top_k(frame.limit(0)).count() == 0


def test_neighbours(vectors):
    table, frame = vectors
    exact = {i: np.array(v, np.float32).astype(float) for i, v in table.items() if any(v)}
    want = plain.ranked(exact, 20, 20, lambda a, b: float((a * b).sum()))
    got = sorted_rows(neighbours.nearest(frame))
    assert len(got) == len(want)
    pairs = {(r[0], r[2]) for r in want}
    assert len({(r[0], r[2]) for r in got} & pairs) / len(pairs) >= 0.9
    for q, _, i, score in got:
        assert score == pytest.approx(float((exact[q] * exact[i]).sum()), abs=1e-12)
    whole = sorted_rows(neighbours.nearest(frame, share=1.0))
    assert [r[:3] for r in whole] == [r[:3] for r in sorted(want, key=repr)]
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_cells_are_visited_in_order_of_distance():
    rng = np.random.default_rng(4)
    left, right = rng.random(9), rng.random(9)
    cells = neighbours.visit(left, right, np.ones(81, int), 81)
    total = (left[:, None] + right).ravel()
    assert sorted(cells) == list(range(81)) and (np.diff(total[cells]) >= 0).all()


def test_empty_tables(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.representatives(empty).count() == 0
    assert licenses.scan(empty).count() == 0 and mixing.taken(empty).count() == 0
    assert packing.pack(empty).count() == 0 and language_model.scores(empty).count() == 0


def test_mixing_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = queries.QUERIES["op10_mixing"](spark, sf)
    columns = ", ".join(got.columns)
    want = con.execute(f"select {columns} from ({queries.ORACLES['op10_mixing']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_queries_are_registered():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_pipeline_stages(spark, sf):
    """Each stage against the plain version of its operator on the same input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        before = docs.select("doc_id", "text", "source").collect()
        docs = corpus_pipeline.stage(function(spark, docs, sf), name)
        if name != "packing":
            assert docs.columns == columns
        after = docs.collect()
        if name == "near_duplicates":
            want = plain.similar_survivors([(r["doc_id"], r["text"]) for r in before], 5, 0.8)
            assert sorted(r["doc_id"] for r in after) == want
        elif name == "repeats":
            want = {x[0]: x[1] - x[2] for x in plain.repeats([(r["doc_id"], r["text"]) for r in before], 50)}
            assert {r["doc_id"]: len(r["text"].encode().split()) for r in after} == want
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "mixing":
            con = duckdb.connect()
            con.register("documents", pa.Table.from_pylist([r.asDict() for r in before]))
            want = con.execute(f"select doc_id, taken // size from ({mixing.ORACLE}) where taken > 0").fetchall()
            sized = {r["doc_id"] for r in before if (r["text"] or "").split()}
            got = collections.Counter(r["doc_id"] for r in after)
            assert {k: n for k, n in got.items() if k in sized} == dict(want)
        elif name == "packing":
            tokens = sum(len(packing._tokenizer(packing.VOCABULARY).encode(r["text"]).ids) + 1 for r in before)
            assert sum(r["length"] for r in after) == tokens
        assert 0 < len(after)
    assert corpus_pipeline.run(spark, sf).count() == len(after)


def test_stages_carry_columns_of_any_name(spark, sf, rows):
    """Columns named like the operators' own ones come out as they went in."""
    names = ["fp", "bands", "sketch", "_row", "rate", "score", "component_id", "_kept", "_source", "key", "size"]
    docs = spark.createDataFrame(rows, DOCS)
    clash = docs.select("*", *[F.concat_ws("-", F.lit(n), "doc_id").alias(n) for n in names])
    for name, function in corpus_pipeline.STAGES[:-1]:
        got = function(spark, clash, sf)
        assert got.columns == clash.columns, name
        plainly = sorted_rows(function(spark, docs, sf).select("doc_id", "text"))
        assert sorted_rows(got.select("doc_id", "text")) == plainly, name
        for r in got.select("doc_id", *[F.col(f"`{n}`") for n in names]).collect():
            assert list(r[1:]) == [n if r[0] is None else f"{n}-{r[0]}" for n in names], name
    assert simhash.representatives(clash).columns == clash.columns


def test_rows_without_id_draw_apart(spark):
    docs = spark.createDataFrame([(None, f"w{i} x y", "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    mixed = mixing.taken(docs).groupBy((F.col("target")).alias("target")).agg(F.sum("taken").alias("taken")).collect()
    for r in mixed:
        assert r["taken"] == pytest.approx(r["target"], rel=0.25)


def similar_rows():
    """Texts, copies with so many changed words that their similarities lie about 0.8, and awkward ones."""
    rng, texts = np.random.default_rng(5), [None, "", "  ", "one", "One", "a b", "a b c", "A b c"]
    for seed in range(60):
        words = run(int(rng.integers(60, 900)), 900 + seed, 3000).split()
        texts.append(" ".join(words))
        for changes in rng.integers(1, max(2, len(words) // 25), 3):
            copy = list(words)
            for at in rng.integers(0, len(copy), changes):
                copy[at] = f"new{rng.integers(1 << 30)}"
            texts.append(" ".join(copy))
    return [(i, t, "en", "a", 0) for i, t in enumerate(texts)]


def test_near_duplicate_stage_by_brute_force(spark):
    rows = similar_rows()
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, DOCS).repartition(4), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == plain.similar_survivors([x[:2] for x in rows], 5, 0.8)


def test_similar_sets_in_crowded_clusters(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_BYTES", 1 << 12)
    rows = similar_rows()
    kept = jaccard.representatives(spark.createDataFrame(rows, DOCS).repartition(4))
    assert sorted(r["doc_id"] for r in kept.collect()) == plain.similar_survivors([x[:2] for x in rows], 5, 0.8)


def spellings(parsed):
    """Every text that an expression of literals, alternatives and optional parts matches."""
    out = [""]
    for kind, value in parsed:
        if str(kind) == "LITERAL":
            more = [chr(value)]
        elif str(kind) == "IN":
            more = [chr(c) for k, v in value for c in (range(v[0], v[1] + 1) if str(k) == "RANGE" else [v])]
        elif str(kind) == "BRANCH":
            more = [x for branch in value[1] for x in spellings(branch)]
        elif str(kind) == "SUBPATTERN":
            more = spellings(value[-1])
        else:
            assert str(kind) == "MAX_REPEAT" and value[:2] == (0, 1)
            more = ["", *spellings(value[2])]
        out = [a + b for a in out for b in more]
    return out


def test_license_names_in_every_spelling(spark):
    """Each alternative of each name holds a keyword of its rules and is found."""
    names = [(label, text, word) for label, name, word in licenses.FAMILIES for text in spellings(re._parser.parse(name))]
    for _, text, word in names:
        assert any(w in text for w in (licenses._CC_WORDS if word == "c" else (word,))), text
    frame = spark.createDataFrame([(i, x[1]) for i, x in enumerate(names)], "doc_id long, text string")
    got = licenses.detect(frame).select("doc_id", F.col("detections.label").alias("labels")).collect()
    assert len(got) == len(names)
    for r in got:
        assert names[r["doc_id"]][0] in r["labels"], names[r["doc_id"]]


def test_license_names_with_joined_versions(spark):
    texts = [
        ("GPLv3", "gpl-3"), ("LGPLv2.1", "lgpl-2.1"), ("LGPL v3", "lgpl-3"), ("Apache License v2.0", "apache-2"),
        ("GNU General Public License v3", "gpl,gpl-3"), ("CC Attribution-ShareAlike 4.0", "cc-by-sa"),
        ("Do What The Fuck You Want To Public License", "wtfpl"),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = [r["labels"] for r in licenses.scan(frame).orderBy("doc_id").collect()]
    assert [x.split(",")[-1] for x in got] == [x.split(",")[-1] for _, x in texts]


def norms_of(sigma, n=1500):
    rng = np.random.default_rng(17)
    return rng.normal(size=(n, 16)) * np.exp(sigma * rng.normal(size=(n, 1)))


@pytest.mark.parametrize("sigma", [0.0, 0.5, 1.0])
def test_neighbours_of_unequal_norms(spark, monkeypatch, sigma):
    """The largest inner products, also where the codebooks and the bound come from a part of the vectors."""
    monkeypatch.setattr(neighbours, "SAMPLE", 300)
    exact = dict(enumerate(norms_of(sigma)))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in exact.items()], "vec_id long, embedding array<double>")
    want = plain.ranked(exact, 20, 20, lambda a, b: float((a * b).sum()))
    assert [r[:3] for r in sorted_rows(neighbours.nearest(frame))] == [r[:3] for r in sorted(want, key=repr)]


def test_cells_beyond_the_limit_are_left_out():
    rng = np.random.default_rng(4)
    left, right = rng.random(9), rng.random(9)
    total = (left[:, None] + right).ravel()
    cells = neighbours.visit(left, right, np.ones(81, int), np.inf, 0.8)
    assert sorted(cells) == np.flatnonzero(total <= 0.8).tolist()


def test_neighbours_of_small_tables(spark):
    """All candidates where there are fewer than k, k otherwise."""
    for n in (2, 3, 10, 21, 25, 30):
        exact = dict(enumerate(norms_of(0.5, n)))
        rows = [(i, v.tolist()) for i, v in exact.items()]
        got = sorted_rows(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
        want = plain.ranked(exact, 20, 20, lambda a, b: float((a * b).sum()))
        assert [r[:3] for r in got] == [r[:3] for r in sorted(want, key=repr)]


def clustered(n=6000, centres=60):
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(centres, 32))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    return middles[rng.integers(0, centres, n)] + rng.normal(size=(n, 32)) * 0.15 / np.sqrt(32)


@pytest.mark.parametrize("kind", ["unit", "unequal", "clustered"])
def test_neighbours_that_stop_early(spark, monkeypatch, kind):
    """Recall against brute force, cells cut into parts, and few rows visited where vectors cluster."""
    monkeypatch.setattr(neighbours, "SAMPLE", 1500)
    monkeypatch.setattr(neighbours, "PART", 100)
    stops, real = [], neighbours.stop_at
    monkeypatch.setattr(neighbours, "stop_at", lambda *args: stops.append(real(*args)) or stops[-1])
    x = clustered() if kind == "clustered" else norms_of(0.0 if kind == "unit" else 0.5, 3000)
    odd = [(10**6 + i, [float(i + 1)] * 3) for i in range(40)]  # another length
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + odd
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = collections.defaultdict(set)
    for q, _, i, _ in sorted_rows(neighbours.nearest(frame, recall=neighbours.RECALL)):
        found[q].add(i)
    score = x[::20] @ x.T
    score[np.arange(len(score)), np.arange(0, len(x), 20)] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    hits = sum(len(found[20 * q].intersection(w.tolist())) for q, w in enumerate(want))
    assert hits >= 0.95 * want.size
    assert len(found[10**6]) == 20  # all on its own length
    if kind == "clustered":
        assert stops[0][0] < 0.3 * len(x)
