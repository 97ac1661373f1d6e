import itertools
import re
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import boilerplate, crf, lines, quality

SF = "/root/testdata/sf0.01"


def chains(chain, scores, n):
    for labels in itertools.product((0, 1), repeat=n):
        yield labels, (sum(scores[i, y] for i, y in enumerate(labels))
                       + sum(chain.move[a, b] for a, b in zip(labels, labels[1:])))


def test_recursions_match_all_labellings():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 6, 2, 0, 4])
    chain = crf.Chain(rng.normal(size=(2, 5)), rng.normal(size=(2, 2)))
    scores = chain.scores(rng.normal(size=(lengths.sum(), 5)))
    got, pairs, norm = crf.marginals(chain, scores, crf.Layout(lengths))
    best = crf.viterbi(chain, scores, crf.Layout(lengths))
    want, want_pairs, want_norm, at = np.zeros_like(got), np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        if not n:
            continue
        own = scores[at:at + n]
        total = sum(np.exp(s) for _, s in chains(chain, own, n))
        for labels, s in chains(chain, own, n):
            for i, y in enumerate(labels):
                want[at + i, y] += np.exp(s) / total
            for a, b in zip(labels, labels[1:]):
                want_pairs[a, b] += np.exp(s) / total
        want_norm += np.log(total)
        assert tuple(best[at:at + n]) == max(chains(chain, own, n), key=lambda x: x[1])[0]
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs) and np.isclose(norm, want_norm)


def test_fit_finds_a_chain_that_neighbours_decide():
    rng = np.random.default_rng(1)
    lengths = np.full(60, 12)
    labels = np.concatenate([np.repeat(rng.integers(0, 2, 4), 3) for _ in lengths])
    features = np.stack([labels + rng.normal(size=len(labels)), np.ones(len(labels))], 1)
    chain = crf.fit(features, lengths, labels)
    found = crf.viterbi(chain, chain.scores(features), crf.Layout(lengths))
    alone = features[:, 0] > 0.5
    assert (found == labels).mean() > (alone == labels).mean() + 0.05


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(marked)


@pytest.mark.parametrize("text", [t for t in cases.texts() if not t or len(t) < 5000]
                         + ["a b c a b c a b", "a a a a", "x\nx\n\n\nx y\nx", "#a *b |", "b́ ퟿\U0001F600 c"])
def test_counts(text):
    assert lines.text_counts(text) == brute_counts(text)


def test_line_table():
    features, weights = lines.line_table("one two\n\n  \nthree\none two")
    assert features.shape == (3, lines.N_FEATURES) and list(weights) == [7, 5, 7]
    assert features[2, lines.N_OWN - 1] == 1 and features[0, lines.N_OWN - 1] == 0
    assert (features[1, lines.N_OWN:2 * lines.N_OWN] == features[0, :lines.N_OWN]).all()
    assert len(lines.line_table(None)[1]) == len(lines.line_table(" \n ")[1]) == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_of_the_held_out_fold(spark, tables):
    docs, labels = tables
    got = quality.quality_scores(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.fold_of(F.col("doc_id")) == 0, 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels), quality.fit_quality(docs, turned)
    assert (a.emit == b.emit).all() and (a.move == b.move).all()


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    rows = quality.quality_scores(docs, cases.labels(spark)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by = dict(zip([r.text for r in docs.collect()], rows))
    assert by[None].score == by[""].score == 0
    kept = quality.keep_good(docs, cases.labels(spark))
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    chain = boilerplate.fit_boilerplate(docs, cases.labels(spark))
    for r, d in zip(boilerplate.line_rules(docs, chain).collect(), docs.collect()):
        if len(d.text or "") < 5000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(d.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.content_share >= 0.5)


def test_empty_tables(spark):
    none = cases.empty(spark)
    assert quality.quality_scores(none, cases.labels(spark)).collect() == []
    assert {round(r.score, 9) for r in quality.quality_scores(cases.documents(spark), cases.labels(spark, [(None, None, None)])).collect()} <= {0.0, 0.5}
    assert boilerplate.line_rules(none, boilerplate.fit_boilerplate(none, cases.labels(spark))).collect() == []


def test_line_rules_on_labelled_documents(spark, tables):
    docs, labels = tables
    rows = boilerplate.line_rules(docs, boilerplate.fit_boilerplate(docs, labels)).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert np.mean([r.kept for r in good]) > 0.97
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.05


def test_long_texts_give_lines_from_anywhere():
    taken = np.zeros(40, int)
    for i in range(4000):
        text = "\n".join(f"line {i} {n}" for n in range(40))
        part = quality.window(np.arange(40)[:, None], text, 12).ravel()
        assert 1 <= len(part) <= 12 and (np.diff(part) == 1).all()
        assert part.tolist() == quality.window(np.arange(40)[:, None], text, 12).ravel().tolist()
        taken[part] += 1
    assert taken.min() > 0.8 * taken.mean() and taken.max() < 1.2 * taken.mean()
    assert quality.window(np.arange(12)[:, None], "short", 12).ravel().tolist() == list(range(12))


def test_the_fit_sees_the_end_of_long_texts(spark):
    """Good and bad texts that differ in their later lines only, far behind the first ones."""
    same = "\n".join(["A plain line of words that says little."] * 150)
    good = [(i, same + "\n" + "\n".join([f"Some words of prose number {i} end here."] * 200)) for i in range(40)]
    bad = [(100 + i, same + "\n" + "\n".join([f"### $$$ {i} &&& ||| %%%"] * 200)) for i in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert min(scores[i] for i, _ in good) > max(scores[i] for i, _ in bad) + 0.2


def test_scores_are_weighted_marginals_over_all_labellings(spark):
    rng = np.random.default_rng(5)
    chain = crf.Chain(rng.normal(size=(2, lines.N_FEATURES)), rng.normal(size=(2, 2)))
    texts = ["One line.", "a b\n\nSecond, longer line of words\nc", "###\nx\n###\nThe end.\n  \nno", "", None, " \n "]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.s for r in rows.select("id", quality.scorer(chain)(F.col("text")).alias("s")).collect()}
    for i, text in enumerate(texts):
        features, weights = lines.line_table(text)
        own = chain.scores(features)
        total = share = 0.0
        for labels, s in chains(chain, own, len(own)):
            total += np.exp(s)
            share += np.exp(s) * sum(w for w, y in zip(weights, labels) if y)
        assert np.isclose(got[i], share / total / weights.sum() if len(own) else 0.0)
