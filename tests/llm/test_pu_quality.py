"""Positive-unlabelled quality scores: risk against a plain version, held-out accuracy, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackyard.llm import pu_quality as P
from stackyard.llm import queries
from stackyard.llm.common import documents

SF, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ------------------------------------------------------------ risk and steps

def plain_risk(x, good, w, prior, penalty=P.PENALTY):
    """(risk, negatives' risk), row by row."""
    loss = lambda z: max(-z, 0) + math.log1p(math.exp(-abs(z)))
    z = [sum(a * b for a, b in zip(r, w)) for r in x]
    zp = [v for v, g in zip(z, good) if g]
    negative = sum(loss(-v) for v in z) / len(z) - prior * sum(loss(-v) for v in zp) / len(zp)
    keep = 0.5 * penalty * (sum(v * v for v in w[:-1]) + 1e-3 * w[-1] ** 2)
    return prior * sum(loss(v) for v in zp) / len(zp) + max(0, negative) + keep, negative


def frame(seed, n=200, d=5, share=0.4):
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.6
    x = rng.normal(size=(n, d)) + y[:, None] * 1.2
    good = y & (rng.random(n) < share)
    return np.concatenate([x, np.ones((n, 1))], axis=1), good, y


def measured(x, good, prior):
    sums = P.Sums(x.shape[1])
    # the sums of two parts, as tasks have them
    return lambda w: P.risk_and_step(sums, sum(sums.of(x[k::2], good[k::2], w) for k in (0, 1)), w, prior)


@pytest.mark.parametrize("seed", range(5))
def test_risk_and_slope(seed):
    x, good, _ = frame(seed)
    measure = measured(x, good, 0.6)
    w = np.random.default_rng(seed).normal(size=x.shape[1]) * 0.5
    risk, negative, step = measure(w)
    assert (risk, negative) == pytest.approx(plain_risk(x, good, w, 0.6))
    # the step goes down what it should go down (or up, where the negatives' risk is below zero)
    after = plain_risk(x, good, w + 1e-4 * step, 0.6)
    assert after[1] > negative if negative < 0 else after[0] < risk


def test_descent_ends_at_the_least_risk():
    x, good, y = frame(11, n=3000)
    w, risks = P.descend(measured(x, good, 0.6), np.zeros(x.shape[1]))
    least = plain_risk(x, good, w, 0.6)[0]
    assert least == pytest.approx(min(risks))
    rng = np.random.default_rng(0)
    assert all(plain_risk(x, good, w + rng.normal(size=len(w)) * 0.05, 0.6)[0] >= least - 1e-9 for _ in range(20))
    assert ((P.sigmoid(x @ w) > 0.5) == y).mean() > 0.85


def test_negative_risk_below_zero_turns_the_step_round():
    x, good, _ = frame(3, n=60, d=30, share=0.15)  # few positives, many columns: the negatives' risk can be pushed below zero
    measure = measured(x, good, 0.95)
    far = np.zeros(x.shape[1])
    far[:30] = x[good].mean(axis=0)[:30] - x.mean(axis=0)[:30]
    far = next(far * k for k in (1, 3, 10, 30, 100) if measure(far * k)[1] < 0)
    _, negative, step = measure(far)
    assert measure(far + step)[1] > negative
    w, risks = P.descend(measure, far, 25)
    assert len(risks) > 1 and measure(w)[1] > negative


# ------------------------------------------------------------ statistics

def test_pieces_do_not_matter(monkeypatch):
    rnd = random.Random(4)
    texts = ["\n".join(" ".join(rnd.choice(["the", "OF", "a,", "b.", "12", "x*", "ñandú", "THE!!"]) for _ in range(rnd.randint(0, 9)))
                       for _ in range(rnd.randint(0, 30))).encode() for _ in range(60)]
    whole = P.text_statistics(texts)
    assert whole.shape == (60, P.N_FEATURES) and np.isfinite(whole).all()
    one = np.concatenate([P.text_statistics([t]) for t in texts])
    assert np.allclose(whole, one)
    monkeypatch.setattr(P, "PIECE_BYTES", 300)
    lines = [t for t in texts if b"\n" in t]
    assert np.allclose(P.text_statistics(lines)[:, :24], np.concatenate([P.text_statistics([t])[:, :24] for t in lines]))


def test_statistics_of_a_known_text():
    x = P.text_statistics([b"The cat sat.\nThe cat sat.\nOH NO!! 42 the the"])[0]
    assert x[0] == pytest.approx(math.log1p(11)) and x[1] == pytest.approx(math.log1p(44))
    assert x[4] == pytest.approx(2 / 11)  # OH NO!!
    assert x[4 + P.WORD_SHARES] == pytest.approx(7 / 11)  # The cat sat. OH NO!! 42 the
    assert x[4 + P.WORD_SHARES + 3] == pytest.approx(1 / 11)  # the the
    assert x[4 + P.WORD_SHARES + 5] == pytest.approx(1 / 3)  # one of three lines repeats


# ------------------------------------------------------------ whole operator

def quality(spark, sf):
    return {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}


def test_held_out_documents_are_told_apart(spark):
    got = queries.op13_pu_quality(spark, MID).collect()
    assert len(got) == documents(spark, MID).count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    labels = quality(spark, MID)
    held = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for y, _, s in held if y == 1], [s for y, _, s in held if y == 0]
    ranked = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert ranked > 0.97
    assert sum(y == p for y, p, _ in held) / len(held) > 0.93
    assert sum(p for y, p, _ in held if y == 1) / len(good) > 0.97  # clean documents are kept


def test_held_out_labels_are_not_read(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(P.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    turned = turned.unionByName(docs.where(P.is_held_out()).select("doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic")))
    one, a = P.score_quality(docs, labels)
    other, b = P.score_quality(docs, turned)
    assert a.prior == b.prior and (a.weights == b.weights).all()
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_partitions_and_other_columns_do_not_matter(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    one = dict(P.score_quality(docs.coalesce(1), labels)[0].select("doc_id", "score").collect())
    odd = docs.repartition(9).withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "x": F.lit(1), "good": F.lit(False), "quality": F.lit(0)})
    many = dict(P.score_quality(odd, labels)[0].select("doc_id", "score").collect())
    assert max(abs(one[k] - many[k]) for k in one) < 1e-4


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (None, "no id here"), (None, None), (5, "x" * 50_000), (6, "ab " * 9_000),
       (7, "ñandú ¶ 😀 \x00"), (8, "Same text here."), (8, "Same text here."), (8, "Other text under one id.")]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    labels = spark.createDataFrame([(4, 1), (8, 1), (6, 0), (6, 1), (7, None), (None, 1), (99, 1), (8, 1)], "doc_id long, quality int")
    got = P.score_quality(docs, labels)[0].collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _ in ODD)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True, True]
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1


def test_without_labels_and_without_documents(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in P.score_quality(docs, none)[0].collect()} == {0.5}
    bad = spark.createDataFrame([(i, 0) for i in range(1, 9)], "doc_id long, quality int")
    out, model = P.score_quality(docs, bad)
    assert [r["score"] for r in out.collect()] == pytest.approx([model.prior] * len(ODD))
    assert P.score_quality(docs.limit(0), bad)[0].collect() == []
