import random
import zlib

import numpy as np

from pressloom.llm import quality_classifier as qc


def tables(spark, count=400):
    rng = random.Random(12)
    word = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("n", "r", "st", "l")]
    rows, labels = [], []
    for k in range(count):
        words = [rng.choice(word) for _ in range(rng.randrange(20, 200))]
        if k % 5 == 0:
            words = rng.choice(([f"{w}###" for w in words], [w for w in words for _ in range(5)], [x for w in words for x in (w, "|")]))
        rows.append((k, " ".join(words).capitalize() + ".", k % 7, "q"))
        labels.append((k, int(k % 5 > 0), 0))
    rows += [(None, None, 1, "q"), (count, "", 1, "q"), rows[3]]
    labels += [(None, 0, 0), (7, None, 0), (10**6, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score int, label string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_columns(spark):
    docs, labels = tables(spark)
    got = qc.report(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert len(unseen) > 60 and sum(r["predicted"] == int(r["doc_id"] % 5 > 0) for r in unseen) >= 0.97 * len(unseen)
    assert qc.accepted(docs, labels).columns == docs.columns


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = tables(spark, 120)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality", "toxic")
    assert np.array_equal(qc.train(docs, labels), qc.train(docs, flipped))
    assert np.array_equal(qc.train(docs, labels), qc.train(docs.repartition(7), labels.repartition(5)))


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark, 20)
    assert {r["score"] for r in qc.report(docs, labels.where("false")).collect()} == {0.5}
    assert qc.report(docs.where("false"), labels).collect() == []


def test_updates_follow_the_regularised_leader():
    """Weights equal the closed form of the leader after each update, coordinate by coordinate."""
    rows = [(np.array([1, 3], np.int32), np.array([0.5, 1.0], np.float32), 1), (np.array([1], np.int32), np.array([2.0], np.float32), 0)] * 5
    size = (1 << 3) + 1
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(z[i]) <= qc.L1:
            return 0.0
        return -(z[i] - (qc.L1 if z[i] > 0 else -qc.L1)) / ((qc.BETA + n[i] ** 0.5) / qc.ALPHA + qc.L2)

    for _ in range(2):
        for slots, values, label in rows:
            pairs = [*zip(slots.tolist(), values.tolist()), (size - 1, 1.0)]
            w = {i: weight(i) for i, _ in pairs}
            error = qc.logistic(sum(w[i] * x for i, x in pairs)) - label
            for i, x in pairs:
                g = error * x
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / qc.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    assert np.allclose(qc.fit(rows, bits=3, epochs=2), [weight(i) for i in range(size)], atol=1e-6)
