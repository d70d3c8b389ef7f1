import numpy as np

from pressloom.llm import quality_classifier


def test_repeated_numbers_are_learnt_once(spark):
    rows = [(k, f"good words {k} here" if k % 2 else f"### {k} ### bad") for k in range(40)]
    schema = "doc_id long, text string"
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    once = quality_classifier.train(spark.createDataFrame(rows, schema), labels)
    assert np.array_equal(quality_classifier.train(spark.createDataFrame(rows + rows[:5] * 30, schema), labels), once)


def test_vectors_beyond_the_drivers_share(spark, monkeypatch):
    """Read in parts in every epoch, the same weights."""
    rows = [(k, f"good words {k} here" if k % 2 else f"### {k} ### bad") for k in range(40)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    once = quality_classifier.train(docs, labels)
    monkeypatch.setattr(quality_classifier, "MAX_BYTES", 0)
    monkeypatch.setattr(quality_classifier, "PARTS", 5)
    again = quality_classifier.train(docs, labels)
    assert again.any() and once.any()
    monkeypatch.setattr(quality_classifier, "MAX_BYTES", 1 << 30)
    assert np.array_equal(quality_classifier.train(docs, labels), again)


def test_whole_words_count():
    """What stands beyond the 64th character of a word is part of its shape."""
    a, b = (quality_classifier.vector("a1" * 40 + end)[0].tolist() for end in ("", "-#"))
    assert a != b and quality_classifier._word("a1" * 40)[1] != quality_classifier._word("a1" * 40 + "-#")[1]
