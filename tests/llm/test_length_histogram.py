import random

from pressloom.llm import length_histogram, tokenizer_files


def docs(spark):
    rng = random.Random(4)
    texts = [None, "", "one", "one", "two words", "<|endoftext|>", *(" ".join(["word"] * rng.randrange(3000)) for _ in range(80))]
    return texts, spark.createDataFrame([(k % 50, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, length int, block int")


def test_histogram_answers_every_limit(spark):
    texts, table = docs(spark)
    lengths = sorted(len(tokenizer_files.encode(t or "")) for t in texts)
    hist = length_histogram.histogram(length_histogram.encoded_lengths(table.select("text")))
    rows = {r["length"]: r for r in length_histogram.at_limits(hist).collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, r in rows.items():
        up = [x for x in lengths if x >= limit]
        assert (r["n_docs"], r["n_tokens"]) == (lengths.count(limit), lengths.count(limit) * limit)
        assert (r["n_docs_up"], r["n_tokens_up"]) == (len(up), sum(up))
        assert (r["truncated_tokens"], r["cut_docs"]) == (sum(min(x, limit) for x in lengths), sum(x > limit for x in lengths))
        assert r["cut_tokens"] == sum(max(x - limit, 0) for x in lengths)
        assert (lengths[r["rank_low"] - 1], lengths[r["rank_high"] - 1]) == (limit, limit)
    for limit in (0, 1, 777, 10**6):
        one = length_histogram.truncated_total(hist, limit).collect()[0]
        assert (one["n_tokens"], one["cut_docs"]) == (sum(min(x, limit) for x in lengths), sum(x > limit for x in lengths))
    asked = [0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["share"]: r["length"] for r in length_histogram.quantiles(hist, asked).collect()}
    assert got == {q: next(x for k, x in enumerate(lengths, 1) if k >= q * len(lengths) - 1e-9) for q in asked}


def test_query_and_empty_table(spark):
    _, table = docs(spark)
    assert length_histogram.report(table).count() > 40
    empty = length_histogram.histogram(length_histogram.encoded_lengths(table.select("text").where("false")))
    assert empty.collect() == [] and length_histogram.at_limits(empty).collect() == []
    assert length_histogram.truncated_total(empty, 5).collect()[0]["n_tokens"] is None
