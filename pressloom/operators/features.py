"""TF-IDF weights of headlines as a long table, and term rankings inside clusters."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.text import SPACE, WORD
from pressloom.session import StepTables

ANY_WORD = f"{WORD}{{2,}}"
#: Characters of the clusters whose terms are ranked in a group of their own.
CLUSTER_CHARS = 8_000_000
HEBREW_WORD = r"\A[א-ת]{2,}\z"


def words(text: Column, stopwords: Sequence[str] = (), only: str | None = None) -> Column:
    """Lower-case runs of two or more word characters, in order, without the stop words.

    `only` keeps the runs that match a pattern as a whole.
    """
    tokens = F.regexp_extract_all(F.lower(text), F.lit(ANY_WORD), F.lit(0))
    if only:
        tokens = F.filter(tokens, lambda w: w.rlike(only))
    if stopwords:
        tokens = F.filter(tokens, lambda w: ~w.isin(*stopwords))
    return tokens


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """Runs of `low` to `high` neighbouring tokens joined by a space."""
    parts = []
    for n in range(low, high + 1):
        if n == 1:
            parts.append(tokens)
        elif n == 2:
            pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), _with_space)
            parts.append(F.slice(pairs, 1, F.greatest(F.size(tokens) - 1, F.lit(0))))
        else:
            starts = F.sequence(F.lit(1), F.size(tokens) - n + 1)
            runs = F.transform(starts, _run_of(tokens, n))
            parts.append(F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _run_of(tokens: Column, n: int):
    return lambda i: F.array_join(F.slice(tokens, i, n), " ")


def _with_space(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit(" "), b)


class CharGrams(NamedTuple):
    """Character n-grams as a second block of features, beside the words, and how much that block weighs."""

    weight: float = 0.5
    ngram_range: tuple[int, int] = (3, 5)
    min_df: int = 2
    max_df: float = 0.8


#: Stands before a character n-gram where it is kept among words; no word holds it.
CHAR_MARK = "\x01"


def characters(text: Column) -> Column:
    """The characters of the lower-case text by code point, each run of white space of two or more as one blank."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), f"{SPACE}{{2,}}", " "), F.lit(r"(?s)."), F.lit(0))


def char_ngrams(chars: Column, low: int = 3, high: int = 5) -> Column:
    """All substrings of `low` to `high` characters; a text that is shorter than `low` has none."""
    every = F.transform(chars, lambda c, i: i)
    starts = lambda n: F.slice(every, 1, F.greatest(F.size(chars) - (n - 1), F.lit(0)))
    run = lambda n: F.transform(starts(n), lambda i: F.concat(*[F.get(chars, i + j) for j in range(n)]))
    return F.concat(*[run(n) for n in range(low, high + 1)])


def char_counts(docs: DataFrame, doc: str, text: Column, ngram_range: tuple[int, int] = (3, 5)) -> DataFrame:
    """(doc, term, tf) of the character n-grams of each text."""
    cut = docs.select(doc, characters(text).alias("_chars"))
    terms = cut.select(doc, F.explode(char_ngrams(F.col("_chars"), *ngram_range)).alias("term"))
    return terms.groupBy(doc, "term").agg(F.count("*").alias("tf"))


def without_words(cut: DataFrame, doc: str, stopwords: DataFrame) -> DataFrame:
    """Rows (doc, _tokens) without the words of a table (word), which may have any length: an anti join per token."""
    each = cut.select(doc, F.posexplode("_tokens").alias("_at", "word"))
    kept = each.join(stopwords.select("word").distinct(), "word", "left_anti")
    order = F.array_sort(F.collect_list(F.struct("_at", "word")))
    return kept.groupBy(doc).agg(order.alias("_all")).select(doc, F.col("_all.word").alias("_tokens"))


def term_counts(
    docs: DataFrame, doc: str, text: Column, ngram_range: tuple[int, int] = (1, 2), stopwords: Sequence[str] | DataFrame = ()
) -> DataFrame:
    """(doc, term, tf).  The tokens are cut once, before the n-grams refer to them several times.

    `stopwords` is a short list, or a table with the column `word` of any size.
    """
    if isinstance(stopwords, DataFrame):
        cut = without_words(docs.select(doc, words(text).alias("_tokens")), doc, stopwords)
    else:
        cut = docs.select(doc, words(text, stopwords).alias("_tokens"))
    terms = cut.select(doc, F.explode(ngrams(F.col("_tokens"), *ngram_range)).alias("term"))
    return terms.groupBy(doc, "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, n_docs: Column, min_df: int, max_df: float, copies: str | None = None) -> DataFrame:
    """(term, df, idf) of the terms found in at least `min_df` documents and at most a share `max_df` of them.

    `copies` names a column that says for how many equal documents a row stands.
    """
    df = F.sum(copies) if copies else F.count("*")
    terms = counts.groupBy("term").agg(df.alias("df"))
    kept = terms.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * n_docs))
    return kept.withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)


def tfidf(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text_for_cluster",
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 2,
    max_df: float = 0.8,
    stopwords: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """(doc, term, w): raw count times smoothed inverse document frequency, each document scaled to length one.

    The texts and the counts are each read more than once, so both are written down in between.
    """
    return _weights(docs, doc, text, lambda rows: term_counts(rows, doc, F.col(text), ngram_range, stopwords), min_df, max_df)


def char_tfidf(docs: DataFrame, doc: str = "doc_id", text: str = "text_for_cluster", ngram_range: tuple[int, int] = (3, 5), min_df: int = 2, max_df: float = 0.8) -> DataFrame:
    """(doc, term, w) as `tfidf` gives them, over character n-grams."""
    return _weights(docs, doc, text, lambda rows: char_counts(rows, doc, F.col(text), ngram_range), min_df, max_df)


def _weights(docs: DataFrame, doc: str, text: str, counted: Callable[[DataFrame], DataFrame], min_df: int, max_df: float) -> DataFrame:
    steps = StepTables(docs.sparkSession, "tfidf")
    docs = steps.save(docs.select(doc, text), "texts")
    counts = steps.save(counted(docs), "term-counts")
    n_docs = docs.agg(F.count("*")).scalar()
    raw = counts.join(vocabulary(counts, n_docs, min_df, max_df), "term")
    raw = raw.select(doc, "term", (F.col("tf") * F.col("idf")).alias("w"))
    # A window over one document: its rows are the distinct terms of one headline.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return raw.withColumn("w", F.col("w") / norm)


def cluster_top_terms(
    articles: DataFrame,
    cluster: str = "cluster",
    k: int = 12,
    max_df: float = 0.95,
    word: str = HEBREW_WORD,
    ngram_range: tuple[int, int] = (1, 2),
    chars: int = CLUSTER_CHARS,
) -> DataFrame:
    """(cluster, rank, term, weight): the terms with the highest mean weight over the documents of each cluster.

    Frequencies are those inside the cluster, from title and summary; ties go to the smaller term.

    A cluster of at most `chars` characters is worked out in a group of its own, so its texts travel once.  A larger one is
    dealt into blocks of about that size, which tell each other the frequencies of the terms they share.
    """
    steps = StepTables(articles.sparkSession, "top-terms")
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")))
    rows = articles.where(F.col(cluster).isNotNull()).select(F.col(cluster).alias("cluster"), text.alias("_text"))
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.char_length("_text")).alias("chars"))
    sizes = steps.save(sizes, "sizes")
    cut = rows.select("cluster", words(F.col("_text"), only=word).alias("_tokens"))
    small = cut.join(sizes.where(F.col("chars") <= chars).select("cluster"), "cluster")
    kind = articles.schema[cluster].dataType.simpleString()
    ranked = small.groupBy("cluster").applyInPandas(_ranked_terms(k, max_df, ngram_range), f"cluster {kind}, rank int, term string, weight double")
    large = sizes.where(F.col("chars") > chars).select("cluster", "n", F.ceil(F.col("chars") / max(chars, 1)).cast("int").alias("blocks"))
    if not large.isEmpty():
        ranked = ranked.unionByName(_spread_top_terms(cut.join(large, "cluster"), k, max_df, ngram_range, steps, kind))
    return ranked.withColumnRenamed("cluster", cluster)


def _ranked_terms(k: int, max_df: float, ngram_range: tuple[int, int]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        n = len(group)
        counts = []
        for tokens in group["_tokens"]:
            tokens, found = tokens.tolist(), Counter()
            for size in range(ngram_range[0], ngram_range[1] + 1):
                found.update(tokens if size == 1 else map(" ".join, zip(*(tokens[j:] for j in range(size)))))
            counts.append(found)
        df = Counter(t for found in counts for t in found)
        idf = {t: math.log((1.0 + n) / (1.0 + d)) + 1.0 for t, d in df.items() if d <= max_df * n}
        total: Counter = Counter()
        for found in counts:
            raw = {t: tf * idf[t] for t, tf in found.items() if t in idf}
            norm = math.sqrt(math.fsum(w * w for w in raw.values()))
            for t, w in raw.items():
                total[t] += w / norm
        best = heapq.nsmallest(k, ((-round(w / n, 9), t) for t, w in total.items()))
        columns = {"rank": range(1, len(best) + 1), "term": pd.Series([t for _, t in best], dtype=object), "weight": pd.Series([-w for w, _ in best], dtype="float64")}
        named = pd.DataFrame(columns)
        named.insert(0, "cluster", group["cluster"].iloc[0])
        return named

    return run


def _spread_top_terms(cut: DataFrame, k: int, max_df: float, ngram_range: tuple[int, int], steps: StepTables, kind: str) -> DataFrame:
    """The same for clusters of any size; `cut` has cluster, n (its rows), blocks and _tokens.

    A cluster's rows are dealt into blocks, each worked out in a group of its own.  A block tells how many of its rows hold a
    term, as hashes packed by range, a row per range; each range of a cluster is added up and what other blocks hold goes back
    to those it matters to.  A term of one block only has its whole weight there, so a block gives its best of these and its
    sums of all others.  No term of a document is ever a row.
    """
    numbered = steps.save(cut.withColumn("_row", F.monotonically_increasing_id()), "large")
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("_row"), "blocks").cast("int")).drop("_row")
    packed = f"cluster {kind}, block int, part int, terms binary, dfs binary"
    told = dealt.groupBy("cluster", "block").applyInPandas(_block_frequencies(ngram_range), packed)
    added = told.groupBy("cluster", "part").applyInPandas(_frequencies_elsewhere, packed)
    grouped = dealt.groupBy("cluster", "block").cogroup(added.groupBy("cluster", "block"))
    sums = grouped.applyInPandas(_block_sums(k, max_df, ngram_range), f"cluster {kind}, n long, term string, w double")
    mean = sums.groupBy("cluster", "term").agg(F.round(F.sum("w") / F.max("n"), 9).alias("weight"))
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("weight"), "term"))
    return mean.withColumn("rank", place).where(F.col("rank") <= k).select("cluster", "rank", "term", "weight")


class _Block:
    """The n-grams of a block of rows as numbers: sorted hashes of the distinct ones, and (row, at, tf) of each in each row."""

    def __init__(self, tokens: pd.Series, ngram_range: tuple[int, int]):
        import xxhash

        self.words = np.concatenate([np.empty(0, object), *tokens])
        lengths = tokens.map(len).to_numpy()
        of = np.repeat(np.arange(len(tokens)), lengths)
        ids, distinct = pd.factorize(self.words)
        one = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), np.uint64, len(distinct))[ids]
        hashes, starts, sizes = [], [], []
        for size in range(ngram_range[0], ngram_range[1] + 1):
            last = max(len(of) - size + 1, 0)
            start = np.flatnonzero(of[:last] == of[size - 1 :])
            mixed = np.full(len(start), size, np.uint64)
            for k in range(size):
                mixed = (mixed ^ one[start + k]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            hashes.append(mixed)
            starts.append(start)
            sizes.append(np.full(len(start), size))
        start, size = np.concatenate(starts), np.concatenate(sizes)
        self.hashes, first, at = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.start, self.size = start[first], size[first]
        pairs, self.tf = np.unique(of[start] * max(len(self.hashes), 1) + at, return_counts=True)
        self.row, self.at = np.divmod(pairs, max(len(self.hashes), 1))
        self.df = np.bincount(self.at, minlength=len(self.hashes))

    def term(self, at: int) -> str:
        return " ".join(self.words[self.start[at] : self.start[at] + self.size[at]])


def _block_frequencies(ngram_range: tuple[int, int]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        block, blocks = _Block(group["_tokens"], ngram_range), int(group["blocks"].iloc[0])
        part = ((block.hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(part, np.arange(blocks + 1))
        rows = [(k, block.hashes[a:b].tobytes(), block.df[a:b].astype(np.int32).tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        out = pd.DataFrame(rows, columns=["part", "terms", "dfs"])
        out.insert(0, "cluster", group["cluster"].iloc[0])
        out.insert(1, "block", group["block"].iloc[0])
        return out

    return run


def _frequencies_elsewhere(group: pd.DataFrame) -> pd.DataFrame:
    """For each block the terms that other blocks hold too, with the rows of all blocks."""
    hashes = [np.frombuffer(x, np.uint64) for x in group["terms"]]
    every, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total, held = np.zeros(len(every), np.int64), np.bincount(at, minlength=len(every))
    np.add.at(total, at, np.concatenate([np.frombuffer(x, np.int32) for x in group["dfs"]]))
    rows, end = [], 0
    for own in hashes:
        start, end = end, end + len(own)
        shared = at[start:end][held[at[start:end]] > 1]
        rows.append((every[shared].tobytes(), total[shared].tobytes()))
    return group.assign(terms=[r[0] for r in rows], dfs=[r[1] for r in rows])[["cluster", "block", "part", "terms", "dfs"]]


def _block_sums(k: int, max_df: float, ngram_range: tuple[int, int]):
    def run(group: pd.DataFrame, elsewhere: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"cluster": [], "n": [], "term": [], "w": []})
        n, block = int(group["n"].iloc[0]), _Block(group["_tokens"], ngram_range)
        at = np.searchsorted(block.hashes, np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in elsewhere["terms"])]))
        df = block.df
        df[at] = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(x, np.int64) for x in elsewhere["dfs"])])
        known = df <= max_df * n
        raw = block.tf * np.where(known, np.log((1.0 + n) / (1.0 + df)) + 1.0, 0.0)[block.at]
        norm = np.sqrt(np.bincount(block.row, raw * raw, minlength=len(group)))
        total = np.bincount(block.at, raw / np.where(norm > 0, norm, 1.0)[block.row], minlength=len(df))
        shared = np.zeros(len(df), bool)
        shared[at] = True
        here, weight = np.flatnonzero(known & ~shared), np.round(total / n, 9)
        if len(here) > k:
            here = here[weight[here] >= np.partition(weight[here], -k)[-k]]
        best = heapq.nsmallest(k, ((-weight[i], block.term(i), i) for i in here))
        given = [(t, total[i]) for _, t, i in best] + [(block.term(i), total[i]) for i in np.flatnonzero(known & shared)]
        named = pd.DataFrame({"n": n, "term": pd.Series([t for t, _ in given], dtype=object), "w": pd.Series([w for _, w in given], dtype="float64")})
        named.insert(0, "cluster", group["cluster"].iloc[0])
        return named

    return run
