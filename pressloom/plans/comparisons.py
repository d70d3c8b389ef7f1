"""Queries that compare outlets over the clustered article view, and the landed forms of their inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressloom.operators import coverage, features, linkage, records
from pressloom.plans import pipelines, views


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def outlet_overlap(spark, sf):
    return _rounded(coverage.outlet_overlap(views.clustered(spark, sf)), "jaccard", "cosine")


def event_volume(spark, sf):
    return _rounded(coverage.event_volume(views.clustered(spark, sf)), "article_share", "word_share")


def first_publisher_lag(spark, sf):
    return coverage.first_publisher_lag(records.with_instant(views.clustered(spark, sf)))


def headline_lengths(spark, sf):
    return _rounded(coverage.headline_lengths(views.articles(spark, sf)), "mean")


def coverage_grid(spark, sf):
    return _rounded(coverage.coverage_grid(records.with_instant(views.clustered(spark, sf))), "running_share")


def _frame(spark, sf):
    return pipelines.clustering_frame(views.articles(spark, sf))


def char_tfidf_weights(spark, sf):
    return _rounded(features.char_tfidf(_frame(spark, sf)), "w")


def stacked_cosine_pairs(spark, sf):
    """Pairs by words and character n-grams together."""
    return _rounded(linkage.cosine_pairs(_frame(spark, sf), chars=features.CharGrams()), "sim")


QUERIES = {fn.__name__: fn for fn in (outlet_overlap, event_volume, first_publisher_lag, headline_lengths, coverage_grid, char_tfidf_weights, stacked_cosine_pairs)}
