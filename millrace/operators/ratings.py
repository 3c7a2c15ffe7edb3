"""Ratings: typing and the most rated titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import epoch_seconds_to_timestamp


def typed_ratings(ratings: DataFrame) -> DataFrame:
    """Text ratings to a double rating and a timestamp made from epoch seconds."""
    return ratings.withColumns(
        {
            "rating": F.col("rating").try_cast("double"),
            "timestamp": epoch_seconds_to_timestamp(F.col("timestamp")),
        }
    )


def top_titles(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """The n titles with most ratings, and their mean rating; titles shared by movies merge.

    Ratings are summed per movie before the join, and equal movie rows become one with a count. The
    join then sees few rows per movie, however often the movie is rated or listed, and the sums
    add up to the counts and means of the joined rows.
    """
    per_movie = ratings.groupBy("movieId").agg(
        F.count("timestamp").alias("stamped"),
        F.count("rating").alias("rated"),
        F.sum("rating").alias("total"),
    )
    listed = movies.groupBy("movieId", "title").agg(F.count("*").alias("copies"))

    def summed(column: str) -> Column:
        return F.sum(F.col(column) * F.col("copies"))

    return (
        per_movie.join(listed, "movieId")
        .groupBy("title")
        .agg(
            summed("stamped").alias("qty_ratings"),
            F.try_divide(summed("total"), summed("rated")).alias("avg_rating"),
        )
        .orderBy(F.desc("qty_ratings"), F.asc("title"))
        .limit(n)
    )
