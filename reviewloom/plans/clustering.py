"""From category vectors to labelled reviews, measures and report tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from reviewloom.operators import clusters, hierarchy, joins, projection, validity
from reviewloom.staging import settle


@dataclass
class Clustering:
    """Everything a clustering run yields."""

    reviews: DataFrame
    points: DataFrame
    metrics: DataFrame
    reducer: PipelineModel | None
    tree: DataFrame | None = None

    @property
    def labels(self) -> DataFrame:
        return self.points.drop("vector")


def cluster_categories(reviews: DataFrame, vectors: DataFrame, dims: int = 3, **params) -> Clustering:
    """Project the category vectors, group them, and label the reviews.

    The reviews are only joined once with the label table; all else runs on one row
    per category.
    """
    reducer = clusters.fit_reducer(vectors, dims)
    reduced = settle(clusters.reduce_with(reducer, vectors), "reduced")
    labels = settle(clusters.density_labels(reduced, **params), "labels")
    points = settle(reduced.join(labels, "category"), "points")
    return Clustering(
        reviews=joins.assign_meta_category(reviews, labels),
        points=points,
        metrics=validity.validity_metrics(points),
        reducer=reducer,
    )


def cluster_by_tree(
    reviews: DataFrame, vectors: DataFrame, layout: projection.Layout = projection.Layout(), **params
) -> Clustering:
    """Project the category vectors non-linearly, choose clusters from the whole density tree,
    and label the reviews. ``tree`` holds the condensed tree's clusters with their stability.
    """
    reduced = settle(projection.project(vectors, layout), "reduced")
    found = hierarchy.density_hierarchy(reduced, **params)
    labels = settle(found.labels, "labels")
    points = settle(reduced.join(labels, "category"), "points")
    score = hierarchy.relative_validity(labels, found.edges)
    metrics = validity.validity_metrics(points).withColumn("stability_score", score.scalar())
    return Clustering(joins.assign_meta_category(reviews, labels), points, metrics, None, found.clusters)
