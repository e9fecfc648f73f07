from tripweave.ml.features import (
    ModelColumns, assemble_city, city_stages, station_stages,
)
from tripweave.ml.indexing import apply_index, fit_index
from tripweave.ml.models import (
    fit_city_model, fit_station_model, load_model, regression_metrics, save_model, score,
    score_scenarios,
)
from tripweave.ml.split import hash_split, random_split, split_where
from tripweave.ml.trees import feature_use, tree_nodes, walk_trees

__all__ = [
    "ModelColumns", "apply_index", "assemble_city", "city_stages", "feature_use", "fit_city_model", "fit_index", "fit_station_model",
    "hash_split", "load_model", "random_split", "regression_metrics", "save_model", "score",
    "score_scenarios", "split_where", "station_stages", "tree_nodes", "walk_trees",
]
