"""The query catalog: name -> Spark callable, name -> DuckDB SQL."""

from __future__ import annotations

from larch.plans import oracle, queries as q

QUERIES = {
    # scans, reduction, sinks
    "trip_scan": q.trip_scan,
    "month_summary": q.month_summary,
    "pair_counts": q.pair_counts,
    "frequent_pair_trips": q.frequent_pair_trips,
    "reduction_report": q.reduction_report,
    "top_pairs": q.top_pairs,
    "reduced_sink_roundtrip": q.reduced_sink_roundtrip,
    "sampled_trips": q.sampled_trips,
    "sample_then_split": q.sample_then_split,
    "validation_share": q.validation_share,
    # targets and raw features
    "duration_target": q.duration_target,
    "tipped_target": q.tipped_target,
    "regression_columns": q.regression_columns,
    "classification_columns": q.classification_columns,
    "split_assignment": q.split_assignment,
    # imputation, scaling, encoding
    "regression_fill_statistics": q.regression_fill_statistics,
    "classification_fill_statistics": q.classification_fill_statistics,
    "imputed_regression_features": q.imputed_regression_features,
    "imputed_within_sides": q.imputed_within_sides,
    "scaled_classification_features": q.scaled_classification_features,
    "onehot_slots": q.onehot_slots,
    "category_codes": q.category_codes,
    # baselines and evaluation
    "regression_baseline": q.regression_baseline,
    "classification_baseline": q.classification_baseline,
    "fare_score_auc": q.fare_score_auc,
    "threshold_report": q.threshold_report,
    # linear models with closed forms
    "ols_one_feature": q.ols_one_feature,
    "ridge_one_feature": q.ridge_one_feature,
    "lasso_one_feature": q.lasso_one_feature,
    "elastic_net_one_feature": q.elastic_net_one_feature,
    "lineitem_price_ols": q.lineitem_price_ols,
    "ridge_one_feature_search": q.ridge_one_feature_search,
    "logistic_one_flag": q.logistic_one_flag,
    "elastic_net_path_alphas": q.elastic_net_path_alphas,
    # folds and learning-curve subsets
    "stratified_folds": q.stratified_folds,
    "fold_class_shares": q.fold_class_shares,
    "learning_curve_subsets": q.learning_curve_subsets,
    # searches and comparisons (rows-only checks)
    "ridge_search": q.ridge_search,
    "lasso_search": q.lasso_search,
    "elastic_net_search": q.elastic_net_search,
    "logistic_search": q.logistic_search,
    "boosted_trees_categorical_search": q.boosted_trees_categorical_search,
    "boosted_trees_onehot_search": q.boosted_trees_onehot_search,
    "random_forest_search": q.random_forest_search,
    "gradient_boosting_search": q.gradient_boosting_search,
    "decision_tree_fit": q.decision_tree_fit,
    "linear_svm_fit": q.linear_svm_fit,
    "boosted_regression_search": q.boosted_regression_search,
    "regression_leaderboard": q.regression_leaderboard,
    "classification_leaderboard": q.classification_leaderboard,
    "logistic_refit": q.logistic_refit,
    "logistic_learning_curve": q.logistic_learning_curve,
    "boosted_learning_curve": q.boosted_learning_curve,
    # coefficient paths
    "ridge_path": q.ridge_path,
    "lasso_path": q.lasso_path,
    "elastic_net_path": q.elastic_net_path,
    "lasso_path_alphas": q.lasso_path_alphas,
    "lasso_path_summary": q.lasso_path_summary,
    "path_optimality": q.path_optimality,
    # unsupervised and scoring
    "kmeans_clusters": q.kmeans_clusters,
    "kmeans_assign_label_centers": q.kmeans_assign_label_centers,
    "pca_components": q.pca_components,
    "pca_projection_summary": q.pca_projection_summary,
    "embedding_covariance": q.embedding_covariance,
    "saved_model_scoring": q.saved_model_scoring,
    "streaming_scoring": q.streaming_scoring,
    # second binary task on labels + documents
    "document_quality_baseline": q.document_quality_baseline,
    "document_length_auc": q.document_length_auc,
    "document_quality_logistic": q.document_quality_logistic,
    # closed-form checks of a tree, scoring and the row guard
    "decision_stump": q.decision_stump,
    "saved_ols_scoring": q.saved_ols_scoring,
    "feature_row_guard": q.feature_row_guard,
    "boosted_one_round": q.boosted_one_round,
    "search_candidates": q.search_candidates,
    "monthly_files_summary": q.monthly_files_summary,
    "next_month_scoring": q.next_month_scoring,
    "boosted_patience": q.boosted_patience,
}

ORACLE = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
