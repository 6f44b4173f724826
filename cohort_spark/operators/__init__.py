"""DataFrame -> DataFrame operators.

columns   projections, filters, table information (P)
joins     key joins and set operations (J, U)
dedup     first row per key, duplicates, ordering, top-k (D)
stats     aggregations, statistics, data quality (A, Q)
missing   missing values, KNN imputation (M)
outliers  outlier rules and the isolation forest (O)
encode    scaling, one-hot, dummies, label codes, preprocessor, LDA (E)
sample    exact seeded splits and resampling (R)
models    Spark ML classifiers, grid search, importance (L, X)
metrics   evaluation (V)
fairness  group fairness, bias report, ranking (B)
drift     two-table drift tests and distances (C)
ordered   shared scale helpers: global rank, k-th in order, running sums, exact quantiles
"""
