"""Generated by tools/gen_double_columns.py: DOUBLE output columns of each oracle query."""

DOUBLE_COLUMNS = {'drop_duplicate_rows': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'update_earliest': ['o_totalprice'],
 'accuracy': ['accuracy'],
 'analyze_duplicates': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'append_metrics': ['value'],
 'assessment_flow': ['TOT1', 'PRICE', 'TOT2', 'PRICE_dup', 'TOT3', 'TOT4', 'TOT5'],
 'assessment_union_flow': ['TOT1', 'PRICE', 'TOT2', 'TOT3', 'TOT4', 'TOT5'],
 'bias_report': ['accuracy', 'dp_diff', 'eo_diff', 'slice_accuracy'],
 'box_stats': ['q1', 'median', 'q3', 'iqr', 'whisker_low', 'whisker_high'],
 'chi2_drift': ['statistic', 'p_value'],
 'classification_report': ['precision', 'recall', 'f1'],
 'column_statistics': ['mean', 'std', 'min', 'median', 'max', 'avg_length'],
 'compare_distributions': ['lower', 'upper'],
 'correlated_columns': ['corr'],
 'correlation_matrix': ['corr'],
 'cut_equal_width': ['c_acctbal'],
 'demographic_parity_difference': ['dp_diff'],
 'describe_stats': ['mean', 'std', 'min', 'q25', 'q50', 'q75', 'max', 'median', 'mode'],
 'drop_id_columns': ['c_acctbal'],
 'drop_repeated_columns': ['o_totalprice'],
 'drop_sparse_columns': ['l_quantity', 'l_extendedprice', 'l_discount'],
 'earliest_per_key': ['o_totalprice'],
 'equalized_odds_difference': ['eo_diff'],
 'f1_weighted': ['f1_weighted'],
 'fairness_by_group': ['dp_diff', 'eo_diff', 'group_accuracy'],
 'feature_drift_score': ['score'],
 'feature_flow': ['c_acctbal', 'c_nationkey', 'o_totalprice', 'n_regionkey_0.0', 'n_regionkey_1.0',
                  'n_regionkey_2.0', 'n_regionkey_3.0', 'n_regionkey_4.0', 'o_orderpriority_1-URGENT',
                  'o_orderpriority_2-HIGH', 'o_orderpriority_3-MEDIUM', 'o_orderpriority_4-NOT SPECIFIED',
                  'o_orderpriority_5-LOW'],
 'fill_value': ['l_quantity'],
 'filter_eq': ['o_totalprice'],
 'filter_isin': ['o_totalprice'],
 'filter_ne_keep_null': ['o_totalprice'],
 'first_n': ['o_totalprice'],
 'fit_apply_preprocessor': ['c_acctbal', 'grp_0.0', 'grp_1.0', 'grp_2.0', 'parity_0.0', 'parity_1.0'],
 'freq_outer_join': ['share_a', 'share_b'],
 'group_accuracy': ['accuracy'],
 'handle_duplicates_first': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'handle_duplicates_last': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'handle_duplicates_none': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'handle_duplicates_reindex': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'handle_missing_values': ['l_orderkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount',
                           'l_tax'],
 'handle_missing_values_strategy': ['l_quantity', 'l_extendedprice', 'l_discount'],
 'histogram': ['lower', 'upper'],
 'impute_low_missing': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'impute_mean_mode': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'inner_join_all': ['total_x', 'total_y', 'total'],
 'join_inner_suffix': ['c_acctbal', 'c_acctbal_drop'],
 'join_left_dropkey': ['c_acctbal', 's_acctbal'],
 'join_on_group_min': ['o_totalprice'],
 'knn_impute': ['a', 'b', 's'],
 'knn_impute_wide': ['a', 'b', 'e', 'f', 'g', 'h', 'j'],
 'ks_drift_exact': ['statistic', 'p_value'],
 'ks_drift': ['statistic', 'p_value'],
 'mask_replace': ['l_discount'],
 'missing_ratio': ['missing_ratio'],
 'model_accuracies': ['accuracy'],
 'model_ranking': ['accuracy', 'penalty', 'score'],
 'one_hot': ['c_acctbal', 'c_mktsegment_AUTOMOBILE', 'c_mktsegment_BUILDING', 'c_mktsegment_FURNITURE',
             'c_mktsegment_HOUSEHOLD', 'c_mktsegment_MACHINERY', 'grp_0.0', 'grp_1.0', 'grp_2.0'],
 'outer_join_all': ['total', 'total_dup'],
 'outlier_isolation_invariants': ['untouched'],
 'outlier_iqr_median': ['o_totalprice'],
 'outlier_report': ['Original_Mean', 'Cleaned_Mean', 'Original_Std', 'Cleaned_Std'],
 'outlier_to_null_iqr': ['o_totalprice'],
 'outlier_to_null_zscore': ['o_totalprice'],
 'outlier_zscore_median': ['l_extendedprice'],
 'parse_feature_record': ['f_quantity', 'f_discount', 'f_tax'],
 'participant_flow': ['c_acctbal', 'o_totalprice'],
 'profile_merge': ['mean', 'std', 'min', 'q25', 'median', 'q75', 'max', 'avg_length'],
 'profile_report': ['missing_cell_share'],
 'read_table': ['c_acctbal'],
 'rename_key': ['c_acctbal'],
 'roc_auc_ovr': ['auc'],
 'roc_curve': ['threshold', 'fpr', 'tpr'],
 'roc_curves_ovr': ['threshold', 'fpr', 'tpr'],
 'save_load_model': ['z_quantity', 'z_extendedprice', 'z_discount'],
 'select_best': ['accuracy', 'penalty', 'score'],
 'select_by_type': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'sort_rows': ['o_totalprice'],
 'split_target': ['c_acctbal'],
 'stage_table': ['c_acctbal', 'o_totalprice'],
 'standard_scale': ['c_acctbal'],
 'top_k': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
 'union_by_name': ['o_totalprice'],
 'union_groups': ['o_totalprice'],
 'value_counts': ['share'],
 'write_table': ['c_acctbal']}
