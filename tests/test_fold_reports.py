"""The quantile report has a row for every fold, filled where there are predictions."""

import __spark_entry__

FOLDER = "/root/testdata/sf0.001"


def filled(spark, name):
    return {r.fold: r.MAE is not None for r in __spark_entry__.queries()[name](spark, FOLDER).collect()}


def test_all_folds_are_reported_and_a_missing_one_is_empty(spark):
    assert filled(spark, "r12_quantile_fold_report_all_folds") == dict.fromkeys(range(1, 6), True)
    assert filled(spark, "r12_quantile_fold_report") == {**dict.fromkeys(range(1, 5), True), 5: False}
