import pytest

import oracle
from foretide.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
# A cross-section that runs in a few minutes; the driver compares every query at a larger scale.
NAMES = ["scalar_cleaning", "durations", "name_keys", "document_text_keys", "month_chunks", "schedule_flatten", "roster_flatten", "odds_envelope",
         "player_form", "two_season_streaks", "standings_as_of", "slate_features", "upsert_last_wins", "coalescing_upsert", "snapshot_refresh",
         "split_nested", "auc_average_precision", "dropped_rows", "stored_upsert", "checked_documents", "landed_documents", "calibrator_comparison",
         "sigmoid_on_scores", "fused_join_faults", "played_without_rows", "metric_judgement", "priced_edges", "settlement", "history_display"]


def test_every_query_is_registered_with_a_known_oracle():
    catalogue.load()
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
    without = set(catalogue.QUERIES) - set(catalogue.ORACLES)
    assert without == {"model_variants", "calibrated_model", "feature_family_ablation", "slate_scores"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, name):
    catalogue.load()
    con = oracle.connect(FOLDER)
    assert oracle.differences(spark, con, name, catalogue.QUERIES[name], catalogue.ORACLES[name], FOLDER) == []
