"""Name -> query callable for every registered report / operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.plans import corpus_jobs as O
from contrail.plans import dashboard as D
from contrail.plans import etl as X
from contrail.plans import families as L
from contrail.plans import load
from contrail.plans import ml_jobs as N
from contrail.plans import views as U
from contrail.plans import reports as K
from contrail.plans.mart import FlightMart
from contrail.streaming import streams as P


def _mart(fn, **kw):
    return lambda spark, sf_dir: fn(FlightMart(spark, sf_dir), **kw)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "k01_heavy_models": _mart(K.k01_heavy_models),
        "k02_missing_fuel": _mart(K.k02_missing_fuel),
        "k02_missing_fuel_counts": _mart(K.k02_missing_fuel_counts),
        "k03_airline_size_class": _mart(K.k03_airline_size_class),
        "k04_top_airlines": _mart(K.k04_top_airlines),
        "k05_models_without_aircraft": _mart(K.k05_models_without_aircraft),
        "k06_codeshare": _mart(K.k06_codeshare),
        "k07_state_connectivity": _mart(K.k07_state_connectivity),
        "k08_airline_quarter_matrix": _mart(K.k08_airline_quarter_matrix),
        "k09_continent_coverage": _mart(K.k09_continent_coverage),
        "k10_model_environment": _mart(K.k10_model_environment),
        "k11_schedule_deviation": _mart(K.k11_schedule_deviation),
        "k12_long_taxi_out": _mart(K.k12_long_taxi_out),
        "k13_punctuality_quartiles": _mart(K.k13_punctuality_quartiles),
        "k14_month_end_close": _mart(K.k14_month_end_close),
        "k15_quarter_over_quarter": _mart(K.k15_quarter_over_quarter),
        "k16_top_origin_airports": _mart(K.k16_top_origin_airports),
        "k17_rank_in_network": _mart(K.k17_rank_in_network),
        "k18_change_vs_previous_quarter": _mart(K.k18_change_vs_previous_quarter),
        "k19_daily_running_total": _mart(K.k19_daily_running_total),
        "k20_share_system_alliance": _mart(K.k20_share_system_alliance),
        "k21_quarterly_co2_matrix": _mart(K.k21_quarterly_co2_matrix),
        "k22_ytd_delay": _mart(K.k22_ytd_delay),
        "k22_ytd_delay_top5": _mart(K.k22_ytd_delay, top=5),
        "k23_mtd_fuel": _mart(K.k23_mtd_fuel),
        "k24_route_risk": _mart(K.k24_route_risk),
        "k25_late_flights": _mart(K.k25_late_flights),
    }
    # the stand-in catalogue has about 30 flights a model: a lower explicit threshold than the default 50
    q["k30_fuel_before_after"] = _mart(D.k30_fuel_before_after, min_n=25)
    for name in ("k26_volume_kpi", "k27_delay_kpi", "k28_top_delay_airlines", "k26_volume_kpi_selected",
                 "k27_delay_kpi_selected", "k28_top_delay_airlines_selected", "k29_emissions_panel",
                 "k29_fleet_totals", "k31_global_counts", "k32_mean_delays",
                 "k33_catalogue_sizes", "k34_emission_totals", "k35_top_models_co2",
                 "k35_top_airlines_co2", "k36_route_risk_distribution", "k37_simulator_catalogue"):
        q[name] = _mart(getattr(D, name))
    q.update({
        "l01_delay_stats": _mart(L.l01_delay_stats),
        "l01_delay_stats_by_year": _mart(L.l01_delay_stats, by=["year"]),
        "l01_delay_stats_by_month": _mart(L.l01_delay_stats, by=["month"]),
        "l01_delayed_counts": _mart(L.l01_delayed_counts),
        "l02_delay_by_airline_top10": _mart(L.l02_delay_by, dim="airline_name", top=10),
        "l02_delay_by_continent": _mart(L.l02_delay_by, dim="dest_continent"),
        "l02_delay_by_weekday": _mart(L.l02_delay_by, dim="day_of_week"),
        "l02_delay_by_distance_group": _mart(L.l02_delay_by, dim="distance_group"),
        "l03_taxi_by_origin": _mart(L.l03_taxi_by, dim="origin_airport"),
        "l03_taxi_by_month": _mart(L.l03_taxi_by, dim="month"),
        "l03_top_taxi_flights": _mart(L.l03_top_taxi_flights),
        "l04_fleet_by_airline": _mart(L.l04_fleet_by_airline),
        "l04_models_per_maker": _mart(L.l04_models_per_maker),
        "l05_flights_by_dest_state": _mart(L.l05_flights_by_geo, dim="dest_state"),
        "l05_flights_by_origin_airport": _mart(L.l05_flights_by_geo, dim="origin_airport"),
        "l06_distance_by_year": _mart(L.l06_distance_by, dim="year"),
        "l06_distance_by_airline": _mart(L.l06_distance_by, dim="airline_name"),
        "l06_longest_routes": _mart(L.l06_longest_routes),
        "l07_co2_by_airline": _mart(L.l07_co2_by, dim="airline_name"),
        "l07_co2_by_continent": _mart(L.l07_co2_by, dim="dest_continent"),
        "l07_cancel_rate_by_month": _mart(L.l07_cancel_rate_by, dim="month"),
        "l08_monthly_windows": _mart(L.l08_monthly_windows),
        "l08_top3_per_year": _mart(L.l08_top_per_group),
        "l08_dense_top3_per_year": _mart(L.l08_top_per_group, kind="dense_rank"),
        "l08_running_sum_of_sum": _mart(L.l08_running_sum_of_sum),
        "l09_pivot_count_by_continent": _mart(L.l09_pivot_count_by_continent),
        "l09_pivot_avg_delay_by_quarter": _mart(L.l09_pivot_avg_delay_by_quarter),
        "l09_unpivot_quarters": _mart(L.l09_unpivot_quarters),
        "l12_above_global_average": _mart(L.l12_above_global_average),
        "l12_worst_month_per_airline": _mart(L.l12_worst_month_per_airline),
        "l12_airline_vs_network": _mart(L.l12_airline_vs_network),
        "l13_by_maker_top5": _mart(L.l13_by_maker),
        "l04_fleet_by_month": _mart(L.l04_fleet_by_month),
        "l04_airline_makers": _mart(L.l04_airline_makers),
        "l05_flights_by_city_pair_state": _mart(L.l05_flights_by_city_pair_state),
        "l09_pivot_delay_by_weekday": _mart(L.l09_pivot_delay_by_weekday),
        "l13_makers_by_co2": _mart(L.l13_maker_ranking, by="co2"),
        "l13_makers_by_fuel": _mart(L.l13_maker_ranking, by="fuel"),
        "l13_makers_by_aircraft": _mart(L.l13_maker_ranking, by="aircraft"),
        "l14_destinations_by_avg_arr_delay": _mart(L.l14_destination_ranking, by="avg_arr_delay"),
        "l14_destinations_by_co2": _mart(L.l14_destination_ranking, by="co2"),
        "e09_mean_row_ratio": _mart(L.e09_mean_row_ratio),
        "e11_null_as_zero": _mart(L.e11_null_as_zero),
        "d03_left_outer_ignoring_nulls": _mart(L.d03_left_outer_ignoring_nulls),
        "l14_top_destinations": _mart(L.l14_top_destinations),
        "l15_delay_buckets": _mart(L.l15_delay_buckets),
        "l15_months_above_yearly_mean": _mart(L.l15_months_above_yearly_mean),
        "l15_weekend_by_airline": _mart(L.l15_weekend_by_airline),
        "l15_haul_buckets": _mart(L.l15_haul_buckets),
        "l15_share_by_scalar": _mart(L.l15_share_by_scalar),
    })
    for name in U.VIEWS:
        q[f"u1_{name}"] = _mart(U.VIEWS[name])
    q.update({
        "u2_flights_to_continent": _mart(U.p_flights_to_continent, continent="EUROPE"),
        "u2_yearly_delay": _mart(U.p_yearly_delay, year=1999),
        "u2_airline_summary": _mart(U.p_airline_summary, airline_code="7"),
        "u2_delayed_over": _mart(U.p_delayed_over, minutes=500),
        "u2_distance_group_metrics": _mart(U.p_distance_group_metrics, group=3),
        "u2_monthly_taxi": _mart(U.p_monthly_taxi, month=7),
        "u5_sql_late_flights": U.sql_late_flights,
    })
    q.update({
        "b10_keep_first": _mart(X.b10_keep_first),
        "b10_dedupe_report": _mart(X.b10_dedupe_report),
        "b15_canonical_keys": _mart(X.b15_canonical_keys),
        "b_clean_orders": _mart(X.b_clean_orders),
        "b25_quantile_trim": _mart(X.b25_quantile_trim),
        "d13_route_lookup_coverage": _mart(X.d13_route_lookup_coverage),
        "d17_key_sets": _mart(X.d17_key_sets),
        "h2_airport_roles": _mart(X.h2_airport_roles),
        "m4_first_destination": _mart(X.m4_first_destination),
        "m7_coherence": _mart(X.m7_coherence),
        "m8_fuel_profile_by_maker": _mart(X.m8_fuel_profile_by_maker),
        "m8_cv_of_model_means": _mart(X.m8_cv_of_model_means, min_n=25),
        "m9_pearson": _mart(X.m9_pearson),
        "m9_pearson_by_engine": _mart(X.m9_pearson, by=["engine_type"]),
        "m9_spearman": _mart(X.m9_spearman),
        "m9_spearman_by_engine": _mart(X.m9_spearman, by=["engine_type"]),
        "m10_signal_gate": _mart(X.m10_signal_gate, min_n=25),
        "m12_fd_audit": _mart(X.m12_fd_audit),
        "m13_numeric_profile": _mart(X.m13_numeric_profile),
        "m14_profile_columns": _mart(X.m14_profile_columns),
        "a11_staged_correction": _mart(X.a11_staged_correction),
        "c5_not_in": _mart(X.c5_not_in),
        "c7_name_patterns": _mart(X.c7_name_patterns),
        "d4_left_join_default": _mart(X.d4_left_join_default),
        "b17_patched_catalogue": _mart(X.b17_patched_catalogue),
        "d18_numeric_key_join": _mart(X.d18_numeric_key_join),
    })
    for name in ("o1_expand_templates", "o2_dedupe_corpus", "o2_dedupe_documents", "o3_cap_per_family",
                 "o4_stratified_split", "o5_family_distribution", "o6_integrity_gate",
                 "o6_gate_on_drafts", "o7_scored_drafts", "o8_schema_problems", "o8_problem_frequency",
                 "o8_reference_summary", "o9_extract_code", "o10_statement_kinds", "o11_rewritten_drafts",
                 "o12_flag_counts", "o12_repaired_chains", "o13_strip_comments", "o15_bodies"):
        q[name] = _mart(getattr(O, name))
    for name in ("n1_training_summary", "n9_baseline_metrics", "n13_calibration", "n5_model_comparison", "n7_log_target", "n11_model_report",
                 "n10_feature_importance", "n12_score_catalogue"):
        q[name] = _mart(getattr(N, name))
    for name in ("a8_key_report", "a10_restored", "a11_stored_correction", "a13_correction_report", "d13_six_lookups", "d14_tail_model", "m1_natural_dimensions", "m2_second_load",
                 "m2_surrogate_dimensions", "m3_facts", "m5_city_state"):
        q[name] = _mart(getattr(load, name))
    q["p1_stream_dedupe"] = P.p1_dedupe_within_watermark
    q["p2_stream_daily_totals"] = P.p2_daily_totals
    q["p3_stream_latest_upsert"] = P.p3_latest_event_upsert
    return q
