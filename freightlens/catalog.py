"""Which module registers which query."""

CATALOG = {
    "freightlens.plans.bi": """
        bi_executive bi_delivery bi_fleet bi_fleet_risk_matrix bi_warehouse bi_warehouse_risk
        bi_financial bi_financial_kpis bi_reconcile
    """,
    "freightlens.plans.cleaning": """
        clean_orders clean_gps clean_weather weather_daily delivery_features gate_orders gate_gps
        gate_weather gate_features
    """,
    "freightlens.plans.customers": """
        cust_overall_kpis cust_activity cust_top20_revenue cust_value_segment cust_frequency_segment
        cust_repeat_share cust_retention_proxy cust_region cust_experience cust_high_value_poor
        cust_delivery_risk cust_monthly_trend cust_value_deciles cust_value_vs_experience
        cust_repeated_delays cust_by_weather cust_exec_snapshot
    """,
    "freightlens.plans.deliveries": """
        dlv_overall dlv_ontime_split dlv_delay_region dlv_status_dist dlv_order_status_dist
        dlv_distance_bucket dlv_warehouse dlv_driver dlv_daily dlv_revenue_region dlv_severe
        dlv_kpi_summary rt_distance_region rt_distance_bucket rt_gps_region rt_vehicle_movement
        rt_traffic_location rt_traffic_level rt_traffic_hourly rt_hotspots rt_minutes_per_km
        rt_delivery_vs_traffic rt_kpi_summary hwh_master_summary hwh_capacity_rank
        hwh_region_capacity hwh_order_volume hwh_delivery hwh_capacity_ratio hwh_region_performance
        hwh_highest_delay hwh_value_contribution hwh_geo hwh_kpi_summary
    """,
    "freightlens.plans.drivers": """
        drv_overall_kpis drv_performance drv_top20_volume drv_top20_value drv_top20_ontime
        drv_repeat_delays drv_segmentation drv_workload_region drv_region_performance
        drv_revenue_contribution drv_distance_efficiency drv_distance_segment drv_rainy
        drv_weather_risk drv_daily drv_monthly drv_workload_deciles drv_overloaded drv_exceptions
        drv_exec_snapshot
    """,
    "freightlens.plans.eda": """
        eda_dataset_summary eda_missing_values eda_numeric_summary eda_orders_region
        eda_status_share eda_order_value_histogram eda_rain_histogram eda_distance_vs_delay
        eda_customer_activity eda_customers_region eda_driver_performance eda_warehouse_workload
        eda_weather_condition eda_traffic_location eda_traffic_level eda_gps_vehicle
        eda_delivery_events eda_update_status
    """,
    "freightlens.plans.forecast": """
        fc_daily_demand fc_time_features fc_chrono_split fc_linear_model fc_evaluate
        fc_test_predictions fc_forecast fc_summary
    """,
    "freightlens.plans.history": """
        dim_scd2_merged
    """,
    "freightlens.plans.ingest": """
        ingest_orders ingest_customers ingest_warehouses ingest_report src_csv_contract
        src_processed_or_raw src_all_datasets sink_single_csv sink_partitioned_lake
        tbl_hive_register mat_view_table norm_weather_payload norm_traffic_payload
        norm_route_payload
    """,
    "freightlens.plans.kpi_jobs": """
        job_prepare_deliveries delivery_overall delivery_by_region delivery_by_day
        delivery_by_status delivery_metrics_union driver_metrics driver_region_metrics
        warehouse_metrics warehouse_region_metrics gps_region_metrics traffic_location_metrics
        road_type_metrics delivery_route_region route_region_metrics
    """,
    "freightlens.plans.kpis": """
        kpi_exec_snapshot kpi_region_orders kpi_region_ontime kpi_region_delay kpi_daily
        kpi_delay_category kpi_risk_dist kpi_weather kpi_heavy_rain kpi_region_value
        kpi_fleet_region kpi_traffic_risk kpi_warehouse_rank kpi_high_risk_wh kpi_exceptions
        kpi_top100_delayed kpi_distance_category kpi_monthly
    """,
    "freightlens.plans.marts": """
        int_delivery_asof_weather int_delivery int_routes_nearest_traffic int_routes
        int_driver_performance delivery_mart logistics_mart warehouse_mart executive_mart
        test_unique_orders test_valid_status
    """,
    "freightlens.plans.ml_features": """
        feat_summary feat_calendar feat_delivery feat_delivery_weather feat_gps feat_customer
        feat_driver feat_warehouse
    """,
    "freightlens.plans.predict": """
        dp_target dp_features dp_split dp_pipeline dp_evaluate dp_class_report dp_confusion dp_roc
        dp_coefficients dp_predictions_summary
    """,
    "freightlens.plans.profiles": """
        prof_customers prof_drivers prof_gps prof_orders prof_traffic prof_vehicles prof_warehouses
        prof_weather
    """,
    "freightlens.plans.quality": """
        dq_not_blank dq_unique_keys dq_ranges dq_referential dq_population dq_binary_flags
        dq_non_negative dq_empty_columns dq_consistency dq_calendar dq_dimensions dq_row_anomaly
        dq_report
    """,
    "freightlens.plans.route_study": """
        ra_gps_vehicle ra_gps_region ra_speed_histogram ra_traffic_histogram ra_traffic_location
        ra_road_condition ra_road_type ra_road_overview ra_distance_bands ra_region_risk ra_summary
    """,
    "freightlens.plans.staging": """
        stg_orders stg_gps stg_weather stg_traffic
    """,
    "freightlens.plans.star": """
        dim_customer dim_driver dim_vehicle dim_warehouse dim_location dim_date load_fact_orders
        load_fact_delivery load_fact_gps load_fact_traffic dim_scd2 fo_total fo_month
        fo_customer_type fo_warehouse fo_driver fo_region fd_overall fd_driver fd_warehouse fd_daily
        fd_distance_band fd_severe fg_overall fg_vehicle fg_region fg_hourly fg_daily fg_low_signal
        ft_overall ft_location ft_congestion ft_hourly ft_daily ft_severe ft_delivery_window
        dd_month dd_dow dd_weekend dd_quarter dv_region dv_rating dv_experience_band dveh_type
        dveh_fuel dveh_maintenance dveh_age dveh_capacity dc_region dc_type dw_region dw_capacity
        dw_largest dw_geo dl_region dl_list dl_with_coords
    """,
    "freightlens.plans.warehouses": """
        wh_overall wh_performance wh_top20_volume wh_top20_value wh_delivery_risk wh_segmentation
        wh_region wh_value_share wh_above_avg wh_above_avg_poor wh_below_avg wh_deciles
        wh_value_segment wh_aov wh_delay_impact wh_dense_rank wh_exceptions wh_network_balance
        wh_workload_delay_matrix wh_exec_snapshot
    """,
    "freightlens.streaming.queries": """
        st_gps st_orders st_parse_orders_active st_parse_gps st_weather_updates st_gps_windows
        st_gps_windows_sliding st_gps_sessions st_dedup st_unified_events st_orders_gps_join
        st_delivery_status st_traffic_trend st_triggers src_kafka_json sink_stream_json
        pub_events_json sub_validate_append sub_validate_append_gps
    """,
}
