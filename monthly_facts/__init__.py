"""monthly_facts: monthly production facts as plain Spark DataFrame jobs.

Layers: bronze (decoded source extracts, one partition per source file) ->
silver (columns of interest + month, year, state) -> gold (monthly rollup,
one partition per month) -> consolidated (all months, ordered by date), plus
labelled dimensions and the read-side queries a dashboard asks.
"""

from monthly_facts.operators.dims import (
    build_dimension,
    codes_for_labels,
    facility_dimension,
    filter_by_labels,
    label_options,
    procedure_dimension,
)
from monthly_facts.operators.filters import fact_filter, keep_members, up_to_month
from monthly_facts.operators.gold import rollup
from monthly_facts.operators.incremental import (
    available_months,
    landed_months,
    latest_month,
    month_dates,
    month_range,
    months_frame,
    months_of_sources,
    pending_months,
    source_files,
    source_months,
    start_month,
    year_month_grid,
)
from monthly_facts.operators.reshape import (
    mean_caption,
    monthly_long,
    pooled_mean,
    to_long,
    yearly_long,
    yearly_totals,
)
from monthly_facts.operators.serve import (
    collect_tables,
    month_firsts,
    monthly_sums,
    monthly_totals,
    months_of_years,
    municipalities,
    preview,
    read_records,
    shape,
    to_list,
    to_records,
    write_records,
    year_bounds,
    years,
)
from monthly_facts.operators.silver import derive_silver, silver_for_months
from monthly_facts.plans.dashboard import dashboard_tables
from monthly_facts.plans.consolidate import consolidate
from monthly_facts.plans.ingest import bad_measures, consolidated_exists, existing_months, ingest, refresh_dimensions, run_monthly
from monthly_facts.sources.bronze import land_bronze, landed_sources, read_bronze, read_bronze_tree, tree_problems
from monthly_facts.sources.files import path_exists
from monthly_facts.sources.tables import (
    Layout,
    configure_object_store,
    migrate_gold_tree,
    month_folders,
    read_consolidated,
    read_dimension,
    read_gold,
    read_gold_tree,
    read_label_table,
    read_silver,
    register_views,
    write_month_partitions,
    write_silver,
    write_table,
)

__all__ = [name for name in dir() if not name.startswith("_")]
